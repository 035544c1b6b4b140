"""Object-store access for scans and saves.

Paths are ``s3a://bucket/key`` URIs read by Spark's Hadoop file system; the
connector settings go into the session (or the submit config).  Secrets are
never printed: ``describe`` masks them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SECRET_KEYS = ("spark.hadoop.fs.s3a.secret.key", "spark.hadoop.fs.s3a.access.key")


def s3a_settings(endpoint_url: str, access_key: str, secret_key: str,
                 path_style: bool = True, ssl: bool = True) -> dict[str, str]:
    """Spark settings for an S3-compatible endpoint."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint_url,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def apply(builder: SparkSession.Builder, settings: dict[str, str] | None) -> SparkSession.Builder:
    """Add object-store settings to a session builder (no-op without settings)."""
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder


def describe(settings: dict[str, str]) -> dict[str, str]:
    """Settings safe to log: credentials masked."""
    return {k: ("***" if k in SECRET_KEYS else v) for k, v in settings.items()}
