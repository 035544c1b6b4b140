"""Shared pieces of the operators: reading tables, materialising results, column names."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.session import ensure_checkpoint_dir
from relearn.sources.tables import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


#: Spark's setting by which an execution's shuffle files go when it ends, not when the driver's garbage is collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """DataFrames made in here are executed once: their shuffle files go with the end of that."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder: read again from there, and never computed twice.

    What was shuffled for them goes from the disks at once, so an operator of many rounds holds one round's files."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint()


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: fold 0)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")
