"""Deterministic hash uniforms.

``rand(seed)`` and ``randomSplit`` draw from a per-partition stream, so the same
call gives other rows after a ``repartition`` or a retried task on a lost
executor.  ``U(seed, keys...)`` instead hashes a purpose string and the row key:
the value depends on the row only, survives recomputation, and the same formula
runs in other SQL engines (used by the oracle checks).

    U = first 32 bits of md5(seed | key1 | key2 ...) / 2^32     in [0, 1)

Lanes 1-3 (bits 32-127) of the same digest give further independent uniforms
for rows that need several (the generator).

Keys must be integers or strings; doubles format differently across engines.

Two hash methods:

* ``md5`` (default): portable; any SQL engine with md5 computes the same
  values, which is what the oracle checks rely on.  About 1.8 us per row.
* ``xxhash64``: Spark's built-in 64-bit hash of the typed key values, pure
  arithmetic inside generated code, several times cheaper per row.  Use it
  for production jobs on very large tables (``use_hash("xxhash64")`` at job
  start).  Values differ from ``md5`` and depend on the key column types
  (an int and a bigint 5 hash differently), so keep key types stable.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0
TWO_POW_60 = 1 << 60
#: Stands for a null key, so (a, null, b) and (a, b, null) differ.
NULL_KEY = "\x01"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(seed: str, *keys) -> Column:
    """``seed|k1|k2...`` as one string column (keys cast to string, null as ``NULL_KEY``)."""
    parts = [F.lit(str(seed))] + [F.coalesce(_as_col(k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    return F.concat_ws("|", *parts)


def hash_digest(seed: str, *keys) -> Column:
    """md5 hex digest of ``seed|k1|k2...``: four independent 32-bit lanes."""
    if not keys:
        raise ValueError("a hash uniform needs at least one key column")
    return F.md5(hash_key(seed, *keys))


def lane_uniform(digest: Column, lane: int = 0) -> Column:
    """Uniform in [0, 1) from 32-bit lane ``0..3`` of a ``hash_digest`` column.

    A row that needs several uniforms keeps the digest as a column and reads
    up to four lanes from it: one md5 instead of four.
    """
    if not 0 <= lane < 4:
        raise ValueError("an md5 digest has lanes 0..3")
    return F.conv(F.substring(digest, 8 * lane + 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


HASH_METHODS = ("md5", "xxhash64")
_method = "md5"


def use_hash(method: str) -> None:
    """Set the hash behind ``hash_uniform``/``hash_index`` for expressions built from now on."""
    global _method
    if method not in HASH_METHODS:
        raise ValueError(f"unknown hash method {method!r}; use one of {HASH_METHODS}")
    _method = method


def current_hash() -> str:
    return _method


def _top32(seed: str, keys, method: str | None) -> Column:
    """A bigint in [0, 2^32) fixed by (seed, keys)."""
    if not keys:
        raise ValueError("a hash uniform needs at least one key column")
    m = method or _method
    if m == "md5":
        return F.conv(F.substring(hash_digest(seed, *keys), 1, 8), 16, 10).cast("bigint")
    if m == "xxhash64":
        return F.shiftrightunsigned(_xxhash(seed, keys), 32)
    raise ValueError(f"unknown hash method {m!r}; use one of {HASH_METHODS}")


def _xxhash(seed: str, keys) -> Column:
    """xxhash64 of the typed keys; a null key also counts by its place (the hash function itself skips nulls)."""
    cols = [_as_col(k) for k in keys]
    places = F.concat(F.lit(""), *[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return F.xxhash64(F.lit(str(seed)), *cols, places)


def _top60(seed: str, keys, method: str | None) -> Column:
    """A decimal(19,0) in [0, 2^60) fixed by (seed, keys)."""
    if not keys:
        raise ValueError("a hash index needs at least one key column")
    m = method or _method
    if m == "md5":
        return F.conv(F.substring(hash_digest(seed, *keys), 1, 15), 16, 10).cast("decimal(19,0)")
    if m == "xxhash64":
        return F.shiftrightunsigned(_xxhash(seed, keys), 4).cast("decimal(19,0)")
    raise ValueError(f"unknown hash method {m!r}; use one of {HASH_METHODS}")


def hash_bits(seed: str, *keys, method: str | None = None) -> Column:
    """``U(seed, keys...) * 2^32`` as a bigint."""
    return _top32(seed, keys, method)


def hash_uniform(seed: str, *keys, method: str | None = None) -> Column:
    """``U(seed, keys...)``: a uniform double in [0, 1) fixed by the row key.

    With ``md5`` this is lane 0 of ``hash_digest(seed, keys)``.
    """
    return _top32(seed, keys, method) / F.lit(TWO_POW_32)


def hash_index(seed: str, n, *keys, method: str | None = None) -> Column:
    """``floor(U * n)`` in integer arithmetic: a uniform index in ``[0, n)``.

    ``n`` may be a Python int or a bigint column.  One formula for every bigint
    ``n``: 60 bits of the hash times ``n``, exactly in ``decimal(38,0)``, divided
    by 2^60 as an integer, so no rounding can push the index to ``n``.
    """
    n_col = n if isinstance(n, Column) else F.lit(int(n)).cast("bigint")
    scaled = _top60(seed, keys, method) * n_col.cast("decimal(19,0)")
    return F.call_function("div", scaled, F.lit(Decimal(TWO_POW_60)))
