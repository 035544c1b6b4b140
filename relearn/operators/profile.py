"""Profiling and feature selection.

The reference profiles its input with one Spark job per column (a null count
each) plus separate counts.  Here every profile is one aggregation pass: all
null counts come from a single ``agg`` and are unpivoted afterwards, so the
table is scanned once however many columns it has.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as a small DataFrame (position, column, type, nullable).

    Built from metadata on the driver; it has one row per column and reads no data.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    schema = "position int, column_name string, data_type string, nullable boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def dtype_map(df: DataFrame) -> dict[str, str]:
    """``dict(df.dtypes)``."""
    return dict(df.dtypes)


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def first_rows(df: DataFrame, k: int, order_cols: Sequence[str]) -> DataFrame:
    """The first ``k`` rows in a fixed order.

    ``orderBy(...).limit(k)`` is planned as a per-partition top-k plus a merge
    of ``k`` rows per task; nothing else is sorted or moved.
    """
    return df.orderBy(*order_cols).limit(k)


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def null_counts(df: DataFrame, columns: Iterable[str] | None = None,
                only_nonzero: bool = True) -> DataFrame:
    """Null count per column in one pass; by default only columns with nulls.

    Returns ``(column_name string, null_count bigint)``.
    """
    cols = list(columns) if columns is not None else df.columns
    if not cols:
        raise ValueError("no columns to profile")
    wide = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_count")) for i, c in enumerate(cols)]
    long = wide.select(F.inline(F.array(*rows)))
    return long.filter(F.col("null_count") > 0) if only_nonzero else long


def rows_and_nulls_by(df: DataFrame, group_col: str) -> DataFrame:
    """P4 + P9 in one pass: per group, ``n_rows`` and one null count per column.

    One row per group (e.g. two for a train/test split), columns
    ``group_col, n_rows, <column>...`` holding the null counts.
    """
    cols = [c for c in df.columns if c != group_col]
    return df.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     *[F.count_if(quoted(c).isNull()).alias(c) for c in cols])


def feature_columns(df: DataFrame, exclude: Iterable[str] = (), allow_boolean: bool = True) -> list[str]:
    """P5: feature columns chosen by type.

    Numeric (and boolean) columns not in ``exclude``.  The reference keeps every
    non-string column except the label and timestamp, which also picks integer
    ids and fails on any other timestamp column; here only types the vector
    assembler accepts are chosen, and ids are excluded by name.
    """
    skip = set(exclude)
    out = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.NumericType) or (allow_boolean and isinstance(f.dataType, T.BooleanType)):
            out.append(f.name)
    return out


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P10: column selection and order."""
    return df.select(*columns)


def label_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives and positive rate in percent, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.col(label)).cast("bigint").alias("positives"),
                  (F.avg(F.col(label).cast("double")) * 100).alias("positive_rate_pct"))
