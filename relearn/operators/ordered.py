"""Prefix sums and global ranks without a single-partition window.

A window with ``orderBy`` but no ``partitionBy`` moves every row into one task.
The pattern here keeps the work spread out:

1. ``repartitionByRange`` on (group keys, order keys): Spark samples the keys
   and cuts them into ``num_parts`` contiguous, balanced ranges;
2. a window *per range* (``partitionBy(group, part)``) gives the local prefix;
3. per-range totals (``num_parts * groups`` rows) get an exclusive prefix over
   the ranges of the same group: the offset of each range.

Only step 3 sees one row per range, bounded by ``num_parts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART = "__part"


def default_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_parts(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                num_parts: int | None = None) -> DataFrame:
    """Tag rows with the index of their key range (``__part``).

    Ranges are contiguous in (group, order) and numbered in key order, so for
    one group the ranges are ordered like the order keys.  A range boundary
    never splits equal keys.
    """
    n = num_parts or default_parts(df)
    keys = list(group_cols) + list(order_cols)
    return df.repartitionByRange(n, *keys).withColumn(PART, F.spark_partition_id())


def range_offsets(per_part: DataFrame, group_cols: Sequence[str], total_cols: Sequence[str],
                  prefix: str = "off_") -> DataFrame:
    """Exclusive prefix of per-range totals within each group.

    ``per_part`` has one row per (group, ``__part``); it is small (bounded by
    the number of ranges times groups), so this window is cheap.
    """
    w = (Window.partitionBy(*group_cols).orderBy(PART)
         .rowsBetween(Window.unboundedPreceding, -1))
    out = per_part
    for c in total_cols:
        out = out.withColumn(prefix + c, F.coalesce(F.sum(c).over(w), F.lit(0)))
    return out


def uniform_parts(df: DataFrame, uniform_col: str, num_parts: int | None = None) -> DataFrame:
    """Tag rows with ``floor(u * num_parts)`` for a column ``u`` uniform in [0, 1).

    For a hash uniform the buckets are balanced by construction, contiguous in
    ``u`` order, and a pure function of the row: no sampling, so every branch
    and every retry assigns the same bucket.
    """
    n = num_parts or default_parts(df)
    return df.withColumn(PART, F.least(F.floor(F.col(uniform_col) * n), F.lit(n - 1)).cast("int"))


def global_rank(df: DataFrame, order_cols: Sequence[str], out: str = "rank",
                group_cols: Sequence[str] = (), num_parts: int | None = None,
                uniform_first: bool = False) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (per group).

    ``order_cols`` must be unique within a group.  Equivalent to
    ``row_number() over (partition by group order by keys) - 1`` without a
    single-task window when there is no group.

    The ranked rows and the per-range sizes are two branches of one plan, so
    both must see the same ranges.  With ``uniform_first`` (the first order
    key is a hash uniform in [0, 1)) the ranges are deterministic buckets of
    it, and their sizes are counted beforehand and checkpointed, so the plan
    returned reads its input once.  Otherwise the range-partitioned rows are checkpointed to the shared
    checkpoint folder once (sampled range bounds are not repeatable across
    branches), and both branches read that copy.
    """
    from relearn.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    if uniform_first:
        tagged = uniform_parts(df, order_cols[0], num_parts)
    else:
        tagged = range_parts(df, order_cols, group_cols, num_parts).checkpoint(eager=True)
    sizes = tagged.groupBy(*group_cols, PART).agg(F.count(F.lit(1)).alias("__n"))
    if uniform_first:
        sizes = sizes.checkpoint(eager=True)
    local_w = Window.partitionBy(*group_cols, PART).orderBy(*order_cols)
    tagged = tagged.withColumn("__local", F.row_number().over(local_w) - 1)
    offsets = range_offsets(sizes, group_cols, ["__n"]).select(*group_cols, PART, "off___n")
    # Without groups the offsets table has exactly one row per range (bounded
    # by num_parts), so it is broadcast; with groups its size grows with the
    # number of groups and the join is left to the planner.
    if not group_cols:
        offsets = F.broadcast(offsets)
    ranked = tagged.join(offsets, list(group_cols) + [PART])
    return ranked.withColumn(out, (F.col("off___n") + F.col("__local")).cast("bigint")) \
        .drop(PART, "__local", "off___n")
