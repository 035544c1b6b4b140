"""Label encoding, sampling, splits and A/B arm assignment.

All random choices use the hash uniform ``U(seed, key)``: a row lands in the
same split or arm on every run, after any repartition and after a retried
task.  The assignments are plain deterministic expressions, so no shuffle is
needed; a hash can't be pushed into Parquet, so all rows of the needed columns
are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_bits, hash_uniform
from relearn.operators.ordered import global_rank
from relearn.session import ensure_checkpoint_dir

# Label map of the URL data (bad -> 1, good -> 0, else null).
URL_LABEL_MAP = {"bad": 1, "good": 0}


def encode_labels(df: DataFrame, col: str, mapping: dict | None = None,
                  out: str = "label_enc") -> DataFrame:
    """Map label values to integers; values outside the map become null."""
    mapping = URL_LABEL_MAP if mapping is None else mapping
    expr = None
    for value, code in mapping.items():
        cond = F.col(col) == F.lit(value)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return df.withColumn(out, expr.cast("int"))


def sample_rows(df: DataFrame, fraction: float, seed: str, key: Sequence) -> DataFrame:
    """Rows sampled without replacement with probability ``fraction``.

    Exact and repeatable per row (unlike ``df.sample``), size is binomial
    around ``fraction * n`` as with Spark's own sampler.
    """
    return df.filter(hash_uniform(seed, *key) < F.lit(float(fraction)))


def _reached(counts: DataFrame, wanted: Callable[[int], int]) -> tuple[int, int, int] | None:
    """From counts ``n`` per value ``p``: the first value by which ``wanted(all)`` rows are reached, how many of its rows that takes, and its rows."""
    upto = F.sum("n").over(Window.orderBy("p"))                              # of 65,536 counts at most
    run = counts.select("p", "n", upto.alias("upto"), F.sum("n").over(Window.partitionBy()).alias("all")).checkpoint()
    k = wanted(run.agg(F.max("all")).first()[0] or 0)
    if k <= 0:
        return None
    hit = run.where(F.col("upto") >= k).orderBy("p").first()
    return hit["p"], k - (hit["upto"] - hit["n"]), hit["n"]


def hash_rank_cut(df: DataFrame, u: Column, size_of: Callable[[int], int]) -> tuple[int, int, int] | None:
    """Where the ``size_of(rows)`` smallest values of a 32-bit hash end: the value, how many of its rows belong, and its rows.

    Two counting passes, by the upper and by the lower 16 bits: at most 65,536 counts each, whatever the number of
    rows, and no sort of rows.  None for a size of 0.
    """
    ensure_checkpoint_dir(df.sparkSession)
    high = _reached(df.groupBy(F.shiftright(u, 16).alias("p")).agg(F.count(F.lit(1)).alias("n")), size_of)
    if high is None:
        return None
    inside = df.where(F.shiftright(u, 16) == high[0]).groupBy(u.bitwiseAND(F.lit(0xFFFF)).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    low, missing, ties = _reached(inside, lambda _: high[1])
    return (high[0] << 16) | low, missing, ties


def sample_exact(df: DataFrame, fraction: float, seed: str, key: Sequence[str]) -> DataFrame:
    """P7 with an exact size: ``round(fraction * rows)`` rows (half to even), those with the smallest hash uniforms.

    ``key`` are names of columns.  The hash value where the sample ends is found by counts (``hash_rank_cut``), so the
    sample is a filter.  Only if that value's rows don't all belong are they ranked by the key; rows that are equal
    in the key too are taken in any order.  Nothing is sorted in one task.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    u = hash_bits(seed, *key)
    end = hash_rank_cut(df, u, lambda n: round(fraction * n))
    if end is None:
        return df.where(F.lit(False))
    value, missing, ties = end
    if missing == ties:
        return df.where(u <= value)
    same = df.where(u == value).checkpoint().withColumn("__tie", F.monotonically_increasing_id())
    some = global_rank(same, [*key, "__tie"], out="__rank").where(F.col("__rank") < missing)
    return df.where(u < value).unionByName(some.drop("__tie", "__rank"))


def sample_complement(df: DataFrame, fraction: float, seed: str, key: Sequence) -> DataFrame:
    """The rows a ``sample_rows`` call with the same arguments leaves out.

    The hash filter is negated instead of anti-joining the sample back, which
    would shuffle both sides.
    """
    return df.filter(hash_uniform(seed, *key) >= F.lit(float(fraction)))


def anti_join_complement(df: DataFrame, sample: DataFrame, key_names: Sequence[str]) -> DataFrame:
    """P12 for a sample drawn by other means: rows of ``df`` absent from ``sample``."""
    return df.join(sample.select(*key_names).distinct(), list(key_names), "left_anti")


def split_column(weights: Sequence[float], seed: str, key: Sequence,
                 names: Sequence[str] = ("train", "test")) -> Column:
    """The split name of a row for normalised ``weights``.

    ``randomSplit([0.005, 0.0001])`` normalises the weights, so it keeps all
    rows (98.04 % / 1.96 %); this does the same.  Use ``sample_rows`` first
    to work on part of the data.
    """
    if len(weights) != len(names) or len(weights) < 2:
        raise ValueError("need one name per weight and at least two weights")
    if any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    u = hash_uniform(seed, *key)
    cumulative = 0.0
    expr = None
    for w, name in zip(weights[:-1], names[:-1]):
        cumulative += w / total
        cond = u < F.lit(cumulative)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def weighted_split(df: DataFrame, weights: Sequence[float], seed: str, key: Sequence,
                   names: Sequence[str] = ("train", "test"), col: str = "split") -> DataFrame:
    """One DataFrame with a ``split`` column; filter it for each part."""
    return df.withColumn(col, split_column(weights, seed, key, names))


def split_parts(df: DataFrame, weights: Sequence[float], seed: str, key: Sequence,
                names: Sequence[str] = ("train", "test")) -> list[DataFrame]:
    """P8 as ``randomSplit`` returns it: one DataFrame per part, disjoint, complete."""
    tagged = weighted_split(df, weights, seed, key, names, col="__split")
    return [tagged.filter(F.col("__split") == n).drop("__split") for n in names]


def split_sizes(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split (one partial + final aggregate, a few output rows)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def assign_arms(df: DataFrame, traffic_split: float, seed: str, key: Sequence,
                col: str = "ab_group") -> DataFrame:
    """A1: ``challenger`` with probability ``traffic_split``, else ``champion``."""
    if not 0.0 <= traffic_split <= 1.0:
        raise ValueError("traffic_split must lie in [0, 1]")
    u = hash_uniform(seed, *key)
    return df.withColumn(col, F.when(u < F.lit(float(traffic_split)), F.lit("challenger"))
                         .otherwise(F.lit("champion")))


def arm_sizes(df: DataFrame, col: str = "ab_group") -> DataFrame:
    """A2: both arm sizes in one row; an empty arm gives 0, not a missing row."""
    return df.agg(F.count_if(F.col(col) == "champion").alias("champion_count"),
                  F.count_if(F.col(col) == "challenger").alias("challenger_count"))


def arm_rows(df: DataFrame, arm: str, col: str = "ab_group") -> DataFrame:
    """A3: the rows of one arm."""
    return df.filter(F.col(col) == F.lit(arm))
