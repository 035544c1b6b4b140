"""Paired bootstrap of binary metrics.

Every metric of the reference's bootstrap (F1, precision, recall, label AUC)
depends only on the confusion counts.  For two models scored on the same rows
the joint state of a row is one of 8 cells (label, base prediction, candidate
prediction), so a resample of n rows with replacement is fully described by
its 8 cell counts, and both models are measured on the same resample (the
pairing the reference gets from re-seeding).

Step 1 (the data work) is one aggregation over the predictions: 8 counts.
Step 2 draws the resamples, two exact ways:

* ``draws``: n uniform row positions per iteration from the hash uniform,
  mapped to cells by the cumulative counts, counted per (iteration, cell).
  Reproducible in plain SQL, cost O(B * n), spread over all tasks.
* ``multinomial``: per iteration one Multinomial(n, counts / n) draw (the same
  distribution) as seven conditional binomials, each the inverse of its
  distribution at a hash uniform of (seed, iteration, cell); cost O(B sqrt(n)).
  This is the path for very large n.

Nothing but the 8 counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_index
from relearn.operators.metrics import (auc_label_expr, f1_binary_expr, precision_expr,
                                       recall_expr)

N_CELLS = 8
DRAWS_PER_TASK = 1_000_000
CELL_COLS = [f"k{i}" for i in range(N_CELLS)]

# cell = 4 * label + 2 * base prediction + candidate prediction.  Cells of the
# confusion counts of each model:
MODEL_CELLS = {
    "base": {"tp": (6, 7), "fp": (2, 3), "fn": (4, 5), "tn": (0, 1)},
    "candidate": {"tp": (5, 7), "fp": (1, 3), "fn": (4, 6), "tn": (0, 2)},
}


def joint_cells(df: DataFrame, label: str, base_pred: str, cand_pred: str) -> DataFrame:
    """Step 1: one row with the 8 cell counts ``c0..c7`` and ``n``.

    Rows with a null label or prediction fall in no cell.
    """
    cell = F.col(label) * 4 + F.col(base_pred) * 2 + F.col(cand_pred)
    counts = df.agg(*[F.count_if(cell == i).alias(f"c{i}") for i in range(N_CELLS)])
    return counts.withColumn("n", sum((F.col(f"c{i}") for i in range(N_CELLS)), F.lit(0)))


def _cell_counts(cells: DataFrame) -> list[int]:
    row = cells.first()  # one row of 8 integers
    return [int(row[f"c{i}"]) for i in range(N_CELLS)]


def cell_of(pos, counts: list[int]):
    """The cell of a row position: cells take their counts of positions one after another."""
    upto, expr = 0, None
    for i, c in enumerate(counts[:-1]):
        upto += c
        cond = pos < F.lit(upto)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(N_CELLS - 1))


def resample_draws(spark: SparkSession, counts: list[int], iterations: int,
                   seed: str = "boot", num_partitions: int | None = None) -> DataFrame:
    """Step 2, ``draws``: (iteration, k0..k7) from B * n hashed row positions."""
    n = sum(counts)
    if n <= 0:
        raise ValueError("bootstrap needs at least one row")
    total = iterations * n
    if total >= 2 ** 63:
        raise ValueError(f"{iterations} resamples of {n} rows: their row numbers don't fit a bigint")
    # at least one task per core, at most DRAWS_PER_TASK draws per task; a
    # draw depends on its id only, so the split does not change the counts
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, -(-total // DRAWS_PER_TASK))
    pos = hash_index(seed, n, F.col("id"))
    cell = cell_of(F.col("pos"), counts)
    draws = (spark.range(0, total, 1, parts)
             .select(F.expr(f"id div {n}").alias("iteration"), pos.alias("pos"))
             .select("iteration", cell.alias("cell")))
    return (draws.groupBy("iteration")
            .agg(*[F.count_if(F.col("cell") == i).alias(f"k{i}") for i in range(N_CELLS)]))


#: Standard deviations on either side of the mode that a binomial draw looks at: beyond is less than a uniform resolves.
REACH = 12
UNIFORM_BITS = 52


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def binomial(u: Column, n: Column, p: Column) -> Column:
    """A Binomial(n, p) number (bigint) from a uniform ``u`` in [0, 1), as an expression.

    Values are taken in the order mode, mode + 1, ... and then mode - 1, ... down; ``u`` times their total weight falls
    into one of them.  Weights follow from the mode's (1) by the ratio of neighbours, so nothing underflows."""
    def ends(v: Column) -> Column:
        reach = F.ceil(REACH * F.sqrt(v["n"] * v["p"] * (1 - v["p"]))) + REACH
        mode = F.least(F.floor((v["n"] + 1) * v["p"]), v["n"])
        return F.struct(v["u"].alias("u"), v["n"].alias("n"), (v["p"] / (1 - v["p"])).alias("r"), mode.alias("mode"),
                        F.least(v["n"], mode + reach).alias("hi"), F.greatest(F.lit(0).cast("bigint"), mode - reach).alias("lo"))

    def up(v, a, k):                  # the weight after that of k
        return a["w"] * (v["n"] - k) / (k + 1) * v["r"]

    def down(v, a, k):                # the weight of k - 1
        return a["w"] * k / (v["n"] - k + 1) / v["r"]

    def above(v):
        return F.sequence(v["mode"], v["hi"])

    def below(v):
        return F.when(v["mode"] > v["lo"], F.sequence(v["mode"], v["lo"] + 1, F.lit(-1).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"))

    def sums(v: Column) -> Column:
        over = F.aggregate(above(v), start, lambda a, k: F.struct(up(v, a, k).alias("w"), (a["s"] + a["w"]).alias("s")))["s"]
        under = F.aggregate(below(v), start, lambda a, k: F.struct(down(v, a, k).alias("w"), (a["s"] + down(v, a, k)).alias("s")))["s"]
        return F.struct(v.alias("v"), over.alias("over"), (v["u"] * (over + under)).alias("t"))

    def chosen(x: Column) -> Column:
        v, none = x["v"], F.lit(None).cast("bigint")
        first = F.struct(F.lit(1.0).alias("w"), x["t"].alias("s"), none.alias("k"))
        high = F.aggregate(above(v), first, lambda a, k: F.struct(up(v, a, k).alias("w"), (a["s"] - a["w"]).alias("s"), F.when(a["k"].isNull() & (a["s"] < a["w"]), k).otherwise(a["k"]).alias("k")))["k"]
        rest = F.struct(F.lit(1.0).alias("w"), (x["t"] - x["over"]).alias("s"), none.alias("k"))
        low = F.aggregate(below(v), rest, lambda a, k: F.struct(down(v, a, k).alias("w"), (a["s"] - down(v, a, k)).alias("s"), F.when(a["k"].isNull() & (a["s"] < down(v, a, k)), k - 1).otherwise(a["k"]).alias("k")))["k"]
        return F.when(x["t"] < x["over"], F.coalesce(high, v["hi"])).otherwise(F.coalesce(low, v["lo"]))
    inner = _let(ends(F.struct(u.alias("u"), n.cast("bigint").alias("n"), p.alias("p"))), lambda v: _let(sums(v), chosen))
    return F.when((n <= 0) | (p <= 0), F.lit(0).cast("bigint")).when(p >= 1, n.cast("bigint")).otherwise(inner)


def resample_multinomial(spark: SparkSession, counts: list[int], iterations: int,
                         seed: str = "boot", num_partitions: int | None = None) -> DataFrame:
    """Step 2, ``multinomial``: one exact Multinomial(n, p) draw per iteration.

    Iterations are spread over tasks; each draw depends on (seed, iteration, cell) only, so a
    retried task gives the same numbers.
    """
    n = int(sum(counts))
    if n <= 0:
        raise ValueError("bootstrap needs at least one row")
    left, shares = n, []
    for c in counts[:-1]:             # of a cell among the cells from it on
        shares.append(c / left if left else 0.0)
        left -= c
    parts = num_partitions or max(1, min(iterations, spark.sparkContext.defaultParallelism))
    out = spark.range(0, iterations, 1, parts).select(F.col("id").alias("iteration"), F.lit(n).cast("bigint").alias("__left"))
    for i, share in enumerate(shares):
        u = hash_index(seed, 1 << UNIFORM_BITS, F.col("iteration"), F.lit(i)) / F.lit(float(1 << UNIFORM_BITS))
        out = out.withColumn(CELL_COLS[i], binomial(u, F.col("__left"), F.lit(share))).withColumn("__left", F.col("__left") - F.col(CELL_COLS[i]))
    return out.withColumnRenamed("__left", CELL_COLS[-1]).select("iteration", *CELL_COLS)


def resample(spark: SparkSession, cells: DataFrame, iterations: int = 100, seed: str = "boot",
             method: str = "multinomial") -> DataFrame:
    """E7 step 2 for a ``joint_cells`` row: per-iteration cell counts."""
    counts = _cell_counts(cells)
    if method == "draws":
        return resample_draws(spark, counts, iterations, seed)
    if method == "multinomial":
        return resample_multinomial(spark, counts, iterations, seed)
    raise ValueError(f"unknown bootstrap method {method!r}")


def bootstrap_scores(resampled: DataFrame) -> DataFrame:
    """E7 output: (iteration, model, f1, precision, recall, auc) for both models.

    ``f1``/``precision``/``recall`` are binary (class 1, 0 when undefined);
    ``auc`` is the label AUC, NULL for a resample with one class.
    """
    # both models from one pass over the resamples (no union re-reading them)
    rows = [F.struct(F.lit(model).alias("model"),
                     *[sum((F.col(f"k{i}") for i in idx), F.lit(0)).alias(name) for name, idx in cells.items()])
            for model, cells in MODEL_CELLS.items()]
    both = resampled.select("iteration", F.explode(F.array(*rows)).alias("__m")).select("iteration", "__m.*")
    return both.select("iteration", "model",
                       f1_binary_expr().alias("f1"), precision_expr().alias("precision"),
                       recall_expr().alias("recall"), auc_label_expr().alias("auc"))


def paired_bootstrap(df: DataFrame, label: str, base_pred: str, cand_pred: str,
                     iterations: int = 100, seed: str = "boot",
                     method: str = "multinomial") -> DataFrame:
    """E7 end to end: predictions -> per-iteration metrics of both models."""
    cells = joint_cells(df, label, base_pred, cand_pred)
    return bootstrap_scores(resample(df.sparkSession, cells, iterations, seed, method))
