"""Operator 7: robust multivariate outliers by the minimum covariance determinant (DataFrame functions only).

Counts of each text become a vector of transformed statistics.  For every language and source a location and scatter
are estimated from the half of the rows, (n + ``DIM`` + 1) / 2, with the smallest covariance determinant: from three
deterministic starts (quartiles, moments, shortest halves), concentration steps keep the rows nearest to the present
estimate and estimate again until the determinant stops falling (by ``SETTLED``); the start with the smallest
determinant wins, then one reweighting step follows.  So up to nearly half of a group may be copies of one bad text.  A row is rejected if its squared Mahalanobis
distance to its group's estimate is over ``CUTOFF``.

"Nearest" is decided on a fixed grid of distances: counts per (group, grid cell) give the cell up to which rows
belong, so no group is ever sorted or gathered, a group of any size is one map-side combined aggregate, and results
don't depend on partitioning.  Every step reads the small table of statistics, never the texts.

Every variance has a floor (``FLOORS``): a statistic that is constant in most rows of a group (no symbols at all)
would otherwise make the smallest deviation an outlier, the exact-fit case of the estimator.
A group under ``MIN_GROUP`` rows is judged by the estimate of its whole language, one of a language under
``MIN_LANGUAGE`` rows by the estimate of all rows.  Only a table with under ``MIN_ALL`` rows that pass the base rules, too few
for a covariance of six statistics, is left unjudged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relearn.llm.common import cut

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

STATS = ["length", "symbols", "dup_lines", "repeats", "capitals", "size"]
#: Standard deviations that every statistic has at least.
FLOORS = [0.08, 0.3, 0.2, 0.15, 0.06, 0.7]
DIM = len(STATS)
SETTLED = 5e-3
MIN_GROUP, MIN_LANGUAGE, MIN_ALL = 200, 10 * DIM, 3 * DIM
#: Chi-square quantiles for six dimensions, 0.5, 0.975 and 0.999999.
MEDIAN, WEIGHT, CUTOFF = 5.348, 14.449, 38.258
GRID = 32          # cells per doubling of 1 + distance, and per unit of a statistic


def _let(value: Column, body) -> Column:
    """``body`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _count_of(chars: str, text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text."""
    def covered(w):
        hashed = F.slice(F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))),
                         F.lit(1), F.size(w) - 2)
        return _let(hashed, lambda g: F.when(F.size(F.array_distinct(g["h"])) == F.size(g), F.lit(0).cast("long"))
                    .otherwise(_let(F.array_sort(g), lambda s: _let(F.sort_array(F.transform(F.filter(s, lambda x, k: repeated(s, x, k)), lambda x: x["i"])), union))))

    def repeated(s, x, k):
        return F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))

    def union(p):
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return _let(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(covered(w)))


def counts(docs: DataFrame) -> DataFrame:
    """The base counts of each row of ``docs``, with lang and source."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    both = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    dups = _let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n"), F.size(x).cast("long").alias("lines")))
    bare = F.translate(text, SPACES, "")
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
        (F.col("lang").cast("string") if "lang" in docs.columns else none).alias("lang"),
        (F.col("source").cast("string") if "source" in docs.columns else none).alias("source"),
        both.alias("w"), F.length(bare).cast("long").alias("word_chars"), _count_of(SYMBOLS, text).cast("long").alias("n_symbols"),
        dups.alias("d"), _count_of(CAPITALS, text).cast("long").alias("n_capitals"))


def statistics(counted: DataFrame) -> DataFrame:
    """Base counts, the base verdict and the transformed vector."""
    n, chars = F.greatest("w.n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    base = (F.col("w.n_words") < 50) | (100 * F.col("w.n_repeat_words") > 50 * F.col("w.n_words"))
    return counted.select(
        "doc_id", "text_key", "lang", "source", F.col("w.n_words").alias("n_words"), "word_chars", "n_symbols", F.col("d.n").alias("n_dup_lines"),
        F.col("w.n_repeat_words").alias("n_repeat_words"), base.alias("base_failed"),
        F.log(chars / n).alias("length"), F.log1p(100 * F.col("n_symbols") / chars).alias("symbols"),
        F.sqrt(F.col("d.n") / F.greatest("d.lines", F.lit(1))).alias("dup_lines"), F.sqrt(F.col("w.n_repeat_words") / n).alias("repeats"),
        F.sqrt(F.col("n_capitals") / chars).alias("capitals"), F.log(n).alias("size"))


def with_groups(stats: DataFrame, min_group: int) -> DataFrame:
    """Adds the group that judges each row (its language and source, its language, or all) and ``fits``: the groups that its
    statistics count for, which are its own and those that judge some small group."""
    named = stats.withColumn("lang_key", F.coalesce("lang", F.lit("\x00"))).withColumn("source_key", F.coalesce("source", F.lit("\x00")))
    sizes = named.groupBy("lang_key", "source_key").agg(F.count_if(~F.col("base_failed")).alias("n"))
    w = Window.partitionBy("lang_key")
    sizes = sizes.withColumn("of_language", F.sum("n").over(w)).withColumn("has_small", F.max(F.col("n").between(1, min_group - 1)).over(w))
    level = F.when(F.col("n") >= min_group, F.lit(0)).when(F.col("of_language") >= min(MIN_LANGUAGE, min_group), F.lit(1)).otherwise(F.lit(2))
    levels = sizes.withColumn("level", level)
    needed = F.max((F.col("level") == 2) & (F.col("n") > 0)) & (F.sum("n") >= min(MIN_ALL, min_group))
    rest = levels.agg(F.coalesce(needed, F.lit(False)).alias("all_judges"))
    levels = levels.crossJoin(rest).select("lang_key", "source_key", "level", "of_language", "has_small", "all_judges")      # one row
    own, language, whole = F.to_json(F.array("lang_key", "source_key")), F.to_json(F.array("lang_key")), F.lit("[]")
    group = F.when(F.col("level") == 0, own).when(F.col("level") == 1, language).otherwise(whole)
    fits = F.array(F.when(F.col("level") == 0, own), F.when(F.col("has_small") & (F.col("of_language") >= min(MIN_LANGUAGE, min_group)), language), F.when(F.col("all_judges"), whole))
    return (named.join(levels, ["lang_key", "source_key"], "left").withColumn("group", group).withColumn("fits", F.filter(fits, lambda x: x.isNotNull()))
            .drop("lang_key", "source_key", "level", "of_language", "has_small", "all_judges"))


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIM) for j in range(i + 1)]


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds columns by SQL text: building a Column object for each operation took the driver about as long as the rounds."""
    return df.selectExpr("*", *[f"{e} AS {c}" for c, e in columns.items()])


def _factor(est: DataFrame) -> DataFrame:
    """From mean m_i and covariance s_i_j: the inverse r_i_j of its Cholesky factor and the log determinant."""
    def rest(i: int, j: int) -> str:
        return " - ".join([f"s_{i}_{j}", *[f"l_{i}_{k} * l_{j}_{k}" for k in range(j)]])
    for j in range(DIM):              # a column of the factor at a time, then a row of its inverse
        est = _with(est, {f"l_{j}_{j}": f"sqrt(greatest({rest(j, j)}, {FLOORS[j] ** 2 / 16!r}D))"})
        if j + 1 < DIM:
            est = _with(est, {f"l_{i}_{j}": f"({rest(i, j)}) / l_{j}_{j}" for i in range(j + 1, DIM)})
    for i in range(DIM):
        est = _with(est, {f"r_{i}_{j}": f"({'1.0D' if i == j else '0.0D'}{''.join(f' - l_{i}_{k} * r_{k}_{j}' for k in range(j, i))}) / l_{i}_{i}" for j in range(i + 1)})
    det = " + ".join(f"ln(l_{i}_{i})" for i in range(DIM))
    keep = ["group", "start", F.expr(det).alias("det")] + [f"m_{i}" for i in range(DIM)] + [f"r_{i}_{j}" for i, j in _pairs()]
    return cut(est.select(*keep, *[c for c in est.columns if c == "old"]))


#: Names of the sums of rows and of products that moments come from.
SUMS = [f"sum_{i}" for i in range(DIM)] + [f"sum_{i}_{j}" for i, j in _pairs()]


def _sums() -> list[Column]:
    """Count, sums and sums of products of rows.  Statistics are logarithms and roots, so 22 at most, and every variance has a
    floor: these sums lose no digit that counts."""
    terms = STATS + [f"{STATS[i]} * {STATS[j]}" for i, j in _pairs()]
    return [F.expr("count(*) AS n"), *[F.expr(f"sum({term}) AS {name}") for term, name in zip(terms, SUMS)]]


def _moments(sums: DataFrame) -> DataFrame:
    """Adds mean and covariance (with floors) to rows of ``_sums``."""
    sums = _with(sums, {f"m_{i}": f"sum_{i} / n" for i in range(DIM)})
    return _with(sums, {f"s_{i}_{j}": f"sum_{i}_{j} / n - m_{i} * m_{j} + {FLOORS[i] ** 2 if i == j else 0.0!r}D" for i, j in _pairs()})


def _distance() -> Column:
    z = ["(" + " + ".join(f"r_{i}_{j} * ({STATS[j]} - m_{j})" for j in range(i + 1)) + ")" for i in range(DIM)]
    return F.expr(" + ".join(f"{x} * {x}" for x in z))


def _measured(rows: DataFrame, est: DataFrame) -> DataFrame:
    """The rows of groups that have an estimate, per start, with distance and its grid cell."""
    out = rows.join(est, "group").withColumn("distance", _distance())
    return out.withColumn("cell", F.floor(F.log2(1 + F.col("distance")) * GRID))


def _running(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds to counts ``n`` per cell those of a key's cells up to it (``upto``) and of all."""
    w = Window.partitionBy(*keys)
    return cells.withColumn("upto", F.sum("n").over(w.orderBy("cell"))).withColumn("all", F.sum("n").over(w))


def _cell_at(cells: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """From counts ``n`` per cell: for each name the first cell by which its share of a key's rows is reached."""
    at = [F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("cell"))).alias(name) for name, share in shares.items()]
    return _running(cells, keys).groupBy(*keys).agg(*at)


def _concentrated(rows: DataFrame, est: DataFrame) -> DataFrame:
    """The estimate of the nearest half of the rows of each group and start, and ``old``, the determinant of ``est``.

    Sums are kept for each cell, so one pass gives both the cell that ends the half and the moments of the rows up to it."""
    keys = ["group", "start"]
    cells = _measured(rows, est).groupBy(*keys, "cell").agg(*_sums(), F.max("det").alias("old"))
    half = _running(cells, keys).where(F.col("upto") - F.col("n") < 0.5 * F.col("all") + (DIM + 1) / 2)
    sums = half.groupBy(*keys).agg(*[F.expr(f"sum({c}) AS {c}") for c in ["n", *SUMS]], F.max("old").alias("old"))
    return _factor(_moments(sums))


def _shortest_halves(cells: DataFrame) -> DataFrame:
    """From counts ``n`` per group, dim and cell: first and last cell (lo, hi) of the shortest run with half of the rows."""
    w, unit = Window.partitionBy("group", "dim"), 1 << 20
    before = F.col("upto") - F.col("n")
    run = cells.withColumn("upto", F.sum("n").over(w.orderBy("cell"))).withColumn("all", F.sum("n").over(w)).withColumn("top", F.max("cell").over(w))
    run = run.withColumn("prev", F.lag("cell").over(w.orderBy("cell"))).withColumn("place", F.floor(before * (2.0 * unit) / F.col("all")))
    last = F.first("prev").over(w.orderBy("place").rangeBetween(unit, Window.unboundedFollowing))
    run = run.withColumn("hi", F.coalesce(last, F.when(2 * before <= F.col("all"), F.col("top")))).where("hi is not null")
    best = run.groupBy("group", "dim").agg(F.min(F.struct((F.col("hi") - F.col("cell")).alias("width"), "cell", "hi")).alias("b"))
    return best.select("group", "dim", F.col("b.cell").alias("lo"), ((F.col("b.cell") + F.col("b.hi")) / 2).alias("mid"), F.col("b.hi").alias("hi"))


def _grid_starts(rows: DataFrame) -> DataFrame:
    """Median and quartile range (start 0), middle and length of the shortest half (2) of every statistic, from counts on a grid."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("dim"), F.floor(F.col(c) * GRID * 4).alias("cell")) for i, c in enumerate(STATS)]))
    cells = cut(rows.select("group", each.alias("e")).groupBy("group", "e.dim", "e.cell").agg(F.count("*").alias("n")))
    quartiles = _cell_at(cells, ["group", "dim"], {"lo": 0.25, "mid": 0.5, "hi": 0.75})
    at = quartiles.withColumn("start", F.lit(0)).unionByName(_shortest_halves(cells).withColumn("start", F.lit(2)))
    cols = []
    for i in range(DIM):
        cols.append(F.expr(f"max(CASE WHEN dim = {i} THEN (mid + 0.5D) / {GRID * 4.0}D END) AS m_{i}"))
        cols.append(F.expr(f"pow(max(CASE WHEN dim = {i} THEN (hi - lo) / {GRID * 4.0}D END) / 1.349D, 2) + {FLOORS[i] ** 2!r}D AS s_{i}_{i}"))
    out = at.groupBy("group", "start").agg(*cols)
    return _with(out, {f"s_{i}_{j}": "0.0D" for i, j in _pairs() if i != j})


def _scaled(rows: DataFrame, est: DataFrame) -> DataFrame:
    """Adds ``factor``: the median distance over its normal value; 1 at least, as the floors shorten distances."""
    cells = _measured(rows, est).groupBy("group", "start", "cell").agg(F.count("*").alias("n"))
    mid = _cell_at(cells, ["group", "start"], {"mid": 0.5})
    middle = F.pow(F.lit(2.0), (F.col("mid") + 0.5) / GRID) - 1
    return cut(est.join(mid.select("group", "start", F.greatest(middle / MEDIAN, F.lit(1.0)).alias("factor")), ["group", "start"]))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """Location, scatter (inverse factor) and ``factor`` per group of the rows (group and the statistics)."""
    moments = _moments(rows.groupBy("group", F.lit(1).alias("start")).agg(*_sums()))
    est = _grid_starts(rows)
    est, least = _factor(est.unionByName(moments.select(*est.columns))), None
    while True:
        est = _concentrated(rows, est)
        fall, total = est.agg(F.max(F.col("old") - F.col("det")), F.sum("det")).first()
        # a start is no subset, so two steps at least; on a grid steps could go round, so the sum has to fall too
        if fall is None or least is not None and (fall <= SETTLED or total >= least):
            break
        least = total
    best = F.min(F.struct("det", "start", *[c for c in est.columns if c not in ("group", "start", "det", "old")]))
    est = _scaled(rows, est.groupBy("group").agg(best.alias("b")).select("group", "b.*"))
    inner = _measured(rows, est).where(F.col("distance") <= WEIGHT * F.col("factor"))
    return _scaled(rows, _factor(_moments(inner.groupBy("group", "start").agg(*_sums()))))


def quality_rules(docs: DataFrame, min_group: int = MIN_GROUP, cutoff: float = CUTOFF) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance, text_key)``.

    One row per row of ``docs``, repeated rows included; text_key is xxhash64 of the text; distance is the squared Mahalanobis distance over the
    group's factor, null for rows that failed the base rules (under 50 words, or over half of them in repeated
    three-word windows) and for all rows of a table under ``MIN_ALL`` rows, which are kept.  Null and empty texts have no
    words and fail.  A null or missing lang or source is a group of its own.  An empty table gives no rows.
    """
    stats = cut(with_groups(cut(statistics(counts(docs))), min_group))
    est = robust_estimates(stats.where("not base_failed").select(F.explode("fits").alias("group"), *STATS))
    judged = stats.join(est.drop("start", "det"), "group", "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.col("factor"))
    out = judged.withColumn("distance", distance)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance", "text_key")
