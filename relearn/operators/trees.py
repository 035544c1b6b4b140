"""Decision trees as tables.

* ``forest_nodes``: a fitted forest's nodes as rows.
* ``prune_forest``: the forest as it is if nodes of fewer than ``min_samples_split`` rows are not split.  MLlib has no
  such parameter, but it stores every node's row count, and a limit on splitting changes nothing above the node that
  it stops: cutting the grown tree there gives the tree grown under the limit.  (With random feature subsets it is one
  of the trees that could have been drawn: the subsets drawn below the cut are unused.)
* ``cut_forest``: the forest as it is if it is grown to a smaller depth.
* ``with_thresholds``: a forest grown on numbers of bins, as a forest of the values.
* ``grow_tree``: one tree grown by aggregations: class counts per (node, feature, bin), running sums over the bins,
  the split with the largest Gini gain per node.  What a level gathers is nodes x features x bins rows, whatever the
  number of rows; it checks MLlib's fits exactly where bins hold one value each.

A model's tables are small (trees x nodes); they are read and written with Spark so that a model in an object store
needs no local copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relearn.session import checkpoint_path

NO_SPLIT = "named_struct('featureIndex', -1, 'leftCategoriesOrThreshold', cast(array() as array<double>), 'numCategories', -1)"


def _saved(model: RandomForestClassificationModel, spark: SparkSession) -> str:
    path = checkpoint_path(spark, f"forests/{uuid.uuid4().hex}")
    model.save(path)
    return path


def _walk(spark: SparkSession, nodes: DataFrame, goes_on: str) -> DataFrame:
    """Nodes that are reached from the roots through nodes for which ``goes_on`` holds: (tree, id, place, depth).

    place numbers a node as in a heap: the root is 1, the children of i are 2i and 2i + 1."""
    name = f"tree_nodes_{uuid.uuid4().hex}"
    nodes.createOrReplaceTempView(name)
    try:
        out = spark.sql(f"""
            WITH RECURSIVE reached(tree, id, place, depth) AS (
                SELECT tree, id, CAST(1 AS BIGINT), 0 FROM {name} WHERE id = 0
                UNION ALL
                SELECT r.tree, c.child, 2 * r.place + c.side, r.depth + 1
                FROM reached r JOIN (SELECT tree, id, inline(array(struct(left AS child, 0 AS side), struct(right AS child, 1 AS side)))
                                     FROM {name} WHERE left >= 0 AND {goes_on}) c ON r.tree = c.tree AND r.id = c.id)
            SELECT * FROM reached""")
        return out.checkpoint()
    finally:
        spark.catalog.dropTempView(name)


def _node_rows(spark: SparkSession, path: str) -> DataFrame:
    n = "nodeData"
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("id"), F.col(f"{n}.leftChild").alias("left"), F.col(f"{n}.rightChild").alias("right"),
        F.col(f"{n}.split.featureIndex").alias("feature"), F.get(f"{n}.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col(f"{n}.rawCount").alias("n"), F.col(f"{n}.impurityStats").alias("stats"), F.col(f"{n}.gain").alias("gain"))


def forest_nodes(model: RandomForestClassificationModel, spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """``(tree, place, depth, feature, threshold, n, stats, gain)``: feature and threshold are null for leaves; n counts the
    tree's (bootstrap) rows, stats the rows by class."""
    rows = _node_rows(spark, _saved(model, spark))
    places = _walk(spark, rows, "true")
    inner = F.col("left") >= 0
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    return rows.join(places, ["tree", "id"]).select(
        "tree", "place", "depth", F.when(inner, name).alias("feature"), F.when(inner, F.col("threshold")).alias("threshold"), "n", "stats",
        F.when(inner, F.col("gain")).alias("gain"))


def _written(model_path: str, kept: DataFrame, leaf, spark: SparkSession) -> RandomForestClassificationModel:
    """The saved forest with the nodes ``kept`` (tree, id) alone; those for which ``leaf`` holds are leaves."""
    out = checkpoint_path(spark, f"forests/{uuid.uuid4().hex}")
    kept = kept.withColumn("new", (F.row_number().over(Window.partitionBy("tree").orderBy("id")) - 1).cast("int"))   # bounded by the tree's depth
    ids = F.broadcast(kept.withColumnRenamed("tree", "treeID"))       # a row per node of the model
    full = spark.read.parquet(f"{model_path}/data").select("treeID", "nodeData.*").join(ids, ["treeID", "id"])
    for side in ("leftChild", "rightChild"):
        to = F.broadcast(kept.select(F.col("tree").alias("treeID"), F.col("id").alias(side), F.col("new").alias(f"{side}_new")))
        full = full.join(to, ["treeID", side], "left")
    node = F.struct(
        F.col("new").alias("id"), "prediction", "impurity", "impurityStats", "rawCount", F.when(leaf, F.lit(-1.0)).otherwise(F.col("gain")).alias("gain"),
        *[F.when(leaf, F.lit(-1)).otherwise(F.col(f"{s}_new")).alias(s) for s in ("leftChild", "rightChild")],
        F.when(leaf, F.expr(NO_SPLIT)).otherwise(F.col("split")).alias("split"))
    full.select("treeID", node.alias("nodeData")).write.parquet(f"{out}/data")
    spark.read.parquet(f"{model_path}/treesMetadata").write.parquet(f"{out}/treesMetadata")
    spark.read.text(f"{model_path}/metadata").coalesce(1).write.text(f"{out}/metadata")       # one line
    return RandomForestClassificationModel.load(out)


def prune_forest(model: RandomForestClassificationModel, spark: SparkSession, min_samples_split: int) -> RandomForestClassificationModel:
    """The forest without the splits of nodes that have fewer than ``min_samples_split`` rows, as a model of its own."""
    if min_samples_split <= 2:                        # one row can't be split anyway
        return model
    path, limit = _saved(model, spark), int(min_samples_split)
    kept = _walk(spark, _node_rows(spark, path), f"n >= {limit}").select("tree", "id")
    return _written(path, kept, (F.col("leftChild") < 0) | (F.col("rawCount") < limit), spark)


def cut_forest(model: RandomForestClassificationModel, spark: SparkSession, max_depth: int) -> RandomForestClassificationModel:
    """The forest as it is if it is grown to ``max_depth`` only, as a model of its own.

    MLlib makes a leaf of a node whose leaves all predict the same; so it does with those that the cut leaves."""
    path = _saved(model, spark)
    nodes = _node_rows(spark, path).select("tree", "id", "left", "right")
    nodes = nodes.join(_walk(spark, nodes, "true"), ["tree", "id"]).where(F.col("depth") <= max_depth)
    said = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("said"))
    nodes = nodes.join(said, ["tree", "id"]).checkpoint()
    ends = nodes.where((F.col("left") < 0) | (F.col("depth") == max_depth))
    above = ends.select("tree", "said", F.explode(F.transform(F.sequence(F.lit(0), "depth"), lambda k: F.call_function("shiftright", F.col("place"), k))).alias("place"))
    agreed = above.groupBy("tree", "place").agg((F.min("said") == F.max("said")).alias("one"))
    nodes = nodes.join(agreed, ["tree", "place"])
    parents = nodes.select("tree", (2 * F.col("place")).alias("place"), "one").unionByName(nodes.select("tree", (2 * F.col("place") + 1).alias("place"), "one"))
    kept = nodes.drop("one").join(parents, ["tree", "place"], "left").where("one is null or not one").select("tree", "id").checkpoint()
    return _written(path, kept, F.col("leftChild_new").isNull(), spark)


def with_thresholds(model: RandomForestClassificationModel, spark: SparkSession, thresholds: Sequence[Sequence[float]]) -> RandomForestClassificationModel:
    """A forest grown on weighted rows whose features are numbers of bins, as a forest of the values; ``thresholds[f][i]`` ends bin i of feature f.

    The weights are numbers of rows, so a node's row count is their sum."""
    path, out = _saved(model, spark), checkpoint_path(spark, f"forests/{uuid.uuid4().hex}")
    table = F.array(*[F.array(*[F.lit(float(t)) for t in ts]).cast("array<double>") for ts in thresholds])
    split = F.col("nodeData.split")
    at = F.floor(F.get(split["leftCategoriesOrThreshold"], F.lit(0))).cast("int")
    moved = F.struct(split["featureIndex"].alias("featureIndex"), F.array(F.get(F.get(table, split["featureIndex"]), at)).alias("leftCategoriesOrThreshold"),
                     split["numCategories"].alias("numCategories"))
    stats = F.col("nodeData.impurityStats")
    node = F.col("nodeData").withField("split", F.when(F.col("nodeData.leftChild") >= 0, moved).otherwise(split)) \
        .withField("rawCount", F.aggregate(stats, F.lit(0.0), lambda a, b: a + b).cast("bigint"))
    spark.read.parquet(f"{path}/data").withColumn("nodeData", node).write.parquet(f"{out}/data")
    spark.read.parquet(f"{path}/treesMetadata").write.parquet(f"{out}/treesMetadata")
    spark.read.text(f"{path}/metadata").coalesce(1).write.text(f"{out}/metadata")       # one line
    return RandomForestClassificationModel.load(out)


# -- a tree by aggregations ---------------------------------------------------------------

def candidate_thresholds(df: DataFrame, features: Sequence[str], max_bins: int) -> DataFrame:
    """``(feature, threshold)``, under ``max_bins`` a feature: the middles between its distinct values if there are at most
    ``max_bins``, else the middles between its quantiles.  Null and NaN values are in no bin."""
    several = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in features]).first()
    parts = []
    for c in features:
        value = F.col(c).cast("double")
        known = df.select(value.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
        if several[c] <= 1.2 * max_bins:              # the estimate is within a few percent
            values = known.distinct()
        else:
            values = known.agg(F.percentile_approx("value", F.array(*[F.lit(i / max_bins) for i in range(max_bins)]), 100 * max_bins).alias("q"))
            values = values.select(F.explode("q").alias("value")).distinct()
        parts.append(values.select(F.lit(c).alias("feature"), "value"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    upper = F.lead("value").over(Window.partitionBy("feature").orderBy("value"))        # about max_bins rows
    return every.withColumn("threshold", (F.col("value") + upper) / 2).where("threshold is not null").select("feature", "threshold")


def _gini(n, positive):
    return F.when(n > 0, 1 - F.pow(positive / n, F.lit(2)) - F.pow((n - positive) / n, F.lit(2))).otherwise(0.0)


def best_splits(counts: DataFrame, min_samples_split: int, min_leaf: int) -> DataFrame:
    """From class counts (place, feature, feature_no, upper, n, pos) per bin: the split of each node with the largest Gini gain.

    Of equal gains the first feature's, then the smallest threshold."""
    w = Window.partitionBy("place", "feature").orderBy(F.col("upper").asc_nulls_last())
    whole = Window.partitionBy("place", "feature")
    run = counts.select("*", F.sum("n").over(w).alias("n_left"), F.sum("pos").over(w).alias("pos_left"), F.sum("n").over(whole).alias("all"), F.sum("pos").over(whole).alias("all_pos"))
    n_right, pos_right = F.col("all") - F.col("n_left"), F.col("all_pos") - F.col("pos_left")
    gain = _gini(F.col("all"), F.col("all_pos")) - F.col("n_left") / F.col("all") * _gini(F.col("n_left"), F.col("pos_left")) - n_right / F.col("all") * _gini(n_right, pos_right)
    ok = run.where("upper is not null").withColumn("gain", gain).where((F.col("all") >= min_samples_split) & (F.col("n_left") >= min_leaf) & (n_right >= min_leaf) & (F.col("gain") > 0))
    best = ok.groupBy("place").agg(F.max_by(F.struct("feature", "upper", "gain"), F.struct("gain", -F.col("feature_no"), -F.col("upper"))).alias("b"))
    return best.select("place", F.col("b.feature").alias("feature"), F.col("b.upper").alias("threshold"), "b.gain")


def grow_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 2, max_bins: int = 64, min_samples_split: int = 2, min_leaf: int = 1) -> DataFrame:
    """``(place, depth, feature, threshold, n, positives, gain)`` of one tree for a 0/1 label (no bootstrap, all features).

    Rows with a null label are left out; a null or NaN feature goes right.  No rows give no nodes.  ``df`` is read once a level, so
    cache or write it before; the splits of a level, at most 2^depth rows, are broadcast."""
    spark = df.sparkSession
    thresholds = candidate_thresholds(df, features, max_bins).groupBy("feature").agg(F.array_sort(F.collect_list("threshold")).alias("cuts"))
    cuts = {r["feature"]: r["cuts"] for r in thresholds.collect()}                       # features x max_bins numbers

    def upper(c: str):
        """The threshold of a value's bin: the smallest one that is not under it; null in the last bin."""
        v = F.col(c).cast("double")
        at = F.array(*[F.lit(float(x)) for x in cuts.get(c, [])]).cast("array<double>")
        return F.when(v.isNotNull() & ~F.isnan(v), F.get(F.filter(at, lambda t: v <= t), F.lit(0)))
    bins = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(i).alias("feature_no"), upper(c).alias("upper")) for i, c in enumerate(features)])
    rows = df.where(F.col(label).isNotNull()).select(*features, F.col(label).cast("long").alias("pos"), bins.alias("bins"), F.lit(1).cast("long").alias("place"))
    levels = []
    for depth in range(max_depth + 1):
        sizes = rows.groupBy("place").agg(F.count("*").alias("n"), F.sum("pos").alias("positives"))
        if depth == max_depth:
            levels.append(sizes.select("place", F.lit(depth).alias("depth"), F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("threshold"),
                                       "n", "positives", F.lit(None).cast("double").alias("gain")).checkpoint())
            break
        counts = rows.select("place", "pos", F.inline("bins")).groupBy("place", "feature", "feature_no", "upper").agg(F.count("*").alias("n"), F.sum("pos").alias("pos"))
        best = best_splits(counts, min_samples_split, min_leaf)
        levels.append(sizes.join(best, "place", "left").select("place", F.lit(depth).alias("depth"), "feature", "threshold", "n", "positives", "gain").checkpoint())
        splits = levels[-1].where("feature is not null").select("place", "feature", "threshold")
        value = F.coalesce(*[F.when(F.col("feature") == c, F.col(c).cast("double")) for c in features])
        goes_left = F.coalesce(value <= F.col("threshold"), F.lit(False))
        rows = rows.join(F.broadcast(splits), "place").select(*features, "pos", "bins", (2 * F.col("place") + F.when(goes_left, 0).otherwise(1)).alias("place"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out
