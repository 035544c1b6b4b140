"""Model pipelines, folds, grids and cross-validation.

Everything here is ``pyspark.ml``: trees are grown by MLlib's distributed
histogram aggregation, and both the fold assignment and the layout of the
cached training set follow from the row key, so a fit depends on the rows only.  Stratified folds rank rows per label with the range-partitioned
rank of ``relearn.operators.ordered`` instead of a window over each class.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator)
from pyspark.ml.feature import CountVectorizer, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_uniform
from relearn.operators.cells import CellForestClassifier, cell_rows, first_trees
from relearn.operators.ordered import global_rank
from relearn.operators.trees import cut_forest, prune_forest

# Fixed values of the fraud job: forest and grid.
FOREST_NUM_TREES = 10
FOREST_MAX_DEPTH = 5
GRID_NUM_TREES = (10, 20)
GRID_MAX_DEPTH = (5, 10)
CV_FOLDS = 3

#: Name of the smallest node that is split; not an MLlib parameter, see ``relearn.operators.trees``.
MIN_SPLIT = "minSamplesSplit"

# Fixed values of the URL job: base forest and search space;
# ``max_features`` None means all features.
URL_NUM_TREES = 35
URL_MAX_DEPTH = 9
SEARCH_SPACE = {
    "numTrees": (30, 40),
    "maxDepth": (8, 10),
    MIN_SPLIT: (2, 5),
    "minInstancesPerNode": (1, 2),
    "featureSubsetStrategy": ("sqrt", "log2", "all"),
}
SEARCH_ITERATIONS = 50
SEARCH_FOLDS = 5

SEED = 42
MODEL_TYPES = ("rf",)


def forest(label: str, features: str = "features", num_trees: int = FOREST_NUM_TREES,
           max_depth: int = FOREST_MAX_DEPTH, seed: int = SEED, on_cells: bool = False, **params) -> RandomForestClassifier:
    """M3: a seeded random forest (the reference sets no seed)."""
    kind = CellForestClassifier if on_cells else RandomForestClassifier
    return kind(labelCol=label, featuresCol=features, numTrees=num_trees, maxDepth=max_depth, seed=seed, **params)


def numeric_pipeline(feature_cols: Sequence[str], label: str, model_type: str = "rf",
                     handle_invalid: str = "error", on_cells: bool = False, **forest_params) -> Pipeline:
    """M1 + M2 + M3 + M6: assemble -> standardise (mean 0, std 1) -> forest.

    ``handle_invalid`` is the assembler's null policy ("error" as in the
    reference, or "skip"/"keep").  Only ``rf`` exists; other model types raise
    instead of being ignored.  With ``on_cells`` the forest is grown on counts of binned rows
    (``relearn.operators.cells``).
    """
    if model_type not in MODEL_TYPES:
        raise ValueError(f"model_type {model_type!r} is not supported; use one of {MODEL_TYPES}")
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features_raw",
                                handleInvalid=handle_invalid)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, forest(label, on_cells=on_cells, **forest_params)])


def forest_grid(rf: RandomForestClassifier, num_trees: Sequence[int] = GRID_NUM_TREES,
                max_depth: Sequence[int] = GRID_MAX_DEPTH) -> list[dict]:
    """M4: the 2 x 2 grid of the fraud job."""
    return (ParamGridBuilder().addGrid(rf.numTrees, list(num_trees))
            .addGrid(rf.maxDepth, list(max_depth)).build())


def auc_evaluator(label: str) -> BinaryClassificationEvaluator:
    """The exact area: without ``numBins=0`` the curve of more than 2,000 scores is thinned."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=0)


def f1_class1_evaluator(label: str) -> MulticlassClassificationEvaluator:
    """Binary F1 of class 1 (the URL job's CV score)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


#: Least number of partitions of a cached training set.  Part of the model's definition, like the seed: MLlib seeds bagging
#: and split sampling per partition.
FIT_PARTITIONS = 16
#: Rows a partition beyond that: a larger set has as many partitions as its rows need, so what a task reads stays bounded.
FIT_ROWS = 1 << 19


def fit_partitions(rows: int, least: int = FIT_PARTITIONS) -> int:
    """Partitions of a training set of ``rows`` rows."""
    return max(least, -(-rows // FIT_ROWS))


def cache_for_fitting(df: DataFrame, key_names: Sequence[str], partitions: int = FIT_PARTITIONS,
                      level: StorageLevel = StorageLevel.MEMORY_AND_DISK, keep: Sequence[str] | None = None) -> DataFrame:
    """Cache a training set, laid out by a hash of the row key; returns the cached frame.

    Tree growing scans the cached set once per level and fit, so its layout
    matters more than one shuffle.  Rows go to ``partitions`` partitions by the
    key, or more where there are more than ``FIT_ROWS`` rows for each, and are
    sorted by it within each, so the same rows and seed give the
    same trees however the input is stored, and a recomputed partition is the
    same.  The caller selects the needed columns first and unpersists; with ``keep`` only these are cached, without the key.
    """
    keys = [F.col(c) for c in key_names]
    laid = df.repartition(fit_partitions(df.count(), partitions), *keys).sortWithinPartitions(*keys)
    cached = laid.select(*(df.columns if keep is None else keep)).persist(level)
    cached.count()
    return cached


def add_folds(df: DataFrame, k: int, seed: str, key_names: Sequence[str], label: str | None = None,
              col: str = "fold") -> DataFrame:
    """Fold column in ``[0, k)`` from the row key.

    Plain: ``floor(U(seed, key) * k)``.  Stratified by ``label``: rows of each
    class in ``U`` order get folds 0, 1, ..., k-1, 0, ... (equal class shares in
    every fold, like scikit-learn's stratified folds for classifiers).  The
    per-class rank is range-partitioned, so a dominant class is still split
    over many tasks.
    """
    u = hash_uniform(seed, *[F.col(c) for c in key_names])
    if label is None:
        return df.withColumn(col, F.least(F.floor(u * k), F.lit(k - 1)).cast("int"))
    tagged = df.withColumn("__u", u)
    ranked = global_rank(tagged, ["__u", *key_names], "__r", [label], uniform_first=True)
    return ranked.withColumn(col, F.pmod(F.col("__r"), F.lit(k)).cast("int")).drop("__u", "__r")


@dataclass
class CVResult:
    """The metric for each grid point and fold, mean and spread over the folds, and the best point refitted on all rows."""
    grid: list[dict]
    fold_metrics: list[list[float]]
    avg_metrics: list[float]
    std_metrics: list[float]
    best_index: int
    best_model: PipelineModel


def _grown(params: dict) -> dict:
    """The part of a grid point that MLlib's own parameters express."""
    return {p: v for p, v in params.items() if isinstance(p, Param)}


def _fits(grid: list[dict], depths: bool = False, trees: bool = False) -> list[tuple[dict, list[int]]]:
    """Fits that serve the grid: grid points that differ only in ``MIN_SPLIT``, and with ``depths`` in maxDepth, share one,
    the deepest, cut afterwards; with ``trees`` also those that differ in numTrees, of which a single tree has other feature subsets."""
    fits: dict[tuple, tuple[dict, list[int]]] = {}
    for i, params in enumerate(grid):
        grown = _grown(params)
        key = tuple(sorted((p.name, min(v, 2) if trees and p.name == "numTrees" else v) for p, v in grown.items() if not (depths and p.name == "maxDepth")))
        shared, members = fits.setdefault(key, (grown, []))
        shared.update({p: max(v, shared[p]) for p, v in grown.items() if p.name in ("maxDepth", "numTrees")})
        members.append(i)
    return list(fits.values())


def _level_fits(estimator: RandomForestClassifier, grid: list[dict], features: int) -> bool:
    """Whether MLlib grows every level of the grid's forests at once: then shallow forests are the tops of deeper ones.

    Otherwise it splits a level's nodes in several turns, which draw feature subsets in an order that depends on the depth."""
    def bytes_of(point: dict) -> int:
        rf = estimator.copy(_grown(point))
        return rf.getNumTrees() * 2 ** (rf.getMaxDepth() - 1) * features * rf.getMaxBins() * 4 * 8
    return all(bytes_of(p) <= estimator.getMaxMemoryInMB() << 20 for p in grid)


def cross_validate(pipeline: Pipeline, grid: list[dict], evaluator, train: DataFrame,
                   folds: int, fold_col: str = "fold", parallelism: int = 4, watch=None, share_depths: bool = False) -> CVResult:
    """M5: k-fold CV over ``grid`` with precomputed folds ``[0, folds)``; refit on all rows.

    The grid sets parameters of the last stage only, so the feature stages are
    fitted once per fold and its transformed rows (label and features) are
    cached while the grid points are fitted, ``parallelism`` at a time.  Points
    that differ only in ``MIN_SPLIT`` are cut from one fitted forest; with ``share_depths`` also those that differ in
    maxDepth, where MLlib grows each level at once and so the same trees.  A ``CellForestClassifier`` counts the fold's
    cells once for all points, which share their trees too, and scores one row per cell of the held-out rows, weighted by
    its rows ``n``.  The caller persists ``train``.  ``watch(fold, grid index, scored rows)`` sees what is evaluated.
    """
    stages = pipeline.getStages()
    estimator = stages[-1]
    spark = train.sparkSession
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    scores = [[0.0] * folds for _ in grid]
    for k in range(folds):
        fitted, held = train.filter(F.col(fold_col) != k), train.filter(F.col(fold_col) == k)
        prepare = Pipeline(stages=stages[:-1]).fit(fitted)
        parts = [prepare.transform(p).select(label, features) for p in (fitted, held)]
        cells = estimator.cells(parts[0]) if isinstance(estimator, CellForestClassifier) and evaluator.hasParam("weightCol") else None
        if cells is None:
            kept, judge = [p.persist(StorageLevel.MEMORY_AND_DISK) for p in parts], evaluator
        else:                                         # of held-out rows too only the cells matter
            parts[1] = cell_rows(parts[1], features, cells.thresholds, label).persist(StorageLevel.MEMORY_AND_DISK)
            kept, judge = [cells, parts[1]], evaluator.copy({evaluator.weightCol: "n"})
        try:
            row = parts[0].select(features).first() if share_depths else None
            fits = _fits(grid, row is not None and _level_fits(estimator, grid, row[0].size), cells is not None)

            def one(fit, parts=parts, k=k, cells=cells, judge=judge):
                params, members = fit
                rf = estimator.copy(params)
                forest = rf.fit(parts[0]) if cells is None else rf.grow(cells)
                cut = {rf.getMaxDepth(): forest}
                for i in members:
                    point, least = estimator.copy(_grown(grid[i])), grid[i].get(MIN_SPLIT, 2)
                    depth = point.getMaxDepth()
                    if depth not in cut:
                        cut[depth] = cut_forest(forest, spark, depth)
                    scored = prune_forest(first_trees(cut[depth], point.getNumTrees()), spark, least).transform(parts[1])
                    scores[i][k] = float(judge.evaluate(scored))
                    if watch is not None:
                        watch(k, i, scored)
            with ThreadPool(min(parallelism, len(fits))) as pool:
                pool.map(one, fits)
        finally:
            for p in kept:
                p.unpersist()
    means = [sum(s) / len(s) for s in scores]
    spread = [(sum((x - m) ** 2 for x in s) / len(s)) ** 0.5 for s, m in zip(scores, means)]
    best = (max if evaluator.isLargerBetter() else min)(range(len(grid)), key=lambda i: means[i])
    model = Pipeline(stages=[*stages[:-1], estimator.copy(_grown(grid[best]))]).fit(train)
    if grid[best].get(MIN_SPLIT, 2) > 2:
        model = PipelineModel(stages=[*model.stages[:-1], prune_forest(model.stages[-1], spark, grid[best][MIN_SPLIT])])
    return CVResult(grid, scores, means, spread, best, model)


def param_names(params: dict) -> dict[str, str]:
    """A grid point as names and values."""
    return {p if isinstance(p, str) else p.name: str(v) for p, v in params.items()}


def cv_table(spark: SparkSession, result: CVResult, metric: str = "avg_metric") -> DataFrame:
    """M5/M8: one row per grid point with its mean and spread over the folds."""
    rows = [(i, param_names(params), mean, std)
            for i, (params, mean, std) in enumerate(zip(result.grid, result.avg_metrics, result.std_metrics))]
    return spark.createDataFrame(rows, f"grid_id int, params map<string,string>, {metric} double, "
                                       f"std_metric double")


def fold_table(spark: SparkSession, result: CVResult) -> DataFrame:
    """One row per grid point and fold with the metric."""
    rows = [(i, k, value) for i, values in enumerate(result.fold_metrics) for k, value in enumerate(values)]
    return spark.createDataFrame(rows, "candidate int, fold int, metric double")


def best_params(model: PipelineModel) -> dict:
    """M8: parameters of the chosen forest."""
    rf = model.stages[-1]
    return {"numTrees": rf.getNumTrees, "maxDepth": rf.getMaxDepth(),
            "minInstancesPerNode": rf.getMinInstancesPerNode(),
            "featureSubsetStrategy": rf.getFeatureSubsetStrategy()}


def score(model: PipelineModel, df: DataFrame, score_col: str = "score") -> DataFrame:
    """M7: batch scoring, with the class-1 probability as a plain column."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.withColumn(score_col, vector_to_array(F.col("probability")).getItem(1)) \
        .withColumn("prediction", F.col("prediction").cast("int"))


# -- text: character counts and the URL classifier (M9, M10) ----------------------

#: Every code point there can be: no character is left out of a vocabulary.
CODE_POINTS = 0x110000


def char_tokens_sql(text_col: str) -> str:
    """SQL for M9 tokens: lower-case, runs of 2+ blanks folded to one, split in characters."""
    return (f"filter(split(regexp_replace(lower({text_col}), '\\\\s\\\\s+', ' '), ''), "
            f"c -> c != '')")


def char_tokens(text_col: str):
    """M9 tokens as a Column (the same expression as ``char_tokens_sql``)."""
    return F.expr(char_tokens_sql(text_col))


def text_pipeline(text_col: str, label: str, num_trees: int = URL_NUM_TREES,
                  max_depth: int = URL_MAX_DEPTH, seed: int = SEED, **forest_params) -> Pipeline:
    """Character 1-gram counts -> forest (35 trees, depth 9)."""
    tok = SQLTransformer(statement=f"SELECT *, {char_tokens_sql(text_col)} AS chars FROM __THIS__")
    cv = CountVectorizer(inputCol="chars", outputCol="features", minDF=1.0, vocabSize=CODE_POINTS)
    return Pipeline(stages=[tok, cv, forest(label, "features", num_trees, max_depth, seed, **forest_params)])


def search_grid(spark: SparkSession, space: dict | None = None) -> DataFrame:
    """The search space as a table (one row per combination, ``grid_id``)."""
    space = SEARCH_SPACE if space is None else space
    names = list(space)
    combos = list(itertools.product(*(space[n] for n in names)))
    rows = [(i, *[str(v) for v in c]) for i, c in enumerate(combos)]
    return spark.createDataFrame(rows, "grid_id int, " + ", ".join(f"{n} string" for n in names))


def draw_candidates(grid: DataFrame, n_iter: int, seed: str = "search") -> DataFrame:
    """``min(n_iter, size)`` grid points in hash order, without replacement.

    The grid has one row per parameter combination (bounded by the search
    space, not by data), so the ordered limit is tiny.
    """
    return grid.orderBy(hash_uniform(seed, F.col("grid_id")), "grid_id").limit(n_iter)


def param_maps(rf: RandomForestClassifier, candidates: DataFrame) -> list[dict]:
    """Grid rows -> MLlib param maps (a few dozen rows at most)."""
    casts = {"numTrees": int, "maxDepth": int, "minInstancesPerNode": int, "featureSubsetStrategy": str, MIN_SPLIT: int}
    maps = []
    for row in candidates.orderBy("grid_id").collect():
        maps.append({name if name == MIN_SPLIT else getattr(rf, name): cast(row[name]) for name, cast in casts.items()
                     if name in row.asDict()})
    return maps
