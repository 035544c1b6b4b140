"""Forests on counted cells: the rows' bootstrap, the rows' trees, shared fits, and rows that never reach MLlib."""
import collections

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from relearn.operators import cells, training, trees
from relearn.plans import jobs

NAMES = ["a", "b", "c"]


def rows_of(spark, n=6000, parts=4):
    rng = np.random.default_rng(8)
    a, b, c = rng.integers(0, 10, n), rng.integers(0, 7, n), rng.integers(0, 5, n)
    y = ((a > 6) & (b > 1)) ^ (rng.random(n) < 0.1)
    data = [(i, float(p), float(q), float(r), int(s)) for i, (p, q, r, s) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, y int").repartition(parts)


def prepared(df, **params):
    pipe = training.numeric_pipeline(NAMES, "y", on_cells=True, **params)
    return Pipeline(stages=pipe.getStages()[:-1]).fit(df).transform(df).select("y", "features"), pipe.getStages()[-1]


def nodes(model, spark):
    return sorted((r.tree, r.place, r.feature, r.threshold and round(r.threshold, 9), r.n, tuple(r.stats)) for r in trees.forest_nodes(model, spark, NAMES).collect())


def test_poisson_draws(spark):
    df = spark.range(0, 40_000, 1, 4).withColumn("n", F.element_at(F.array(*[F.lit(v).cast("long") for v in (1, 3, 64, 5003)]), (F.col("id") % 4 + 1).cast("int")))
    out = cells.poisson_draws(df, "n", 5003, [F.lit("t"), F.col("id")], "k")
    for r in out.groupBy("n").agg(F.avg("k").alias("mean"), F.var_samp("k").alias("spread"), F.avg((F.col("k") == 0).cast("int")).alias("none")).collect():
        assert abs(r["mean"] - r.n) < 5 * (r.n / 10_000) ** 0.5 and abs(r.spread / r.n - 1) < 0.1 and abs(r.none - np.exp(-r.n)) < 0.025
    again = cells.poisson_draws(df.repartition(7), "n", 5003, [F.lit("t"), F.col("id")], "k")
    assert out.select("id", "k").exceptAll(again.select("id", "k")).count() == 0
    low, sums = cells.poisson_table(24)
    assert abs(low + sum(1 - s for s in sums) - 2 ** 24) < 1e-2 and sums[0] < 1e-15 and sums[-1] > 1 - 1e-12


def test_trees_of_cells_are_those_of_their_drawn_rows(spark):
    data, rf = prepared(rows_of(spark).cache(), num_trees=3, max_depth=5, featureSubsetStrategy="all")
    found = rf.cells(data)
    table, model = found.table, rf.grow(found)
    assert table.agg(F.sum("n")).first()[0] == 6000 and found.size <= 700 and [len(t) for t in found.thresholds] == [9, 6, 4]
    got = collections.defaultdict(list)
    for r in nodes(model, spark):
        got[r[0]].append(r[1:])
    for t in range(3):
        keys = [F.lit(rf.getSeed()), F.lit(t), cells.cell_key(3, "y")]
        drawn = cells.poisson_draws(table, "n", found.most, keys, "k").where("k > 0")
        each = drawn.select("y", "b0", "b1", "b2", F.explode(F.sequence(F.lit(1), F.col("k")))).cache()
        vectors = training.VectorAssembler(inputCols=["b0", "b1", "b2"], outputCol="features").transform(each)
        plain = RandomForestClassifier(labelCol="y", numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=5, seed=1, maxBins=200).fit(vectors)
        want = [(place, f, th and round(found.thresholds[NAMES.index(f)][int(th)], 9), n, s) for _, place, f, th, n, s in nodes(plain, spark)]
        assert got[t] == want
    held = cells.cell_rows(data, "features", found.thresholds, "y")
    exact = training.auc_evaluator("y")
    assert held.count() == found.size
    assert exact.copy({exact.weightCol: "n"}).evaluate(model.transform(held)) == pytest.approx(exact.evaluate(model.transform(data)), abs=1e-12)
    found.unpersist()


def test_forests_of_fewer_trees_and_levels_are_parts(spark):
    df = rows_of(spark).cache()
    data, big = prepared(df, num_trees=4, max_depth=6)
    few = big.copy({big.numTrees: 2, big.maxDepth: 3}).fit(data.repartition(3))
    part = cells.first_trees(trees.cut_forest(big.fit(data), spark, 3), 2)
    assert nodes(few, spark) == nodes(part, spark) and few.getNumTrees == part.getNumTrees == 2 and few.getMaxDepth() == 3
    pipe = training.numeric_pipeline(NAMES, "y", on_cells=True)
    rf = pipe.getStages()[-1]
    grid = training.forest_grid(rf, (2, 4), (3, 6))
    assert [(f[rf.numTrees], f[rf.maxDepth], m) for f, m in training._fits(grid, True, True)] == [(4, 6, [0, 1, 2, 3])]
    folded = df.withColumn("fold", (F.col("id") % 2).cast("int")).cache()
    out = training.cross_validate(pipe, grid, training.auc_evaluator("y"), folded, 2, share_depths=True)
    for i, point in enumerate(grid):
        model = Pipeline(stages=[*pipe.getStages()[:-1], rf.copy(point)]).fit(folded.where("fold <> 0"))
        assert out.fold_metrics[i][0] == pytest.approx(training.auc_evaluator("y").evaluate(model.transform(folded.where("fold = 0"))), abs=1e-12)


def test_cross_validation_grows_no_tree_on_rows(spark, monkeypatch):
    """What MLlib reads is bounded by the cells: four times the rows give it no more."""
    sizes, plain = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: sizes.append(df.count()) or plain(self, df))
    grid = training.forest_grid
    monkeypatch.setattr(training, "forest_grid", lambda rf: grid(rf, (2, 3), (2, 4)))
    df = rows_of(spark, 12_000)
    result = jobs.train_with_cv(df.where("id % 8 > 0"), df.where("id % 8 = 0"), "y", ["y", "id"], ["id"])
    assert sizes and max(sizes) <= 700 and result.metrics["auc"] > 0.8 and result.grid.count() == 4


def test_quantile_bins_nan_and_rows_that_have_cells_of_their_own(spark):
    df = spark.range(0, 30_000, 1, 6).select(F.sqrt("id").alias("a"), F.when(F.col("id") % 50 != 0, F.col("id") % 3).otherwise(float("nan")).alias("b"),
                                             F.lit(1.0).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    data = training.VectorAssembler(inputCols=NAMES, outputCol="features", handleInvalid="keep").transform(df)
    thresholds, n = cells.bin_thresholds(data, "features", 3, 32)
    assert n == 30_000 and len(thresholds[0]) == 31 and thresholds[1:] == [[0.5, 1.5], []]
    counts = cells.counted(data, "features", thresholds, "y").groupBy("b0").agg(F.sum("n").alias("n")).collect()
    assert len(counts) == 32 and all(abs(r.n - 30_000 / 32) < 60 for r in counts)
    assert {r.b1 for r in cells.counted(data.where("isnan(b)"), "features", thresholds, "y").collect()} == {2}
    rf = training.forest("y", on_cells=True, num_trees=2)
    many = spark.range(3000).select(F.array(*[F.xxhash64("id", F.lit(i)) / 1e18 for i in range(6)]).alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    own = many.select(cells.array_to_vector("x").alias("features"), "y")
    assert rf.cells(own) is None and rf.fit(own).getNumTrees == 2
    assert rf.copy({rf.minInstancesPerNode: 3}).cells(data) is None


def test_cached_training_rows_are_laid_out_by_a_key_that_is_not_kept(spark):
    df = rows_of(spark, 2000)
    whole, slim = (training.cache_for_fitting(df, ["id"], 4, keep=k) for k in (None, ["y", "a"]))
    assert slim.columns == ["y", "a"] and slim.rdd.getNumPartitions() == 4
    assert [tuple(r) for r in slim.collect()] == [tuple(r) for r in whole.select("y", "a").collect()]
    whole.unpersist(), slim.unpersist()
