"""Trees as tables, pruning under a split limit, exact samples, folds in one scan."""
import collections

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import SF_SMALL
from relearn.operators import ordered, sampling, training, trees
from relearn.plans.queries import REGISTRY


def made(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, size=(n, 3)).astype(float)
    y = ((x[:, 0] > 6) & (x[:, 1] > 3) ^ (rng.random(n) < 0.15)).astype(int)
    return x, y


def brute_tree(x, y, depth, limit=2, place=1):
    """{place: (feature, threshold, n, positives)} by trying every threshold."""
    n, best = len(y), None
    gini = lambda v: 1 - np.mean(v) ** 2 - (1 - np.mean(v)) ** 2 if len(v) else 0.0
    if depth and n >= limit:
        for f in range(x.shape[1]):
            values = CUTS[f]
            for t in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= t
                if left.any() and not left.all():
                    gain = gini(y) - left.mean() * gini(y[left]) - (1 - left.mean()) * gini(y[~left])
                    if gain > 1e-12 and (best is None or gain > best[0] + 1e-12):
                        best = (gain, f, t, left)
    out = {place: (best and best[1], best and best[2], n, int(y.sum()))}
    if best:
        out |= brute_tree(x[best[3]], y[best[3]], depth - 1, limit, 2 * place)
        out |= brute_tree(x[~best[3]], y[~best[3]], depth - 1, limit, 2 * place + 1)
    return out


CUTS = []


def frame(spark, x, y):
    CUTS[:] = [np.unique(c) for c in x.T]
    return spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], "f0 double, f1 double, f2 double, y int")


def nodes_of(df):
    return {r.place: (None if r.feature is None else int(r.feature[1]), r.threshold, r.n, r.positives) for r in df.collect()}


@pytest.mark.parametrize("limit", [2, 60])
def test_tree_by_aggregations(spark, limit):
    x, y = made()
    df = frame(spark, x, y)
    assert nodes_of(trees.grow_tree(df, ["f0", "f1", "f2"], "y", 3, min_samples_split=limit)) == brute_tree(x, y, 3, limit)


def test_tree_with_nulls_bins_and_no_rows(spark):
    x, y = made(300)
    df = frame(spark, x, y)
    holes = df.withColumn("f0", F.when(F.col("f2") != 5, F.col("f0"))).withColumn("f1", F.when(F.col("f2") == 3, float("nan")).otherwise(F.col("f1")))
    out = trees.grow_tree(holes.unionByName(df.limit(5).withColumn("y", F.lit(None).cast("int"))), ["f0", "f1", "f2"], "y", 2)
    got = {r.place: r for r in out.collect()}
    assert got[1].n == 300 and all(r.n == got[2 * p].n + got[2 * p + 1].n for p, r in got.items() if r.feature)
    assert trees.grow_tree(df.limit(0), ["f0", "f1", "f2"], "y", 2).count() == 0
    one_class = trees.grow_tree(df.withColumn("y", F.lit(1)), ["f0"], "y", 2).collect()
    assert [(r.place, r.feature, r.positives) for r in one_class] == [(1, None, 300)]
    many = spark.range(5000).select(F.col("id").cast("double").alias("f0"), (F.col("id") >= 2500).cast("int").alias("y"))
    root = trees.grow_tree(many, ["f0"], "y", 1, max_bins=20).where("place = 1").first()
    assert abs(root.threshold - 2500) < 300 and trees.candidate_thresholds(many, ["f0"], 20).count() < 20


def fitted(df, **params):
    vectors = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="features").transform(df)
    return vectors, training.forest("y", maxBins=64, **params).fit(vectors)


def brute_class(nodes, row):
    place = 1
    while nodes[place][0] is not None:
        place = 2 * place + (0 if row[nodes[place][0]] <= nodes[place][1] else 1)
    return int(2 * nodes[place][3] > nodes[place][2])


@pytest.mark.parametrize("limit", [2, 40, 150, 10_000])
def test_pruned_forest_is_the_tree_grown_under_the_limit(spark, limit):
    x, y = made()
    vectors, model = fitted(frame(spark, x, y), num_trees=1, max_depth=4, bootstrap=False, featureSubsetStrategy="all")
    pruned = trees.prune_forest(model, spark, limit)
    want = brute_tree(x, y, 4, limit)
    got = [int(r.prediction) for r in pruned.transform(vectors).select("prediction").collect()]
    assert got == [brute_class(want, r) for r in x]
    nodes = trees.forest_nodes(pruned, spark, ["f0", "f1", "f2"]).collect()
    assert all(r.n >= limit for r in nodes if r.feature is not None)
    sure = {r.place: (r.feature, r.threshold, r.n) for r in nodes}
    assert all(sure[p] == (f"f{v[0]}", v[1], v[2]) for p, v in want.items() if p in sure and sure[p][0] is not None)


def test_pruned_forest_of_many_trees_is_saved_and_loaded(spark, scratch):
    from pyspark.ml.classification import RandomForestClassificationModel
    x, y = made()
    vectors, model = fitted(frame(spark, x, y), num_trees=7, max_depth=6)
    pruned = trees.prune_forest(model, spark, 50)
    assert pruned.getNumTrees == 7 and pruned.totalNumNodes < model.totalNumNodes
    # a row's probability is the mean over trees of the deepest node on its path that is not below a small one
    nodes = collections.defaultdict(dict)
    for r in trees.forest_nodes(model, spark, ["f0", "f1", "f2"]).collect():
        nodes[r.tree][r.place] = r
    def share(tree, row):
        place = 1
        while tree[place].feature is not None and tree[place].n >= 50:
            place = 2 * place + (0 if row[int(tree[place].feature[1])] <= tree[place].threshold else 1)
        return tree[place].stats[1] / sum(tree[place].stats)
    got = [float(r.probability[1]) for r in pruned.transform(vectors).select("probability").collect()]
    assert np.allclose(got, [np.mean([share(t, r) for t in nodes.values()]) for r in x])
    pruned.save(scratch + "/pruned")
    again = RandomForestClassificationModel.load(scratch + "/pruned")
    assert [float(r.probability[1]) for r in again.transform(vectors).select("probability").collect()] == got


def test_grid_points_that_differ_in_the_limit_share_a_fit(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    fits = []
    plain = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    x, y = made(400)
    df = frame(spark, x, y).withColumn("fold", (F.monotonically_increasing_id() % 2).cast("int"))
    pipe = training.numeric_pipeline(["f0", "f1", "f2"], "y", num_trees=3, max_depth=5)
    depth = pipe.getStages()[-1].maxDepth
    grid = [{depth: d, training.MIN_SPLIT: m} for d in (3, 5) for m in (2, 5, 300)]
    seen = []
    out = training.cross_validate(pipe, grid, training.f1_class1_evaluator("y"), df, 2, watch=lambda k, i, rows: seen.append((k, i)))
    assert len(fits) == 2 * 2 + 1 and sorted(seen) == [(k, i) for k in range(2) for i in range(6)]
    assert training.fold_table(spark, out).count() == 12 and training.cv_table(spark, out).where(f"params['{training.MIN_SPLIT}'] = '300'").count() == 2
    worst = training.cross_validate(pipe, [{depth: 3, training.MIN_SPLIT: 300}], training.f1_class1_evaluator("y"), df, 2)
    assert max(worst.best_model.stages[-1].trees, key=lambda t: t.depth).depth <= 2


def test_search_space_has_all_combinations(spark):
    grid = training.search_grid(spark)
    assert grid.count() == 48 and grid.select("minSamplesSplit").distinct().count() == 2


@pytest.mark.parametrize("fraction", [0.0, 0.0049, 0.1, 0.25, 0.5, 1.0])
def test_exact_sample_size(spark, fraction):
    df = spark.range(1, 1002).withColumn("k2", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5))
    got = [r.id for r in sampling.sample_exact(df, fraction, "s", ["id", "k2"]).collect()]
    u = {r.id: r.u for r in df.select("id", sampling.hash_bits("s", "id", "k2").alias("u")).collect()}
    assert len(got) == round(fraction * 1001) and set(got) == set(sorted(u, key=u.get)[:len(got)])


def test_exact_sample_of_equal_keys(spark):
    """A key that holds most of the rows: the size is still exact."""
    df = spark.range(3000).select((F.col("id") % 3 * F.lit(0) + F.when(F.col("id") < 300, F.col("id")).otherwise(-1)).alias("k"), "id")
    for fraction in (0.03, 0.2, 0.6, 0.97):
        rows = sampling.sample_exact(df, fraction, "s", ["k"]).collect()
        assert len(rows) == round(fraction * 3000) == len({r.id for r in rows})
    assert sampling.sample_exact(df.limit(0), 0.5, "s", ["k"]).count() == 0
    with pytest.raises(ValueError):
        sampling.sample_exact(df, 1.5, "s", ["k"])


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_stratified_folds_read_their_input_once(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    assert scans(training.add_folds(df, 3, "f", keys, label="l_returnflag")) == 1
    assert scans(REGISTRY["fold_sizes"](spark, SF_SMALL)) == 1
    ranked = ordered.global_rank(df.withColumn("u", F.lit(0.5)), ["u", *keys, "l_extendedprice"], uniform_first=True)
    assert ranked.select("rank").distinct().count() == df.count()


def test_a_cut_forest_is_the_shallow_one(spark):
    """Node by node, merged leaves included; and a grid of depths is fitted once for each number of trees."""
    rng = np.random.default_rng(12)
    x = rng.random((3000, 4)).round(2)
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.random(3000) > 0.45).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(v), i % 2) for i, (r, v) in enumerate(zip(x, y))], "a double, b double, c double, d double, y int, fold int")
    pipe = training.numeric_pipeline(["a", "b", "c", "d"], "y")
    rows = Pipeline(stages=pipe.getStages()[:-1]).fit(df).transform(df).select("y", "features").cache()
    names = ["a", "b", "c", "d"]
    nodes = lambda m: sorted((r.tree, r.place, r.feature, r.threshold, r.n, tuple(r.stats), r.gain) for r in trees.forest_nodes(m, spark, names).collect())
    deep = training.forest("y", num_trees=6, max_depth=9).fit(rows)
    for depth in (1, 4):
        shallow, cut = training.forest("y", num_trees=6, max_depth=depth).fit(rows), trees.cut_forest(deep, spark, depth)
        key = lambda n: [(r[:3], pytest.approx(r[3]), r[4], r[5], pytest.approx(r[6])) for r in n]
        assert [(r[:3], r[3], r[4], r[5], r[6]) for r in nodes(cut)] == key(nodes(shallow)), depth
        a, b = (m.transform(rows).select("probability").collect() for m in (cut, shallow))
        assert a == b
    rf = pipe.getStages()[-1]
    grid = training.forest_grid(rf, (3, 5), (2, 6))
    fits = training._fits(grid, True)
    assert sorted((f[rf.numTrees], f[rf.maxDepth], len(members)) for f, members in fits) == [(3, 6, 2), (5, 6, 2)]
    assert len(training._fits(grid)) == 4 and not training._level_fits(rf, grid, 1 << 20)
    out = training.cross_validate(pipe, grid, training.auc_evaluator("y"), df, 2, share_depths=True)
    for i, point in list(enumerate(grid))[:2]:
        model = Pipeline(stages=[*pipe.getStages()[:-1], rf.copy(point)]).fit(df.where("fold <> 0"))
        assert out.fold_metrics[i][0] == pytest.approx(training.auc_evaluator("y").evaluate(model.transform(df.where("fold = 0"))), abs=1e-9)
