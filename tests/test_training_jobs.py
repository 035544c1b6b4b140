import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from relearn.operators import metrics, training
from relearn.plans import jobs
from relearn.sources import files
from relearn.sources.tables import LABEL, read_table, transactions
from relearn.plans.queries import FEATURE_EXCLUDE, TX_KEY_COLS


def test_unknown_model_type_raises():
    with pytest.raises(ValueError):
        training.numeric_pipeline(["a"], "y", model_type="lr")


def test_trees_do_not_depend_on_the_input_layout(spark):
    rows = transactions(spark, SF_SMALL).select(*TX_KEY_COLS, LABEL, "l_quantity", "l_discount", "l_tax")
    texts = []
    for parts in (1, 4, 9):
        cached = training.cache_for_fitting(rows.repartition(parts), TX_KEY_COLS, 8)
        try:
            assert cached.rdd.getNumPartitions() == 8 and cached.count() == rows.count()
            model = training.numeric_pipeline(["l_quantity", "l_discount", "l_tax"], LABEL, num_trees=3).fit(cached)
        finally:
            cached.unpersist()
        text = model.stages[-1].toDebugString.split("\n", 1)[1]
        texts.append([[float(x) for x in re.findall(r"-?[0-9]+[.][0-9eE+-]+", text)], re.sub(r"-?[0-9]+[.][0-9eE+-]+", "#", text)])
    for numbers, shape in texts[1:]:
        assert shape == texts[0][1] and numbers == pytest.approx(texts[0][0], rel=1e-9, abs=1e-9)


def test_partitions_of_a_training_set_grow_with_its_rows(spark, monkeypatch):
    assert [training.fit_partitions(n) for n in (0, 16 * training.FIT_ROWS, 16 * training.FIT_ROWS + 1, 400 * training.FIT_ROWS)] == [16, 16, 17, 400]
    monkeypatch.setattr(training, "FIT_ROWS", 50)
    for rows, want in ((400, 8), (4000, 80)):
        cached = training.cache_for_fitting(spark.range(rows), ["id"], 8)
        sizes = cached.groupBy(F.spark_partition_id()).count().collect()
        assert cached.rdd.getNumPartitions() == want and max(r["count"] for r in sizes) < 100
        cached.unpersist()


def test_cross_validation_fits_features_once_per_fold(spark, monkeypatch):
    from pyspark.ml.feature import StandardScaler
    fits = []
    plain = StandardScaler._fit
    monkeypatch.setattr(StandardScaler, "_fit", lambda self, df: fits.append(1) or plain(self, df))
    df = spark.range(0, 400).select((F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.col("id") % 7 / 10).alias("a"),
                                    (F.col("id") % 3).cast("int").alias("fold"))
    pipe = training.numeric_pipeline(["a"], "y", num_trees=2, max_depth=2)
    grid = training.forest_grid(pipe.getStages()[-1], (2, 3), (1, 2))
    out = training.cross_validate(pipe, grid, training.auc_evaluator("y"), df, 3)
    assert len(out.avg_metrics) == 4 and min(out.avg_metrics) > 0.95 and len(fits) == 3 + 1


@pytest.mark.parametrize("nulls", [False, True])
def test_run_training_without_keys(spark, scratch, nulls):
    tx = transactions(spark, SF_SMALL).select("l_quantity", "l_discount", "l_tax", "tx_timestamp", LABEL)
    if nulls:
        tx = tx.withColumn("l_tax", F.when(F.col("l_quantity") != 7, F.col("l_tax")))
    out = jobs.run_training(spark, "day", scratch + "/m", scratch + "/reg", input_df=tx, split_weights=(0.8, 0.2), partitions=4,
                            handle_invalid="skip" if nulls else "error")
    assert out["features"] == ["l_quantity", "l_discount", "l_tax"] and out["metrics"]["auc"] > 0.75


def test_stratified_folds_balance(spark):
    df = spark.range(0, 3000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    folded = training.add_folds(df, 5, "f", ["id"], label="y")
    counts = {(r.y, r.fold): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    assert all(counts[(1, k)] == 60 for k in range(5)) and all(counts[(0, k)] == 540 for k in range(5))
    plain = training.add_folds(df, 3, "f", ["id"]).agg(F.min("fold"), F.max("fold")).first()
    assert (plain[0], plain[1]) == (0, 2)


def test_search_draw_is_whole_grid_when_n_iter_large(spark):
    grid = training.search_grid(spark)
    assert grid.count() == 48
    drawn = training.draw_candidates(grid, 50)
    assert drawn.count() == 48
    few = training.draw_candidates(grid, 5).collect()
    assert len(few) == 5 and few == training.draw_candidates(grid, 5).collect()
    rf = training.forest("y")
    maps = training.param_maps(rf, training.draw_candidates(grid, 3))
    assert len(maps) == 3 and all(len(m) == 5 for m in maps)


def test_cv_learns_label_and_model_round_trip(spark, scratch):
    tx = transactions(spark, SF_SMALL)
    train = tx.filter(F.col("l_orderkey") % 4 != 0)
    test = tx.filter(F.col("l_orderkey") % 4 == 0)
    res = jobs.train_with_cv(train, test, LABEL, FEATURE_EXCLUDE, TX_KEY_COLS, parallelism=4)
    # the noise-free rule is the best possible scorer under 3 % label noise
    rule = test.withColumn("s", ((F.col("l_quantity") >= 40) & (F.col("l_discount") >= 0.07)).cast("double"))
    ceiling = metrics.roc_auc(rule, LABEL, "s").first().auc_score
    assert res.metrics["auc"] > max(0.8, ceiling - 0.05)  # 4.5k noisy training rows
    assert set(res.feature_cols) == {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    assert res.grid.count() == 4
    files.save_model(res.model, scratch + "/model")
    back = files.load_model(scratch + "/model")
    a = training.score(res.model, test).select("prediction").collect()
    b = training.score(back, test).select("prediction").collect()
    assert a == b


def test_run_training_twice_promotes_then_ab(spark, scratch):
    li = read_table(spark, SF_SMALL, "lineitem")
    tx = transactions(spark, SF_SMALL)
    reg = scratch + "/reg"
    first = jobs.run_training(spark, "day1", scratch + "/m1", reg, auto_register=True, input_df=tx,
                              key_cols=TX_KEY_COLS, exclude=["split"], split_weights=(0.8, 0.2))
    assert first["decision"]["promoted"] and first["decision"]["version"] == 1
    second = jobs.run_training(spark, "day2", scratch + "/m2", reg, auto_register=True, ab_testing=True,
                               input_df=tx, key_cols=TX_KEY_COLS, split_weights=(0.8, 0.2))
    assert second["ab"] is not None and second["ab"]["winner"] in ("champion", "challenger")
    assert second["decision"]["version"] == 2
    assert li.count() > 0


def test_run_ab_test_without_champion_returns_none(spark, scratch):
    docs = read_table(spark, SF_SMALL, "documents").join(read_table(spark, SF_SMALL, "labels"), "doc_id")
    assert jobs.run_ab_test(spark, docs, scratch + "/reg", "text", "quality", ["doc_id"], None,
                            model_name="text_model") is None


def test_run_ab_test_end_to_end(spark, scratch):
    from relearn.operators.registry import Registry
    docs = read_table(spark, SF_SMALL, "documents").join(read_table(spark, SF_SMALL, "labels"), "doc_id")
    champ = training.text_pipeline("text", "label_enc", num_trees=5, max_depth=3).fit(
        docs.withColumn("label_enc", F.col("quality")))
    reg = Registry(spark, scratch + "/reg")
    files.save_model(champ, scratch + "/champ")
    reg.set_alias("text_model", reg.register_version("text_model", "r0", scratch + "/champ"), "champion")
    out = jobs.run_ab_test(spark, docs, scratch + "/reg", "text", "quality", ["doc_id"], None,
                           model_name="text_model", n_iter=2, cv=2, sample_frac=1.0,
                           bootstrap_iterations=20, auto_deploy=True)
    assert out["version"] == 2 and {r["metric"] for r in out["comparison"]} == {"f1", "precision"}
    assert out["deployed"] == out["should_deploy"]


def test_generate_demo_job(spark, scratch):
    out = jobs.generate_demo(spark, scratch + "/demo", n=1000)
    assert out["n_rows"] == 1000 and out["positives"] == 50
    back = files.read_csv(spark, out["train_path"], files.DEMO_SCHEMA)
    assert 700 < back.count() < 900


def test_null_feature_policy(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (None, 1.0, 1), (3.0, 0.5, 1), (0.5, 4.0, 0)],
                               "a double, b double, y int")
    strict = training.numeric_pipeline(["a", "b"], "y", num_trees=2, max_depth=2)
    with pytest.raises(Exception):
        strict.fit(df).transform(df).count()
    lenient = training.numeric_pipeline(["a", "b"], "y", handle_invalid="skip", num_trees=2, max_depth=2)
    assert lenient.fit(df).transform(df).count() == 3
