import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from relearn.operators import metrics


def test_confusion_and_label_metrics_by_hand(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    m = metrics.evaluate_predictions(df, "y", "p").first()
    assert (m.tp, m.fp, m.fn, m.tn) == (3, 1, 2, 4)
    assert m.precision == pytest.approx(0.75)
    assert m.recall == pytest.approx(0.6)
    assert m.f1_binary == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    assert m.auc_label == pytest.approx((0.6 + 0.8) / 2)
    assert m.accuracy == pytest.approx(0.7)


def test_zero_division_and_missing_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    m = metrics.evaluate_predictions(df, "y", "p").first()
    assert m.precision == 0.0 and m.recall == 0.0 and m.f1_binary == 0.0
    assert m.auc_label is None


def test_weighted_f1_matches_mllib(spark):
    rnd = random.Random(1)
    rows = [(float(rnd.random() < 0.3), float(rnd.random() < 0.4)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "y double, p double")
    ours = metrics.evaluate_predictions(df.selectExpr("int(y) y", "int(p) p"), "y", "p").first()
    ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p")
    assert ours.f1_weighted == pytest.approx(ev.setMetricName("f1").evaluate(df), abs=1e-12)
    assert ours.accuracy == pytest.approx(ev.setMetricName("accuracy").evaluate(df), abs=1e-12)
    f1_1 = ev.setMetricName("fMeasureByLabel").setMetricLabel(1.0).evaluate(df)
    assert ours.f1_binary == pytest.approx(f1_1, abs=1e-12)


def test_exact_auc_matches_mllib_exact_with_ties(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        y = int(rnd.random() < 0.35)
        s = round(rnd.random() * 0.6 + 0.4 * y, 2)  # many ties
        rows.append((y, s))
    df = spark.createDataFrame(rows, "y int, s double")
    ours = metrics.roc_auc(df, "y", "s", num_parts=5).first().auc_score
    from pyspark.ml.functions import array_to_vector
    vec = df.select(F.col("y").cast("double").alias("label"),
                    array_to_vector(F.array(1 - F.col("s"), F.col("s"))).alias("raw"))
    mllib = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", numBins=0).evaluate(vec)
    assert ours == pytest.approx(mllib, abs=1e-12)
    # brute force Mann-Whitney with ties counted half
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert ours == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_grouped_auc_and_missing_class_is_null(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("a", 1, 0.5), ("a", 0, 0.5), ("b", 1, 0.3), ("b", 1, 0.4)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    out = {r.g: r.auc_score for r in metrics.roc_auc(df, "y", "s", ["g"], num_parts=3).collect()}
    assert out["a"] == pytest.approx((1 + 1 + 1 + 0.5) / 4)
    assert out["b"] is None


def test_auc_independent_of_range_count(spark):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.5), rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "y int, s double")
    vals = {k: metrics.roc_auc(df, "y", "s", num_parts=k).first().auc_score for k in (1, 3, 17)}
    assert len({round(v, 12) for v in vals.values()}) == 1


def test_tied_auc_is_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first().auc_score == pytest.approx(0.5)


def test_score_metrics_one_pass_matches_parts(spark):
    rnd = random.Random(5)
    rows = [(g, int(rnd.random() < 0.4), round(rnd.random(), 3)) for g in ("x", "y") for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, y int, s double").withColumn("p", (F.col("s") > 0.5).cast("int"))
    sm = {r.g: r for r in metrics.score_metrics(df, "y", "s", "p", ["g"]).collect()}
    auc = {r.g: r.auc_score for r in metrics.roc_auc(df, "y", "s", ["g"]).collect()}
    cls = {r.g: r for r in metrics.evaluate_predictions(df, "y", "p", ["g"]).collect()}
    for g in ("x", "y"):
        assert sm[g].auc_score == pytest.approx(auc[g])
        assert sm[g].accuracy == pytest.approx(cls[g].accuracy)
        assert sm[g].f1_weighted == pytest.approx(cls[g].f1_weighted)
        assert sm[g].sample_size == 500


def test_null_label_and_null_score_not_counted(spark):
    rows = [(1, 0.9, 1), (0, 0.1, 0), (None, 0.5, 1), (1, None, 1), (0, 0.4, None)]
    df = spark.createDataFrame(rows, "y int, s double, p int")
    m = metrics.score_metrics(df, "y", "s", "p").first()
    # rows with a null label, score or prediction fall in no confusion cell
    assert m.sample_size == 2 and m.accuracy == 1.0
    assert m.auc_score == 1.0  # ranks the two labelled, scored rows correctly
    c = metrics.confusion_counts(df, "y", "p").first()
    assert (c.tp, c.fp, c.fn, c.tn, c.n) == (2, 0, 0, 1, 3)


def test_empty_table_gives_one_row_of_zeros(spark):
    df = spark.createDataFrame([], "y int, s double, p int")
    m = metrics.score_metrics(df, "y", "s", "p").collect()
    assert len(m) == 1 and m[0].sample_size == 0 and m[0].auc_score is None and m[0].accuracy == 0.0
    e = metrics.evaluate_predictions(df, "y", "p").first()
    assert e.n == 0 and e.precision == 0.0 and e.f1_binary == 0.0 and e.auc_label is None


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_score_metrics_reads_its_input_once(spark, scratch):
    rows = [(i % 3, i % 2, (i * 37 % 101) / 101.0, (i * 7) % 2) for i in range(500)]
    spark.createDataFrame(rows, "g int, y int, s double, p int").write.parquet(scratch + "/in")
    df = spark.read.parquet(scratch + "/in")
    out = metrics.score_metrics(df, "y", "s", "p", ["g"])
    assert _plan(out).count("FileScan") == 1          # AUC and confusion cells share one scan
    assert "BroadcastNestedLoopJoin" not in _plan(out) and "CartesianProduct" not in _plan(out)
    assert out.count() == 3


def test_bootstrap_scores_read_resamples_once(spark):
    from relearn.operators import bootstrap
    counts = [50, 3, 7, 2, 4, 6, 1, 27]
    scores = bootstrap.bootstrap_scores(bootstrap.resample_draws(spark, counts, 20, "b"))
    assert _plan(scores).count("Range (") == 1         # both models from one pass
    assert scores.count() == 40
