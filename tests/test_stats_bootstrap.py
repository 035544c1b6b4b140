import pytest
from pyspark.sql import functions as F

from relearn.functions.tdist import t_two_sided_p
from relearn.operators import bootstrap, stats

# Known two-sided critical values of Student's t (standard tables).
CRITICAL = [(2.228, 10, 0.05), (3.169, 10, 0.01), (1.972, 198, 0.05), (2.601, 198, 0.01),
            (2.571, 5, 0.05), (12.706, 1, 0.05), (4.604, 4, 0.01), (2.086, 20, 0.05), (2.093, 19, 0.05)]


def test_p_values_match_tables(spark):
    df = spark.createDataFrame(CRITICAL, "t double, dof int, p double")
    out = df.select("p", t_two_sided_p(F.col("t"), F.col("dof")).alias("q")).collect()
    for r in out:
        assert r.q == pytest.approx(r.p, abs=6e-4)


def test_p_value_edges(spark):
    df = spark.createDataFrame([(0.0, 10), (50.0, 30), (None, 10), (-2.228, 10)], "t double, dof int")
    q = [r[0] for r in df.select(t_two_sided_p(F.col("t"), F.col("dof"))).collect()]
    assert q[0] == pytest.approx(1.0) and q[1] < 1e-12 and q[2] is None
    assert q[3] == pytest.approx(0.05, abs=6e-4)


def _preds(spark, n=400):
    rows = [(i % 3 == 0, i % 4 == 0, i % 3 == 0 or i % 7 == 0) for i in range(n)]
    return spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in rows], "y int, pb int, pc int")


@pytest.mark.parametrize("method", ["draws", "multinomial"])
def test_bootstrap_counts_sum_and_pairing(spark, method):
    df = _preds(spark)
    cells = bootstrap.joint_cells(df, "y", "pb", "pc")
    res = bootstrap.resample(spark, cells, 30, "b", method)
    totals = res.select(sum(F.col(f"k{i}") for i in range(8)).alias("t")).distinct().collect()
    assert [r.t for r in totals] == [400] and res.count() == 30
    scores = bootstrap.bootstrap_scores(res)
    assert scores.groupBy("iteration").count().filter("count != 2").count() == 0


def test_multinomial_mean_matches_cells(spark):
    df = _preds(spark)
    c = bootstrap.joint_cells(df, "y", "pb", "pc").first()
    res = bootstrap.resample(spark, bootstrap.joint_cells(df, "y", "pb", "pc"), 400, "m", "multinomial")
    means = res.agg(*[F.avg(f"k{i}").alias(f"k{i}") for i in range(8)]).first()
    for i in range(8):
        assert means[f"k{i}"] == pytest.approx(c[f"c{i}"], abs=4 + 0.1 * c[f"c{i}"])


@pytest.mark.parametrize("n, p", [(1, 0.5), (7, 0.3), (40, 0.02), (40, 0.97), (300, 0.5)])
def test_binomial_takes_each_value_for_its_share_of_uniforms(spark, n, p):
    """Over a grid of uniforms every value comes up as often as its probability says."""
    import math
    grid = 20_000
    df = spark.range(grid).select(((F.col("id") + 0.5) / grid).alias("u"))
    got = {r.k: r["count"] for r in df.select(bootstrap.binomial(F.col("u"), F.lit(n), F.lit(p)).alias("k")).groupBy("k").count().collect()}
    for k in range(n + 1):
        assert abs(got.get(k, 0) - grid * math.comb(n, k) * p ** k * (1 - p) ** (n - k)) <= 2


def test_binomial_edges(spark):
    rows = [(0.0, 0, 0.5), (0.3, 5, 0.0), (0.3, 5, 1.0), (0.0, 10 ** 12, 0.4), (1 - 2 ** -52, 10 ** 12, 0.4)]
    got = [r[0] for r in spark.createDataFrame(rows, "u double, n bigint, p double").select(bootstrap.binomial(F.col("u"), F.col("n"), F.col("p"))).collect()]
    assert got[:3] == [0, 0, 5] and all(abs(k - 4 * 10 ** 11) < 13 * (10 ** 12 * 0.24) ** 0.5 for k in got[3:])


def test_multinomial_has_no_python_worker(spark):
    plan = bootstrap.resample_multinomial(spark, [3, 1, 0, 2, 1, 0, 0, 1], 10)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_multinomial_repeatable(spark):
    cells = bootstrap.joint_cells(_preds(spark), "y", "pb", "pc")
    a = bootstrap.resample(spark, cells, 20, "r", "multinomial").orderBy("iteration").collect()
    b = bootstrap.resample(spark, cells, 20, "r", "multinomial").orderBy("iteration").collect()
    assert a == b


def test_compare_scores_and_decision(spark):
    rows = [(i, "base", 0.5 + 0.01 * (i % 5), 0.6) for i in range(50)] + \
           [(i, "candidate", 0.6 + 0.01 * (i % 5), 0.6) for i in range(50)]
    df = spark.createDataFrame(rows, "iteration int, model string, f1 double, precision double")
    out = {r.metric: r for r in stats.compare_scores(df).collect()}
    f1 = out["f1"]
    assert f1.t_statistic < 0 and f1.p_value < 1e-10 and f1.is_significant
    assert f1.improvement == pytest.approx(0.1)
    assert f1.effect_size > 5
    prec = out["precision"]  # zero variance in both: undefined test
    assert prec.t_statistic is None and prec.p_value is None and prec.is_significant is False
    d = stats.deploy_decision(stats.compare_scores(df)).first()
    assert d.should_deploy is True


def test_cohens_d_by_hand(spark):
    rows = [(0, "base", 1.0), (1, "base", 3.0), (0, "candidate", 2.0), (1, "candidate", 6.0)]
    df = spark.createDataFrame(rows, "iteration int, model string, f1 double")
    r = stats.compare_scores(df, ["f1"]).first()
    # means 2 and 4, sample variances 2 and 8
    assert r.effect_size == pytest.approx(2 / (5 ** 0.5))
    assert r.t_statistic == pytest.approx((2 - 4) / ((5 * (1 / 2 + 1 / 2)) ** 0.5))


def test_relative_gain(spark):
    df = spark.createDataFrame([(0.9, 0.8), (0.5, 0.0)], "new double, best double")
    g = [r[0] for r in df.select(stats.relative_gain_pct(F.col("new"), F.col("best"))).collect()]
    assert g[0] == pytest.approx(12.5) and g[1] is None


@pytest.mark.parametrize("base, candidate, significant, p", [(0.0, 1.0, True, 0.0), (1.0, 0.0, True, 0.0), (0.5, 0.5, False, None)])
def test_constant_scores(spark, base, candidate, significant, p):
    rows = [(i, m, v, v) for i in range(5) for m, v in (("base", base), ("candidate", candidate))]
    df = spark.createDataFrame(rows, "iteration int, model string, f1 double, precision double")
    cmp = stats.compare_scores(df)
    row = cmp.where("metric = 'f1'").first()
    assert (row.is_significant, row.p_value, row.effect_size) == (significant, p, None)
    assert stats.deploy_decision(cmp).first().should_deploy == (candidate > base)
