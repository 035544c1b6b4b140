"""Statistical comparison of bootstrap scores.

Per metric: an equal-variance two-sample t-test (sign: base - candidate, as
the reference calls it), Cohen's d with sample variances, the two means and
the improvement; then the deployment rule.  The inputs are B rows per model,
so every step is a small aggregation; the p-value is a JVM expression
(``relearn.functions.tdist``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relearn.functions.tdist import t_two_sided_p

DEFAULT_METRICS = ("f1", "precision")
DEFAULT_ALPHA = 0.01


def compare_scores(scores: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS,
                   alpha: float = DEFAULT_ALPHA, base: str = "base",
                   candidate: str = "candidate", model_col: str = "model") -> DataFrame:
    """One row per metric with t, p, d, significance, means, improvement.

    Zero pooled variance with different means gives t = +-infinity, p = 0 and
    ``is_significant = true``; with equal means NULL t and p and ``false``.  d is
    NULL in both cases.
    """
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"`{m}`").cast("double").alias("value")) for m in metrics]
    long = scores.select(model_col, F.inline(F.array(*rows)))

    def stat(fn, model):
        return fn(F.when(F.col(model_col) == model, F.col("value")))
    agg = long.groupBy("metric").agg(
        stat(F.count, base).alias("n_base"), stat(F.avg, base).alias("base_mean"),
        stat(F.var_samp, base).alias("var_base"),
        stat(F.count, candidate).alias("n_candidate"), stat(F.avg, candidate).alias("candidate_mean"),
        stat(F.var_samp, candidate).alias("var_candidate"),
    )
    nb, nc = F.col("n_base").cast("double"), F.col("n_candidate").cast("double")
    vb, vc = F.col("var_base"), F.col("var_candidate")
    pooled = F.try_divide((nb - 1) * vb + (nc - 1) * vc, nb + nc - 2)
    se = F.sqrt(pooled * (1 / nb + 1 / nc))
    diff = F.col("base_mean") - F.col("candidate_mean")
    t = (F.when(se > 0, diff / se).when((se == 0) & (diff > 0), F.lit(float("inf")))
         .when((se == 0) & (diff < 0), F.lit(float("-inf"))))
    d = _div(F.abs(F.col("candidate_mean") - F.col("base_mean")), F.sqrt((vb + vc) / 2))
    # t is a column before the p-value reads it: the series then refers to
    # one attribute instead of repeating the whole t expression.
    with_t = agg.select("*", t.alias("t_statistic"), d.alias("effect_size"),
                        (F.col("n_base") + F.col("n_candidate") - 2).alias("__dof"))
    infinite = F.abs(F.col("t_statistic")) == F.lit(float("inf"))
    p = F.when(infinite, F.lit(0.0)).otherwise(t_two_sided_p(F.col("t_statistic"), F.col("__dof")))
    return with_t.select(
        "metric",
        "t_statistic",
        p.alias("p_value"),
        "effect_size",
        F.coalesce(p < F.lit(float(alpha)), F.lit(False)).alias("is_significant"),
        "base_mean", "candidate_mean",
        (F.col("candidate_mean") - F.col("base_mean")).alias("improvement"),
    )


def _div(num: Column, den: Column) -> Column:
    """num / den; NULL when den is 0 or NULL."""
    return F.when(den > 0, num / den)


def deploy_decision(comparison: DataFrame, metric: str = "f1") -> DataFrame:
    """Deploy when the F1 difference is significant and the candidate is better."""
    row = comparison.filter(F.col("metric") == metric)
    return row.select(
        (F.col("is_significant") & F.coalesce(F.col("improvement") > 0, F.lit(False))).alias("should_deploy"),
        F.col("is_significant").alias("f1_significant"),
        F.col("improvement").alias("f1_improvement"),
        F.col("p_value").alias("f1_p_value"),
    )


def relative_gain_pct(new: Column, best: Column) -> Column:
    """(new - best) / best * 100; NULL when best is 0 or NULL."""
    return F.try_divide(new - best, best) * 100
