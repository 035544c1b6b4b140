"""A/B comparison of a champion and a challenger on one table.

Both arms are scored and measured in one job: the arm column is a group key
of the metric aggregation (not two filtered copies with six evaluator passes),
and the comparison is a conditional aggregation over the two-row result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relearn.operators.metrics import score_metrics

ARMS = ("champion", "challenger")
METRICS = ("auc", "accuracy", "f1")


def score_by_arm(df: DataFrame, champion, challenger, arm_col: str = "ab_group",
                 keep: list[str] | None = None) -> DataFrame:
    """A4: score each arm with its own fitted model.

    ``champion`` and ``challenger`` are ``Transformer``s (e.g. ``PipelineModel``)
    adding ``rawPrediction``/``probability``/``prediction``.  Each model only
    sees its arm; the two outputs are unioned by name with the arm column.
    """
    cols = keep or []
    parts = []
    for arm, model in (("champion", champion), ("challenger", challenger)):
        scored = model.transform(df.filter(F.col(arm_col) == arm))
        parts.append(scored.select(*cols, arm_col, positive_score("probability").alias("score"),
                                   F.col("prediction").cast("int").alias("prediction")))
    return parts[0].unionByName(parts[1])


def positive_score(vector_col: str = "probability"):
    """Class-1 component of a probability/rawPrediction vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(vector_col)).getItem(1)


def arm_metrics(scored: DataFrame, label: str, score: str = "score",
                prediction: str = "prediction", arm_col: str = "ab_group") -> DataFrame:
    """A5: auc, accuracy, f1 (label-weighted) and sample size per arm, one job."""
    m = score_metrics(scored, label, score, prediction, [arm_col])
    return m.select(arm_col, F.col("auc_score").alias("auc"), "accuracy",
                    F.col("f1_weighted").alias("f1"), "sample_size")


def compare_arms(metrics_by_arm: DataFrame, arm_col: str = "ab_group") -> DataFrame:
    """Both arms side by side, differences and the winner.

    The challenger wins only on a strictly larger AUC; ties and a missing AUC
    keep the champion.
    """
    def pick(arm, m):
        return F.max(F.when(F.col(arm_col) == arm, F.col(m))).alias(f"{arm}_{m}")
    aggs = [pick(a, m) for a in ARMS for m in (*METRICS, "sample_size")]
    wide = metrics_by_arm.agg(*aggs)
    for m in METRICS:
        wide = wide.withColumn(f"{m}_improvement", F.col(f"challenger_{m}") - F.col(f"champion_{m}"))
    for a in ARMS:
        wide = wide.withColumn(f"{a}_sample_size", F.coalesce(F.col(f"{a}_sample_size"), F.lit(0)).cast("bigint"))
    return wide.withColumn("winner", F.when(F.col("auc_improvement") > 0, F.lit("challenger"))
                           .otherwise(F.lit("champion")))


def result_record(compared: DataFrame, traffic_split: float,
                  as_of: _dt.datetime | None = None) -> DataFrame:
    """The nested result document (one row, struct columns).

    Write it with ``df.write.json`` or turn it into text with ``to_json``.
    """
    ts = (as_of or _dt.datetime.now(_dt.timezone.utc)).isoformat()

    def arm(a):
        return F.struct(F.col(f"{a}_auc").alias("auc"), F.col(f"{a}_accuracy").alias("accuracy"),
                        F.col(f"{a}_f1").alias("f1"), F.col(f"{a}_sample_size").alias("sample_size"))
    gap = F.col("auc_improvement")
    message = (F.when(gap > 0, F.format_string("challenger better by %.4f AUC", gap))
               .otherwise(F.format_string("champion better by %.4f AUC", -F.coalesce(gap, F.lit(0.0)))))
    return compared.select(
        F.lit(ts).alias("timestamp"),
        F.lit(float(traffic_split)).alias("traffic_split"),
        arm("champion").alias("champion_metrics"),
        arm("challenger").alias("challenger_metrics"),
        F.struct(*[F.col(f"{m}_improvement").alias(m) for m in METRICS]).alias("improvements"),
        F.col("winner"),
        message.alias("improvement_message"),
    )


def result_json(record: DataFrame) -> DataFrame:
    """A7 as text: one JSON string per result."""
    return record.select(F.to_json(F.struct(*record.columns)).alias("json"))


def metric_rows(compared: DataFrame, run_id: str, ts: _dt.datetime | None = None) -> DataFrame:
    """The eleven A/B metrics as (run_id, key, value, ts) rows for ``run_metrics``."""
    keys = [f"{a}_{m}" for a in ARMS for m in (*METRICS, "sample_size")] + \
           [f"{m}_improvement" for m in METRICS]
    pairs = ", ".join(f"'{k}', CAST({k} AS DOUBLE)" for k in keys)
    when = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return (compared.selectExpr(f"stack({len(keys)}, {pairs}) AS (key, value)")
            .select(F.lit(run_id).alias("run_id"), "key", "value",
                    F.lit(when).cast("timestamp").alias("ts")))
