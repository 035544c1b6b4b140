"""Classification metrics as DataFrame aggregations.

Two families, kept under distinct names because the reference uses the same
words for different numbers:

* score metrics of the Spark job: ``auc_score`` (area under the ROC curve of a
  continuous score, exact), ``accuracy`` and ``f1_weighted`` (label-weighted F1
  over both classes, as Spark's multiclass evaluator reports ``f1``);
* label metrics of the URL job: ``precision``, ``recall``, ``f1_binary`` (class
  1) and ``auc_label`` (ROC AUC of hard 0/1 predictions = (TPR + TNR) / 2).

Every metric is a function of grouped counts, so metrics for many models, arms
or days come from one pass with a ``groupBy``; map-side partial aggregation
keeps the shuffle at one row per group and task.  Undefined ratios follow the
library defaults the reference relies on (0 for precision/recall/F1 with an
empty denominator); AUCs are NULL when a class is missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relearn.operators.ordered import PART, range_offsets, range_parts

COUNT_COLS = ["tp", "fp", "fn", "tn"]


def _ratio0(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (zero_division = 0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _ratio_null(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def confusion_counts(df: DataFrame, label: str, prediction: str,
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn and n per group; class 1 is positive.

    Rows with a null label or prediction are not counted.
    """
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*group_cols).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ).withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))


# -- metric expressions over count columns --------------------------------

def precision_expr(tp="tp", fp="fp") -> Column:
    return _ratio0(F.col(tp), F.col(tp) + F.col(fp))


def recall_expr(tp="tp", fn="fn") -> Column:
    return _ratio0(F.col(tp), F.col(tp) + F.col(fn))


def f1_binary_expr(tp="tp", fp="fp", fn="fn") -> Column:
    """F1 of class 1; 0 when there is no positive label and no positive prediction."""
    return _ratio0(2 * F.col(tp), 2 * F.col(tp) + F.col(fp) + F.col(fn))


def auc_label_expr(tp="tp", fp="fp", fn="fn", tn="tn") -> Column:
    """ROC AUC of hard labels: (TPR + TNR) / 2, NULL when a class is missing."""
    tpr = _ratio_null(F.col(tp), F.col(tp) + F.col(fn))
    tnr = _ratio_null(F.col(tn), F.col(tn) + F.col(fp))
    return (tpr + tnr) / 2


def accuracy_expr(tp="tp", fp="fp", fn="fn", tn="tn") -> Column:
    n = F.col(tp) + F.col(fp) + F.col(fn) + F.col(tn)
    return _ratio0(F.col(tp) + F.col(tn), n)


def _f_measure(prec: Column, rec: Column) -> Column:
    return F.when(prec + rec == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))


def f1_weighted_expr(tp="tp", fp="fp", fn="fn", tn="tn") -> Column:
    """Label-weighted F1 over classes 0 and 1 (the multiclass evaluator's ``f1``).

    Each true class contributes its F1 times its share of rows; precision of a
    class never predicted is 0.
    """
    tp_, fp_, fn_, tn_ = (F.col(c) for c in (tp, fp, fn, tn))
    n = (tp_ + fp_ + fn_ + tn_).cast("double")
    f1_pos = _f_measure(_ratio0(tp_, tp_ + fp_), _ratio0(tp_, tp_ + fn_))
    f1_neg = _f_measure(_ratio0(tn_, tn_ + fn_), _ratio0(tn_, tn_ + fp_))
    weighted = f1_pos * (tp_ + fn_) / n + f1_neg * (tn_ + fp_) / n
    return F.when(n > 0, weighted).otherwise(F.lit(0.0))


def label_metrics(counts: DataFrame) -> DataFrame:
    """E4-E5 (+ accuracy, weighted F1) from a ``confusion_counts`` table."""
    return counts.select(
        "*",
        precision_expr().alias("precision"),
        recall_expr().alias("recall"),
        f1_binary_expr().alias("f1_binary"),
        auc_label_expr().alias("auc_label"),
        accuracy_expr().alias("accuracy"),
        f1_weighted_expr().alias("f1_weighted"),
    )


def evaluate_predictions(df: DataFrame, label: str, prediction: str,
                         group_cols: Sequence[str] = ()) -> DataFrame:
    """The metric set of each model/arm/group in one aggregation."""
    return label_metrics(confusion_counts(df, label, prediction, group_cols))


def evaluate_models(df: DataFrame, label: str, predictions: dict[str, str],
                    group_cols: Sequence[str] = (), model_col: str = "model") -> DataFrame:
    """E6 for several models scored on the same rows, in one pass.

    ``predictions`` maps a model name to its prediction column.  The counts of
    all models come from one aggregation; only the small result is unpivoted.
    """
    y = F.col(label)
    aggs = []
    for name, pc in predictions.items():
        p = F.col(pc)
        aggs += [F.count_if((y == 1) & (p == 1)).alias(f"{name}__tp"),
                 F.count_if((y == 0) & (p == 1)).alias(f"{name}__fp"),
                 F.count_if((y == 1) & (p == 0)).alias(f"{name}__fn"),
                 F.count_if((y == 0) & (p == 0)).alias(f"{name}__tn")]
    wide = df.groupBy(*group_cols).agg(*aggs)
    rows = [F.struct(F.lit(name).alias(model_col),
                     *[F.col(f"{name}__{c}").alias(c) for c in COUNT_COLS])
            for name in predictions]
    long = wide.select(*group_cols, F.explode(F.array(*rows)).alias("__m")) \
        .select(*group_cols, "__m.*")
    long = long.withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return label_metrics(long)


# -- exact ROC AUC of a score (E1) -----------------------------------------

def score_counts(df: DataFrame, label: str, score: str,
                 group_cols: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct (group, score).

    Rows with a null label or score are not counted.  Partial aggregation runs
    before the shuffle, so a hot score value costs one row per task.
    """
    y = F.col(label)
    return (df.filter(F.col(score).isNotNull())
            .groupBy(*group_cols, score)
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")))


def roc_auc(df: DataFrame, label: str, score: str, group_cols: Sequence[str] = (),
            num_parts: int | None = None, out: str = "auc_score") -> DataFrame:
    """Exact area under the ROC curve of ``score`` per group.

    Equals the trapezoid over all distinct thresholds (Spark's evaluator with
    ``numBins=0``) and the Mann-Whitney statistic with ties counted half:

        AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)

    Returns ``pos``, ``neg`` and NULL AUC when a class is missing.
    """
    counts = score_counts(df, label, score, group_cols)
    return roc_auc_from_counts(counts, score, group_cols, num_parts, out)


def roc_auc_from_counts(counts: DataFrame, score: str, group_cols: Sequence[str] = (),
                        num_parts: int | None = None, out: str = "auc_score",
                        carry: Sequence[str] = ()) -> DataFrame:
    """E1 from a (group, score, pos, neg) table with one row per distinct score.

    ``neg_below`` is a prefix sum over distinct scores, computed per key range
    plus range offsets (``relearn.operators.ordered``), never in one task.
    Integer parts are summed as decimal(38, 0), so the result is exact and does
    not depend on row order or retries.
    """
    g = list(group_cols)
    parts = range_parts(counts, [score], g, num_parts)
    w = (Window.partitionBy(*g, PART).orderBy(score)
         .rowsBetween(Window.unboundedPreceding, -1))
    dec = "decimal(38,0)"
    local = parts.withColumn("__below", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    per_part = local.groupBy(*g, PART).agg(
        F.sum(F.col("pos").cast(dec) * (2 * F.col("__below") + F.col("neg")).cast(dec)).alias("__num2"),
        F.sum("pos").alias("__pos"),
        F.sum("neg").alias("__neg"),
        *[F.sum(c).alias(c) for c in carry],
    )
    with_off = range_offsets(per_part, g, ["__neg"])
    num2 = F.col("__num2") + (2 * F.col("__pos")).cast(dec) * F.col("off___neg").cast(dec)
    totals = with_off.groupBy(*g).agg(
        F.sum(num2).alias("__num2"),
        F.sum("__pos").cast("bigint").alias("pos"),
        F.sum("__neg").cast("bigint").alias("neg"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in carry],
    )
    den = 2.0 * F.col("pos").cast("double") * F.col("neg").cast("double")
    auc = F.when(den > 0, F.col("__num2").cast("double") / den)
    return totals.select(*g, "pos", "neg", *carry, auc.alias(out))


def score_metrics(df: DataFrame, label: str, score: str, prediction: str,
                  group_cols: Sequence[str] = ()) -> DataFrame:
    """E1-E3 per group: ``auc_score``, ``accuracy``, ``f1_weighted`` and size.

    The metric triple the training job logs for a model or an A/B arm.  One
    scan and one linear plan: rows are reduced to counts per (group, score)
    that also hold the confusion cells of the prediction; those cells ride
    along as sums through the AUC's range stages, so nothing is joined back.
    """
    g = list(group_cols)
    y, p = F.col(label), F.col(prediction)
    counts = (df.filter(F.col(score).isNotNull())
              .groupBy(*g, score)
              .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
                   F.count_if((y == 1) & (p == 1)).alias("tp"),
                   F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"),
                   F.count_if((y == 0) & (p == 0)).alias("tn")))
    totals = roc_auc_from_counts(counts, score, g, carry=COUNT_COLS)
    return totals.select(*g, accuracy_expr().alias("accuracy"), f1_weighted_expr().alias("f1_weighted"),
                         (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("sample_size"),
                         "auc_score")

