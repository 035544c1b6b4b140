"""Rule scorers: deterministic stand-ins for a fitted model.

Metric operators are checked on predictions that do not depend on a fitted
forest (whose trees differ between libraries and seeds).  A scorer adds the
same two columns a fitted pipeline adds for the metric code: a 0/1
``prediction`` and a continuous ``score`` for the ROC AUC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the rule scorers over the transactions view.
BASE_MIN_QUANTITY = 42
CANDIDATE_MIN_QUANTITY = 40
CANDIDATE_MIN_DISCOUNT = 0.06
SCORE_DECIMALS = 4


def base_prediction():
    """Champion / base rule: quantity >= 42."""
    return (F.col("l_quantity") >= BASE_MIN_QUANTITY).cast("int")


def candidate_prediction():
    """Challenger / candidate rule: quantity >= 40 and discount >= 0.06."""
    return ((F.col("l_quantity") >= CANDIDATE_MIN_QUANTITY)
            & (F.col("l_discount") >= F.lit(CANDIDATE_MIN_DISCOUNT))).cast("int")


def base_score():
    """Continuous score of the base rule: the quantity."""
    return F.col("l_quantity").cast("double")


def candidate_score():
    """Continuous score of the candidate rule: quantity x discount, rounded."""
    return F.round(F.col("l_quantity") * F.col("l_discount"), SCORE_DECIMALS)


def score_rules(df: DataFrame) -> DataFrame:
    """Adds ``score_base``/``pred_base`` and ``score_candidate``/``pred_candidate``."""
    return df.select("*", base_score().alias("score_base"), base_prediction().alias("pred_base"),
                     candidate_score().alias("score_candidate"),
                     candidate_prediction().alias("pred_candidate"))


def score_arms(df: DataFrame, arm_col: str = "ab_group") -> DataFrame:
    """A4 with rule scorers: each arm scored by its own model.

    The champion arm gets the base rule, the challenger arm the candidate rule
    (``score`` and ``prediction``), in one projection without a union.
    """
    challenger = F.col(arm_col) == "challenger"
    return df.select("*",
                     F.when(challenger, candidate_score()).otherwise(base_score()).alias("score"),
                     F.when(challenger, candidate_prediction()).otherwise(base_prediction())
                     .alias("prediction"))
