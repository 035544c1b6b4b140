"""Synthetic fraud transactions (G1-G10), generated by Spark at any size.

Every value is a function of the row id and a purpose string through the hash
uniform, so each task generates its own slice of ``spark.range(n)`` with no
shuffle, and a retried task regenerates the same rows.  Distributions follow
the reference's demo data:

* classes: the first ``int(n * (1 - rate))`` ids are normal, the rest fraud;
* log-normal amounts, exponential distances and normal price ratios, from
  uniforms by inverse transform and Box-Muller;
* uniform hours/weekdays and Bernoulli flags;
* shuffle = global rank by a hash (range-partitioned, no one-task sort), ids
  ``tx_%08d``; timestamps ``as_of`` minus 1..43,199 minutes.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_digest, lane_uniform
from relearn.operators.ordered import global_rank
from relearn.operators.sampling import sample_complement, sample_rows

# Fixed values of the demo data.
NUM_SAMPLES = 100_000
FRAUD_RATE = 0.05
SEED = "42"
MAX_MINUTES = 60 * 24 * 30          # timestamps within the last 30 days
TRAIN_FRACTION = 0.8
# (normal, fraud) parameters per column
AMOUNT_LOGNORMAL = ((5.0, 1.0), (6.0, 2.0))           # (mean, sigma) of the log
DISTANCE_HOME_SCALE = (30.0, 100.0)
DISTANCE_LAST_SCALE = (20.0, 100.0)
RATIO_NORMAL = ((1.0, 0.5), (3.0, 1.0))               # (loc, scale)
P_REPEAT_RETAILER = (0.5, 0.2)
P_USED_CHIP = (0.9, 0.2)
P_USED_PIN = (0.8, 0.2)
P_ONLINE = (0.4, 0.8)

ROWS_PER_TASK = 250_000

COLUMNS = ["transaction_id", "timestamp", "amount", "hour_of_day", "day_of_week",
           "distance_from_home", "distance_from_last_transaction", "ratio_to_median_purchase_price",
           "repeat_retailer", "used_chip", "used_pin_number", "online_order", "fraud"]


# Which digest and lane gives each uniform.  A digest is
# md5(seed|digest name|id); each has four 32-bit lanes.
UNIFORM_LANES = {
    "amount_a": ("a", 0), "amount_b": ("a", 1), "hour": ("a", 2), "weekday": ("a", 3),
    "home": ("b", 0), "last": ("b", 1), "ratio_a": ("b", 2), "ratio_b": ("b", 3),
    "repeat": ("c", 0), "chip": ("c", 1), "pin": ("c", 2), "online": ("c", 3),
    "minutes": ("d", 0), "shuffle": ("d", 1),
}
DIGESTS = sorted({d for d, _ in UNIFORM_LANES.values()})


def _digest_col(name: str) -> str:
    return f"__h_{name}"


def _with_digests(df: DataFrame, seed: str) -> DataFrame:
    """One md5 column per digest (kept as columns so each is computed once per row)."""
    return df.select("*", *[hash_digest(f"{seed}|{d}", F.col("id")).alias(_digest_col(d)) for d in DIGESTS])


def _u(purpose: str) -> Column:
    digest, lane = UNIFORM_LANES[purpose]
    return lane_uniform(F.col(_digest_col(digest)), lane)


def _by_class(pair) -> Column:
    normal, fraud = pair
    return F.when(F.col("fraud") == 1, F.lit(fraud)).otherwise(F.lit(normal))


def _normal(purpose: str) -> Column:
    """Standard normal by Box-Muller from two hash uniforms."""
    u1, u2 = _u(purpose + "_a"), _u(purpose + "_b")
    return F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def class_sizes(n: int, fraud_rate: float) -> tuple[int, int]:
    """G1: ``int(n * (1 - rate))`` normal rows, the rest fraud."""
    n_normal = int(n * (1 - fraud_rate))
    return n_normal, n - n_normal


def generate_raw(spark: SparkSession, n: int, fraud_rate: float = FRAUD_RATE, seed: str = SEED,
                 num_partitions: int | None = None) -> DataFrame:
    """Id, class, features, ``minutes_ago`` and ``shuffle_key`` (not yet shuffled)."""
    n_normal, _ = class_sizes(n, fraud_rate)
    # at least one task per core, at most ROWS_PER_TASK rows per task (values
    # depend on the id only, so the split does not change the rows)
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    base = _with_digests(spark.range(0, n, 1, parts).withColumn(
        "fraud", F.when(F.col("id") >= n_normal, F.lit(1)).otherwise(F.lit(0))), seed)
    mu = _by_class(tuple(p[0] for p in AMOUNT_LOGNORMAL))
    sigma = _by_class(tuple(p[1] for p in AMOUNT_LOGNORMAL))
    loc = _by_class(tuple(p[0] for p in RATIO_NORMAL))
    scale = _by_class(tuple(p[1] for p in RATIO_NORMAL))

    def bern(purpose, pair):
        return (_u(purpose) < _by_class(pair)).cast("int")
    return base.select(
        "id", "fraud",
        F.exp(mu + sigma * _normal("amount")).alias("amount"),
        F.floor(_u("hour") * 24).cast("int").alias("hour_of_day"),
        F.floor(_u("weekday") * 7).cast("int").alias("day_of_week"),
        (-_by_class(DISTANCE_HOME_SCALE) * F.log(1.0 - _u("home"))).alias("distance_from_home"),
        (-_by_class(DISTANCE_LAST_SCALE) * F.log(1.0 - _u("last"))).alias("distance_from_last_transaction"),
        (loc + scale * _normal("ratio")).alias("ratio_to_median_purchase_price"),
        bern("repeat", P_REPEAT_RETAILER).alias("repeat_retailer"),
        bern("chip", P_USED_CHIP).alias("used_chip"),
        bern("pin", P_USED_PIN).alias("used_pin_number"),
        bern("online", P_ONLINE).alias("online_order"),
        (F.floor(_u("minutes") * (MAX_MINUTES - 1)) + 1).cast("int").alias("minutes_ago"),
        _u("shuffle").alias("shuffle_key"),
    )


def generate_transactions(spark: SparkSession, n: int = NUM_SAMPLES, fraud_rate: float = FRAUD_RATE,
                          seed: str = SEED, as_of: _dt.datetime | None = None,
                          num_partitions: int | None = None) -> DataFrame:
    """``n`` shuffled transactions in the reference's column order."""
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    raw = generate_raw(spark, n, fraud_rate, seed, num_partitions)
    ranked = global_rank(raw, ["shuffle_key", "id"], "position", uniform_first=True)
    out = ranked.select(
        F.format_string("tx_%08d", F.col("position")).alias("transaction_id"),
        (F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.col("minutes_ago"))).alias("timestamp"),
        *COLUMNS[2:],
    )
    return out


def demo_split(df: DataFrame, fraction: float = TRAIN_FRACTION, seed: str = "demo_split"):
    """80 % training part and its complement, keyed by transaction id."""
    key = [F.col("transaction_id")]
    return sample_rows(df, fraction, seed, key), sample_complement(df, fraction, seed, key)
