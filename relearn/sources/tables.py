"""Parquet scans (S1) and the stand-in views over the test tables.

``load_data`` is the Parquet scan of one input path.  A path per day (or a
``dt=`` partition directory) is how retraining picks fresh data; a filter on
the partition column is pruned at planning time by Spark.

The views below map the generated tables to the reference's data model
(FIXTURES.md): ``lineitem`` stands in for the transactions table with a label
``tx_fraud`` and an event time ``tx_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.functions.hashrand import hash_uniform

LABEL = "tx_fraud"
TIMESTAMP = "tx_timestamp"

# Row key of a transaction.  (l_orderkey, l_linenumber) alone is not unique in
# the generated lineitem; these five columns are, at all three scales.
TX_KEY_NAMES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_qty_key"]

# Train and test weights of the reference job.
DEFAULT_SPLIT = (0.005, 0.0001)

# Fixed values of the stand-in label: a learnable rule plus 3 % label noise.
FRAUD_MIN_QUANTITY = 40
FRAUD_MIN_DISCOUNT = 0.07
LABEL_NOISE = 0.03


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_data(spark: SparkSession, input_path: str) -> DataFrame:
    """Parquet scan of one input path (a file, a directory or a glob)."""
    return spark.read.parquet(input_path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_data(spark, table_path(sf_dir, name))


def tx_key() -> list[Column]:
    """The transaction key columns, for hashing."""
    return [F.col(c) for c in TX_KEY_NAMES]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions view over ``lineitem``.

    Columns: the key, numeric features, ``tx_timestamp`` and the 0/1 label
    ``tx_fraud = (qty >= 40 and discount >= 0.07) XOR (U('noise', key) < 0.03)``.
    """
    li = read_table(spark, sf_dir, "lineitem")
    return transactions_from_lineitem(li)


def transactions_from_lineitem(li: DataFrame) -> DataFrame:
    df = li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("int").alias("l_qty_key"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
        F.col("l_shipdate").alias(TIMESTAMP),
    )
    rule = (F.col("l_quantity") >= FRAUD_MIN_QUANTITY) & (F.col("l_discount") >= F.lit(FRAUD_MIN_DISCOUNT))
    noise = hash_uniform("noise", *tx_key()) < LABEL_NOISE
    return df.withColumn(LABEL, (rule != noise).cast("int"))
