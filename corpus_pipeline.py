"""A training-data pipeline over ``documents``: quality, near-duplicates, repeated passages, benchmark leaks, pieces.

Every stage takes ``(spark, docs, sf_dir)``, where ``docs`` is what the stage before kept, and returns a DataFrame.
All but the last return the columns of ``documents``; other columns, whatever their names, end with the first stage.  Rows are matched by doc_id and a hash of the text, so rows that
repeat a doc_id, or have none, are decided each by its own text.  Very long texts are read whole in every stage, and an
empty table stays empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.llm import pieces
from relearn.llm.decontaminate import decontaminate
from relearn.llm.near_dedup import near_duplicates
from relearn.llm.quality import quality_rules
from relearn.llm.substring_dedup import remove_repeats
from relearn.session import checkpoint_path
from relearn.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL: the stages' verdicts come from iterated estimates, hashes and Viterbi segmentation.
ORACLE_SQL = None


def _matched(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (left_semi) or without (left_anti) an equal (doc_id, text_key) in ``rows``."""
    keyed = docs.withColumn("text_key", F.xxhash64("text")).alias("d")
    rows = rows.select("doc_id", "text_key").alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_key") == F.col("r.text_key"))
    return keyed.join(rows, same, how)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, repeated rows included.  Null and empty texts have too few words and go; a null
    lang or source is a group of its own."""
    rejected = quality_rules(docs).where("not kept").distinct()
    return _matched(docs, rejected, "left_anti").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; of equal rows one.  Null texts and texts without words all stay,
    once for each doc_id.  A row without doc_id stays unless a row with one has an equal set."""
    kept = near_duplicates(docs).where("kept")
    one = (kept.where("component is not null").groupBy("component")
           .agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.doc_id", "k.text_key"))
    empty = kept.where("component is null").select("doc_id", "text_key").distinct()
    chosen = _matched(docs, one, "left_semi").dropDuplicates(["doc_id", "text_key"])
    return chosen.unionByName(_matched(docs, empty, "left_semi")).select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that an earlier document has; other texts stay as they are, a null text becomes
    an empty one.  Rows that share a doc_id, and rows without one, don't remove each other's words."""
    out = remove_repeats(docs.select(*COLUMNS), original=True)
    return out.select("doc_id", "text", "rest.lang", "rest.source", F.length("text").cast("long").alias("n_chars"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item; null and empty texts have none."""
    out = decontaminate(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark")).where(F.size("items") == 0)
    return out.select("doc_id", "text", "rest.lang", "rest.source", "rest.n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them restores its text; a null text is an empty one without pieces."""
    vocabulary = pieces.load()
    whole = docs.withColumn("chars", F.coalesce(F.col("text"), F.lit("")))
    out = pieces.decode(pieces.encode(whole, vocabulary, keep=("doc_id", "chars")), vocabulary)
    return out.select("doc_id", "ids", "n_pieces", "n_byte_pieces", (F.col("decoded") == F.col("chars")).alias("restored"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passages", passages), ("leaks", leaks), ("tokens", tokens)]


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared checkpoint folder and read again, and
    dropped when the next stage's result is written."""
    docs, folder = read_table(spark, sf_dir, "documents"), checkpoint_path(spark, f"pipeline-{uuid.uuid4().hex}")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            _drop(spark, f"{folder}/{before}")
        before = name
    return docs
