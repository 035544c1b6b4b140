"""Operator 10: toxicity by a bidirectional gated recurrent network over all overlapping windows (see ``gru``).

The network is fitted to a bounded sample of the labelled rows: per label at most ``SAMPLE`` documents of any length,
chosen by a hash, each read whole.  The sampled texts stay in tasks: a first pass counts words and trigrams (the
``VOCABULARY`` words of most documents get embeddings), then every epoch the tasks look for each document's highest
window and send that alone, word rows and trigram buckets, to the driver, which makes the epoch's steps.  What reaches the driver is thus bounded by the
numbers of documents, words and buckets, not by the length of texts.

Scoring reads every whole text: windows of 32 words, a stride of 16; a document's score is that of its highest window.
Null and empty texts and texts without letters and digits score 0.  Very long texts are read whole, in
windows.  Rows that repeat a doc_id are scored each by its own text; extra columns are ignored.  An empty table gives no rows; without labels
of both kinds the score is a constant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relearn.llm import gru
from relearn.llm import words as W
from relearn.llm.arrowutil import as_long, hashes
from relearn.llm.common import cut

#: Sampled documents of label 0 and 1 at most; words with an embedding at most.
SAMPLE = (3000, 1000)
VOCABULARY = 1 << 15
UPDATES, BATCH = 240, 128
THRESHOLD = 0.7


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic, text)`` of the sampled documents; of several labels of a document the largest counts, null ones don't.

    Of rows that repeat a doc_id one is taken, that with the smallest text."""
    marks = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    labelled = cut(texts.select("doc_id").distinct().join(marks, "doc_id"))
    at = F.xxhash64("doc_id", F.lit("sample"))
    chosen = [labelled.where(which).orderBy(at, "doc_id").limit(n) for which, n in zip(("toxic <> 1", "toxic = 1"), SAMPLE)]
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")   # 4000 ids at most
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _slices(column: pa.Array) -> Iterator[W.Words]:
    return W.slices(column, lower=True, space=W.NOT_ALPHANUMERIC)


def _counts(rows: DataFrame) -> DataFrame:
    """``(kind, item, seen, hits)``: documents, and those of label 1, that have a word (kind 0, by hash) or trigram bucket (1)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            labels = (batch.column("toxic").to_numpy() == 1).astype(np.int64)
            for s in _slices(batch.column("text")):
                in_word, word, in_gram, gram = gru.documents_with(s)
                for kind, doc, item in ((0, in_word, word), (1, in_gram, gram.astype(np.uint64))):
                    item, number = np.unique(item, return_inverse=True)
                    hit = np.bincount(number, labels[s.first_doc + doc], minlength=len(item)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(item), kind, np.int32)), as_long(item), pa.array(np.bincount(number, minlength=len(item))), pa.array(hit)],
                                                     names=["kind", "item", "seen", "hits"])
    each = rows.mapInArrow(run, "kind int, item long, seen long, hits long")
    return each.groupBy("kind", "item").agg(F.sum("seen").alias("seen"), F.sum("hits").alias("hits"))


def _highest(rows: DataFrame, model: gru.Model, by_odds: bool) -> tuple[np.ndarray, gru.Highest]:
    """doc_ids in order and the highest windows of the documents of ``rows`` that have words."""
    shared = rows.sparkSession.sparkContext.broadcast((model.vocabulary, model.p))

    def run(batches: Iterator[pa.RecordBatch]):
        model = gru.Model(*shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for s in _slices(batch.column("text")):
                t = gru.highest(model, s, by_odds)
                ends = t.first[::gru.WINDOW]
                cut_at = list(zip(ends[:-1], ends[1:]))
                sizes = np.diff(t.first).astype(np.int32).reshape(-1, gru.WINDOW)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[s.first_doc + t.doc]), pa.array([r.astype(np.int32).tobytes() for r in t.rows], pa.binary()), pa.array([m.tobytes() for m in t.mask], pa.binary()),
                     pa.array([z.tobytes() for z in sizes], pa.binary()), pa.array([t.grams[a:b].astype(np.int16).tobytes() for a, b in cut_at], pa.binary()),
                     pa.array([t.share[a:b].tobytes() for a, b in cut_at], pa.binary())], names=["doc_id", "rows", "mask", "sizes", "grams", "share"])
    try:
        got = rows.mapInArrow(run, "doc_id long, rows binary, mask binary, sizes binary, grams binary, share binary").toArrow().sort_by("doc_id")
    finally:
        shared.destroy()

    def joined(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(got[name].to_pylist()), kind)
    first = np.r_[0, np.cumsum(joined("sizes", np.int32), dtype=np.int64)]
    ids = got["doc_id"].to_numpy()
    return ids, gru.Highest(np.arange(len(ids)), joined("rows", np.int32).reshape(-1, gru.WINDOW).astype(np.int64), joined("mask", bool).reshape(-1, gru.WINDOW),
                            first, joined("grams", np.int16).astype(np.int64), joined("share", np.float32))


def fit(rows: DataFrame, updates: int = UPDATES) -> gru.Model | float:
    """The network for the sampled rows; a constant score if they have one label only (0 without rows).

    At least ``updates`` steps, in whole epochs."""
    rows = cut(rows.repartition(rows.sparkSession.sparkContext.defaultParallelism))
    marks = rows.select("doc_id", (F.col("toxic") == 1).cast("long").alias("y")).orderBy("doc_id").toArrow()
    labels = marks["y"].to_numpy()
    if not len(labels) or labels.min() == labels.max():
        return float(labels.max(initial=0))
    counts = cut(_counts(rows))
    often = counts.where("kind = 0 and seen >= 2").orderBy(F.desc("seen"), "item").limit(VOCABULARY).toArrow()
    grams = counts.where("kind = 1").toArrow()
    model = gru.from_counts(labels, (hashes(often["item"].combine_chunks()), often["seen"].to_numpy(), often["hits"].to_numpy()),
                            (grams["item"].to_numpy(), grams["seen"].to_numpy(), grams["hits"].to_numpy()))
    adam, done = gru.Adam(model), 0
    while done < updates:
        ids, tops = _highest(rows, model, done == 0)
        if not len(ids):
            break
        adam.epoch(tops, labels[np.searchsorted(marks["doc_id"].to_numpy(), ids)], BATCH)
        done += -(-len(ids) // BATCH)
    return model


def score(docs: DataFrame, model: gru.Model | float) -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs``; predicted is 1 from ``THRESHOLD`` on.

    Null and empty texts and texts without letters and digits have no window: score 0.  Rows are scored one by one;
    an empty table gives no rows.
    """
    if isinstance(model, float):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(model).alias("score"))
        return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    shared = docs.sparkSession.sparkContext.broadcast((model.vocabulary, model.p))     # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]):
        model = gru.Model(*shared.value)
        for batch in batches:
            for s in W.slices(batch.column("text"), lower=True, space=W.NOT_ALPHANUMERIC):
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-gru.document_logits(model, s)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(s.first_doc, s.n_docs), pa.array(p),
                                                  pa.array((p >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
