"""Operator 5: a hashed maximum-entropy language model with a class-factored softmax.

p(word | context) = p(class | two classes before) p(word | class).  The commonest training words are classes of
their own, as is a text's end; other words belong to the class of their last two bytes, hashed.  The class softmax
has hashed features of the context: the class before, the class two words before (a skip feature) and the pair.  Its
training data are the counts of all class triples of the training texts, a table bounded by the number of classes;
its gradient is summed over parts of that table by Spark tasks, ``ROUNDS`` times, and the driver steps the weights.
A word within its class has its smoothed frequency, the maximum-likelihood weight of a bias feature.

Texts are scored in batches from the table of class log probabilities.  Counts of the ``TOP`` commonest words are
broadcast (a fixed bound); the other words of a text, about a tenth, meet the whole table of counts in one join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relearn.llm import words as W
from relearn.llm.arrowutil import as_long
from relearn.llm.common import cut

OWN, SUFFIXES = 63, 64
CLASSES = OWN + 1 + SUFFIXES          # words of their own, the end, suffix classes
END_CLASS = OWN
FEATURES = 1 << 13
ROUNDS, RATE = 12, 0.5
TOP = 1 << 19
_END = np.uint64(0xE0D0E0D0E0D0E0D1)  # the end's hash


def suffix_class(s: W.Words) -> np.ndarray:
    """Class of every word by its last two bytes (A-Z as a-z)."""
    last = s.data[s.end - 1].astype(np.uint64)
    before = np.where(s.end - s.start > 1, s.data[np.maximum(s.end - 2, 0)], 0).astype(np.uint64)
    lower = lambda x: np.where((x >= 65) & (x <= 90), x + 32, x)
    return (END_CLASS + 1 + (W.mix(lower(before) * np.uint64(256) + lower(last)) % np.uint64(SUFFIXES))).astype(np.int64)


def word_counts(train: DataFrame) -> DataFrame:
    """``(hash, class, n)`` of every distinct token of the texts; the end is counted once a row."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            hashes, classes, counts = [np.array([_END])], [np.array([END_CLASS])], [np.array([batch.num_rows])]
            for s in W.slices(batch.column("text"), lower=True):
                h, at, n = np.unique(s.hash, return_index=True, return_counts=True)
                hashes.append(h)
                classes.append(suffix_class(s)[at])
                counts.append(n)
            h, at, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate(counts), minlength=len(h)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([as_long(h), pa.array(np.concatenate(classes)[at].astype(np.int32)), pa.array(n)], names=["hash", "class", "n"])
    return train.select("text").mapInArrow(run, "hash long, class int, n long").groupBy("hash", "class").agg(F.sum("n").alias("n"))


def commonest(counts: DataFrame) -> DataFrame:
    """The words of the highest counts, ``TOP`` at most: all from a count on that a small histogram gives."""
    cell = F.floor(F.log2("n") * 8)
    cells = counts.groupBy(cell.alias("cell")).agg(F.count("*").alias("words")).orderBy(F.desc("cell")).collect()   # some hundred rows
    least, words = 1 << 30, 0
    for row in cells:
        words += row.words
        if words > TOP:
            break
        least = row.cell
    return counts.where(cell >= least)


def own_words(counts: DataFrame) -> DataFrame:
    """The ``OWN`` commonest words, whatever ``commonest`` leaves out; of equal counts the smallest hashes, unsigned."""
    unsigned = F.col("hash").bitwiseXOR(F.lit(-1 << 63))
    return counts.where(F.col("hash") != int(_END.astype(np.int64))).orderBy(F.desc("n"), unsigned).limit(OWN)


def _classes(s: W.Words, own: np.ndarray) -> np.ndarray:
    """Class of every word; ``own``: sorted hashes with a class each (their class is their place)."""
    cls = suffix_class(s)
    if len(own):
        at = np.minimum(np.searchsorted(own, s.hash), len(own) - 1)
        cls = np.where(own[at] == s.hash, at, cls)
    return cls


def _tokens(s: W.Words, values: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` of the words with ``end`` after every document, and the index of each document's first token."""
    first = s.first + np.arange(s.n_docs + 1)
    out = np.full(first[-1], end, values.dtype)
    out[np.arange(len(values)) + s.doc()] = values
    return out, first


def _contexts(cls: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of the pair of classes before every token; before a text's start stand ends."""
    place = np.arange(len(cls)) - np.repeat(first[:-1], np.diff(first))
    one = np.where(place >= 1, np.r_[END_CLASS, cls[:-1]][:len(cls)], END_CLASS)
    two = np.where(place >= 2, np.r_[END_CLASS, END_CLASS, cls[:-2]][:len(cls)], END_CLASS)
    return two * CLASSES + one


def triples(train: DataFrame, own: np.ndarray) -> DataFrame:
    """``(context, class, n)`` over all training tokens; at most ``CLASSES`` cubed rows."""
    shared = train.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(CLASSES ** 3, np.int64)
        for batch in batches:
            for s in W.slices(batch.column("text"), lower=True):
                cls, first = _tokens(s, _classes(s, shared.value), END_CLASS)
                cells, n = np.unique(_contexts(cls, first) * CLASSES + cls, return_counts=True)
                total[cells] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // CLASSES), pa.array((at % CLASSES).astype(np.int32)), pa.array(total[at])], names=["context", "class", "n"])
    return train.select("text").mapInArrow(run, "context long, class int, n long").groupBy("context", "class").agg(F.sum("n").alias("n"))


def features(context: np.ndarray) -> np.ndarray:
    """Hashed features of contexts: class before, class two before, the pair."""
    one, two = (context % CLASSES).astype(np.uint64), (context // CLASSES).astype(np.uint64)
    keys = np.stack([one, two + np.uint64(1000), one + two * np.uint64(CLASSES) + np.uint64(10_000)], 1)
    return (W.mix(keys) % np.uint64(FEATURES)).astype(np.int64)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def train_classes(counts: DataFrame, class_totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES, CLASSES) and bias after ``ROUNDS`` gradient updates over the triples ``counts``."""
    counts = cut(counts.repartition("context"))
    sc, total = counts.sparkSession.sparkContext, max(class_totals.sum(), 1)
    bias = np.log((class_totals + 0.5) / (total + 0.5 * CLASSES)).astype(np.float32)
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    speed = np.full((FEATURES, CLASSES), 1e-8, np.float32)
    for _ in range(ROUNDS):
        shared = sc.broadcast((weights, bias))

        def run(batches: Iterator[pa.RecordBatch]):
            w, b = shared.value
            grad, hit = np.zeros((FEATURES, CLASSES), np.float32), np.zeros(FEATURES, np.float32)
            for batch in batches:
                contexts, at = np.unique(batch.column("context").to_numpy(), return_inverse=True)
                seen = np.zeros((len(contexts), CLASSES), np.float32)
                np.add.at(seen, (at, batch.column("class").to_numpy()), batch.column("n").to_numpy().astype(np.float32))
                f = features(contexts)
                n = seen.sum(1, keepdims=True)
                d = seen - n * np.exp(_log_softmax(b + w[f].sum(1)))
                for k in range(f.shape[1]):
                    np.add.at(grad, f[:, k], d)
                    np.add.at(hit, f[:, k], n[:, 0])
            rows = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(hit[rows].astype(np.float64)), pa.array([g.tobytes() for g in grad[rows]], pa.binary())],
                                             names=["feature", "hit", "grad"])
        grad, hit = np.zeros_like(weights), np.zeros(FEATURES)
        parts = counts.mapInArrow(run, "feature long, hit double, grad binary").toArrow()     # FEATURES rows a part at most
        if parts.num_rows:
            at = parts["feature"].to_numpy()
            np.add.at(grad, at, np.frombuffer(b"".join(parts["grad"].to_pylist()), np.float32).reshape(-1, CLASSES))
            np.add.at(hit, at, parts["hit"].to_numpy())
        step = grad / np.maximum(hit, 1)[:, None].astype(np.float32)
        speed += step * step
        weights = weights + RATE * step / np.sqrt(speed)
    return weights, bias


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``, learning from ``train``.

    A null text is an empty one: its only token is the end.  Repeated rows are scored alike and all returned, rows
    that share a doc_id each by its own text; a null doc_id stays null.  Without training rows every token is unknown
    (N = 0, V = 0).  An empty table gives no rows.
    """
    spark = docs.sparkSession
    counts = cut(word_counts(train))
    by_class = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()          # CLASSES rows at most
    best = own_words(counts).toArrow()                                                                        # OWN rows at most
    top = pa.concat_tables([commonest(counts).toArrow(), best])                                               # TOP and OWN rows at most
    top_hash, at = np.unique(top["hash"].to_numpy().view(np.uint64), return_index=True)
    top_n = top["n"].to_numpy()[at]
    own = np.sort(best["hash"].to_numpy().view(np.uint64))
    totals, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    totals[by_class["class"].to_numpy()] = by_class["n"].to_numpy()
    kinds[by_class["class"].to_numpy()] = by_class["v"].to_numpy()
    n_all, v_all = totals.sum(), kinds.sum()
    # the commonest words leave their suffix classes
    own_n = top_n[np.searchsorted(top_hash, own)] if len(own) else np.zeros(0)
    suffix = dict(zip(best["hash"].to_numpy().view(np.uint64).tolist(), best["class"].to_pylist()))
    for k, h in enumerate(own.tolist()):
        totals[suffix[h]] -= own_n[k]
        kinds[suffix[h]] -= 1
        totals[k], kinds[k] = own_n[k], 1
    del suffix
    weights, bias = train_classes(triples(train, own), totals)
    contexts = np.arange(CLASSES * CLASSES)
    table = np.concatenate([_log_softmax(bias + weights[features(contexts[i:i + 4096])].sum(1)) for i in range(0, len(contexts), 4096)])
    table = (table / np.log(10)).astype(np.float32)
    below = np.where(np.arange(CLASSES) <= END_CLASS, totals, totals + 0.5 * (kinds + 1))     # a class of one word is that word
    base_below = n_all + 0.5 * (v_all + 1)
    shared = spark.sparkContext.broadcast((own, top_hash, top_n, table, below, base_below, float(totals[END_CLASS])))

    def run(batches: Iterator[pa.RecordBatch]):
        own, top_hash, top_n, table, below, base_below, end_n = shared.value
        for batch in batches:
            for s in W.slices(batch.column("text"), lower=True):
                cls = _classes(s, own)
                tokens, first = _tokens(s, cls, END_CLASS)
                lp = table[_contexts(tokens, first), tokens].astype(np.float64)
                h, back = np.unique(s.hash, return_inverse=True)
                at = np.minimum(np.searchsorted(top_hash, h), max(len(top_hash) - 1, 0))
                found = top_hash[at] == h if len(top_hash) else np.zeros(len(h), bool)
                c = np.where(found, top_n[at], 0)[back] if len(top_hash) else np.zeros(len(s.hash))
                known = found[back]
                doc = s.doc()
                add = lambda x: np.bincount(doc, x, minlength=s.n_docs)
                base = add(np.where(known, np.log10((c + 0.5) / base_below), 0.0)) + np.log10((end_n + 0.5) / base_below)
                inside = np.where(cls < OWN, 0.0, np.log10(np.where(known, c + 0.5, 1.0) / below[cls]))
                model = add(np.where(known, inside, 0.0)) + np.add.reduceat(lp, first[:-1])
                n = np.diff(s.first)
                key = np.zeros(s.n_docs, np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    key[full] = W.mix(np.add.reduceat(W.mix(s.hash + (np.arange(len(doc)) - s.first[doc]).astype(np.uint64)), s.first[full]))
                ids = batch.column("doc_id").slice(s.first_doc, s.n_docs)
                zeros = pa.array(np.zeros(s.n_docs, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [ids, as_long(key), as_long(W.mix(key + np.uint64(1))), pa.array(np.full(s.n_docs, -1, np.int32)), zeros,
                     pa.array((n + 1).astype(np.int64)), pa.array(add(known).astype(np.int64) + int(end_n > 0)), pa.array(base), pa.array(model)], schema=schema)
                rare = np.flatnonzero(~known)
                if len(rare):
                    pairs, at, tf = np.unique(doc[rare] * len(h) + back[rare], return_index=True, return_counts=True)
                    d, w = pairs // len(h), rare[at]
                    none = pa.nulls(len(d), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(d)), as_long(key[d]), as_long(s.hash[w]), pa.array(cls[w].astype(np.int32)), pa.array(tf.astype(np.int64)),
                         none, none, none.cast(pa.float64()), none.cast(pa.float64())], schema=schema)
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("hash", pa.int64()), ("class", pa.int32()), ("tf", pa.int64()),
                        ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("model", pa.float64())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = rows.mapInArrow(run, "doc_id long, text_key long, hash long, class int, tf long, n_tokens long, n_known long, base double, model double")
    met = parts.join(counts.select("hash", "n"), "hash", "left").join(
        F.broadcast(spark.createDataFrame([(i, float(b)) for i, b in enumerate(below)] + [(-1, 1.0)], "class int, below double")), "class")
    word = F.col("class") >= 0
    up = F.coalesce("n", F.lit(0)) + 0.5
    sums = met.groupBy("doc_id", "text_key").agg(
        F.sum(F.when(~word, 1).otherwise(0)).alias("copies"), F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("known"),
        F.max("base").alias("base"), F.max("model").alias("model"),
        F.sum(F.when(word & F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("more_known"),
        F.sum(F.when(word, F.col("tf") * F.log10(up / float(base_below))).otherwise(0.0)).alias("more_base"),
        F.sum(F.when(word, F.col("tf") * F.log10(up / F.col("below"))).otherwise(0.0)).alias("more_model"))
    one = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return one.select("doc_id", "n_tokens", (F.col("known") + F.col("more_known") / F.col("copies")).cast("long").alias("n_known"),
                      F.lit(int(n_all)).cast("long").alias("train_tokens"), (F.col("base") + F.col("more_base") / F.col("copies")).alias("base_score"),
                      (F.col("model") + F.col("more_model") / F.col("copies")).alias("score"))
