"""Operator 4: removal of repeated passages with automata of recurring phrases.

A word is removed if a window of ``window`` words covers it whose word sequence also starts in a document with a
smaller doc_id.  Every window has a *phrase*: the ``PHRASE``-word run in it with the smallest hash, so equal windows
have equal phrases wherever they stand, and about one run in fifteen is a phrase of some window.

1. Phrases that occur in two documents or more are candidates: one aggregation by hash (phrase, smallest and largest
   id).  The smallest document gives each one's words, which makes the table of recurring passages.
2. Each document gets the words of its candidates from that table.  A shard is about a megabyte of such documents and
   the passages that they may hold: it compiles an Aho-Corasick automaton of those passages and streams its documents
   through it, word by word (words are compared as bytes).  What the automaton locates is the only source of
   windows: a hash that two different phrases share locates nothing.  Automata are bounded, and a passage that is in a
   third of all documents is compiled in many shards instead of gathering these documents in one.
3. Windows around located phrases give (window hash, doc_id); the smallest id per window, joined back, tells which
   windows of which documents are repeats.  Both aggregations combine before the shuffle; the joins are plain joins
   of two shuffled sides, which Spark splits at a hot window.
4. Each document drops the words under its repeats.

Hashes have 64 bits.  The documents are shuffled once by doc_id; the joins with them use that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relearn.llm import words as W
from relearn.llm.arrowutil import as_long
from relearn.llm.common import cut

WINDOW, PHRASE = 50, 20
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i with so many entries."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if have < width else x


def _phrases(s: W.Words, window: int, phrase: int):
    """Hash of the run at each word (``_NONE`` where it would cross a document's end), each window's start and phrase."""
    at, h = s.runs(phrase)
    run = np.full(len(s.hash), _NONE)
    run[at] = h
    starts, hashes = s.runs(window)
    least = sliding_min(run, window - phrase + 1)[starts] if len(starts) else np.zeros(0, np.uint64)
    return run, starts, hashes, least


def _unique_rows(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def _words(s: W.Words, d: int) -> list[bytes]:
    a, b = s.first[d], s.first[d + 1]
    return s.data[s.start[a]:s.end[b - 1]].tobytes().split() if b > a else []


def locate(s: W.Words, passages: list[list[bytes]]) -> np.ndarray:
    """Marks the words of a shard at which one of its passages starts, by one automaton over word numbers.

    ``passages`` are those looked for in each document, their words joined by a space."""
    numbers: dict[bytes, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for passage in {p for mine in passages for p in mine}:
        automaton.add_word(tuple([numbers.setdefault(w, len(numbers) + 1) for w in passage.split()]), 1)
    found = np.zeros(len(s.hash), bool)
    if numbers:
        automaton.make_automaton()
        for d, mine in enumerate(passages):
            if mine:
                ends = np.fromiter((e for e, _ in automaton.iter(tuple([numbers.get(w, 0) for w in _words(s, d)]))), np.int64)
                found[s.first[d] + ends - (PHRASE - 1)] = True
    return found


def phrases(docs: DataFrame, window: int) -> DataFrame:
    """``(phrase, doc_id)``: the phrases of every document's windows."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for s in W.slices(batch.column("text")):
                _, starts, _, least = _phrases(s, window, PHRASE)
                doc, h = _unique_rows(np.searchsorted(s.first, starts, "right") - 1, least)
                yield pa.RecordBatch.from_arrays([as_long(h), batch.column("doc_id").take(pa.array(s.first_doc + doc))], names=["phrase", "doc_id"])
    return docs.select("doc_id", "text").mapInArrow(run, "phrase long, doc_id long")


def passage_words(docs: DataFrame) -> DataFrame:
    """``(phrase, words)``: the words of the phrases in each document's list ``wanted``, joined by a space."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column("wanted")
            for s in W.slices(batch.column("text")):
                at, h = s.runs(PHRASE)
                bounds, hashes, words = np.searchsorted(at, s.first), [], []
                for d in range(s.n_docs):
                    mine = lists[s.first_doc + d].values.to_numpy().view(np.uint64)
                    here = h[bounds[d]:bounds[d + 1]]
                    where = np.flatnonzero(np.isin(here, mine))
                    _, once = np.unique(here[where], return_index=True)
                    text = _words(s, d)
                    hashes.append(here[where[once]])
                    words += [b" ".join(text[i:i + PHRASE]) for i in where[once].tolist()]
                yield pa.RecordBatch.from_arrays([as_long(np.concatenate(hashes)), pa.array(words, pa.binary())], names=["phrase", "words"])
    # all columns, so that the documents' exchange is that of the other joins
    return docs.select("doc_id", "text", "rest", "wanted").mapInArrow(run, "phrase long, words binary")


def located_windows(docs: DataFrame, window: int) -> DataFrame:
    """``(window, doc_id)``: distinct windows whose phrase the automata locate, of documents with a list ``known`` of passages."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column("known")
            for s in W.slices(batch.column("text")):
                runs, starts, hashes, least = _phrases(s, window, PHRASE)
                if not len(starts):
                    continue
                here = np.where(locate(s, lists.slice(s.first_doc, s.n_docs).to_pylist()), runs, _NONE)
                hit = (sliding_min(here, window - PHRASE + 1)[starts] == least) & (least != _NONE)
                doc, h = _unique_rows(np.searchsorted(s.first, starts[hit], "right") - 1, hashes[hit])
                yield pa.RecordBatch.from_arrays([as_long(h), batch.column("doc_id").take(pa.array(s.first_doc + doc))], names=["window", "doc_id"])
    return docs.mapInArrow(run, "window long, doc_id long")


def _raw(text: pa.StringScalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def _without(docs: DataFrame, window: int, schema: T.StructType, original: bool) -> DataFrame:
    """Words and text of each document after dropping the words under the windows listed in ``repeats``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists = batch.column("repeats")
            for s in W.slices(batch.column("text")):
                n = np.diff(s.first)
                gone = np.zeros(s.n_docs, np.int64)
                texts = []
                starts, hashes = s.runs(window)
                ends = np.searchsorted(starts, s.first)
                for d in range(s.n_docs):
                    a, b = s.first[d], s.first[d + 1]
                    words = _words(s, d)
                    if lists[s.first_doc + d].is_valid:
                        hit = np.isin(hashes[ends[d]:ends[d + 1]], lists[s.first_doc + d].values.to_numpy().view(np.uint64))
                        edge = np.zeros(b - a + 1, np.int64)
                        at = starts[ends[d]:ends[d + 1]][hit] - a
                        edge[at] += 1
                        np.add.at(edge, at + window, -1)
                        covered = np.cumsum(edge[:-1]) > 0
                        gone[d] = covered.sum()
                        words = [words[i] for i in np.flatnonzero(~covered)]
                    texts.append(b" ".join(words) if gone[d] or not original else _raw(batch.column("text")[s.first_doc + d]))
                rows = slice(s.first_doc, s.first_doc + s.n_docs)
                out = batch.slice(rows.start, s.n_docs)
                yield pa.RecordBatch.from_arrays(
                    [out.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(gone), pa.array(texts, pa.binary()).cast(pa.string()),
                     out.column("rest")], names=["doc_id", "n_words", "n_removed", "text", "rest"])
    return docs.select("doc_id", "text", "rest", "repeats").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, original: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, text, rest)`` for every row: ``text`` holds the kept words, joined by one space.

    With ``original`` a text that loses nothing stays as it is.  ``rest`` is a struct of the other columns, whatever their names.  Words are runs of other characters than space
    and 0x09-0x0D, unchanged.  Windows are judged on the input, not on what is left, and only against smaller
    doc_ids: the first document keeps a passage, and rows that share a doc_id don't remove each other's words.
    Null, empty and short texts (fewer words than ``window``) lose nothing; null and empty texts give an empty text.
    A row without doc_id loses nothing and removes nothing.  An empty table gives no rows.
    """
    if window <= PHRASE:
        raise ValueError(f"window must be over {PHRASE} words")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("row"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    named = rows.where("doc_id is not null")
    found = phrases(named, window)
    recurring = cut(found.groupBy("phrase").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("phrase", "lo"))
    wanted = recurring.groupBy(F.col("lo").alias("doc_id")).agg(F.collect_list("phrase").alias("wanted"))
    # of rows that share a doc_id several may have the phrase
    passages = passage_words(named.join(wanted, "doc_id")).dropDuplicates(["phrase"])
    known = found.join(passages, "phrase").groupBy("doc_id").agg(F.collect_set("words").alias("known"))
    windows = located_windows(named.join(known, "doc_id").select("doc_id", "text", "rest", "known"), window)
    first = windows.groupBy("window").agg(F.min("doc_id").alias("first"))
    repeats = (windows.join(first, "window").where("doc_id > first")
               .groupBy("doc_id").agg(F.collect_list("window").alias("repeats")))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("text", T.StringType()), T.StructField("rest", rows.schema["rest"].dataType)])
    none = F.lit(None).cast("array<bigint>").alias("repeats")
    return (_without(named.join(repeats, "doc_id", "left"), window, schema, original)
            .unionByName(_without(rows.where("doc_id is null").select("*", none), window, schema, original)))
