"""Operator 1: language identification by compression with per-language dictionaries.

A language's dictionary is raw content: passages of a bounded sample of its labelled documents (``DICTIONARY`` bytes
from at most ``PASSAGES`` documents, chosen by a hash).  Every whole text is compressed with each dictionary, in
blocks so that a long text doesn't become its own dictionary; the language with the smallest total wins.  A win by
a narrow margin is marked ``rejected``.  Texts and passages are folded to lower-case letters and single spaces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PASSAGES, PASSAGE_CHARS, DICTIONARY = 256, 512, 1 << 16
BLOCK = 4096
#: A win is rejected unless it is by more than this share of the smallest size, and by more than these bytes.
MARGIN_SHARE, MARGIN_BYTES = 0.01, 1
#: So many bytes of difference halve a language's weight in the score.
HALF = 4.0
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def folded(text: str | None) -> bytes:
    """Letters in lower case, other runs as one space, a space at both ends; empty if there is no letter."""
    letters = _NOT_LETTERS.sub(" ", text or "").lower().strip()
    return f" {letters} ".encode("utf-8", "replace") if letters else b""


def dictionaries(train: DataFrame) -> tuple[dict[str, bytes], list[str]]:
    """Dictionary of every language of the rows (text, lang, doc_id), and the languages by their number of rows.

    Rows without language or letters teach nothing.  What reaches the driver is bounded: ``PASSAGES`` passages of
    ``PASSAGE_CHARS`` characters per language.
    """
    rows = train.where("lang is not null and text rlike '\\\\p{L}'")
    at = F.xxhash64("doc_id", F.lit("passage"))
    start = 1 + F.pmod(at, F.greatest(F.lit(1).cast("long"), F.length("text").cast("long") - PASSAGE_CHARS))
    passages = rows.select("lang", at.alias("at"), F.col("text").substr(start.cast("int"), F.lit(PASSAGE_CHARS)).alias("passage"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at", "passage"))
    chosen = passages.withColumn("rank", rank).where(F.col("rank") <= PASSAGES).select("lang", "rank", "passage").collect()
    built: dict[str, bytes] = {}
    for row in sorted(chosen, key=lambda r: (r.lang, r.rank)):
        built[row.lang] = (built.get(row.lang, b"") + folded(row.passage))[:DICTIONARY]
    known = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    return built, sorted(built, key=lambda k: (-known[k], k))


def _compressor(dictionary: bytes) -> zstd.ZstdCompressor:
    how = zstd.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=16, search_log=3, min_match=4, target_length=16,
                                         strategy=zstd.STRATEGY_LAZY, write_content_size=0, write_dict_id=0)
    content = zstd.ZstdCompressionDict(dictionary, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(compression_params=how)
    return zstd.ZstdCompressor(compression_params=how, dict_data=content)


def decide(sizes: np.ndarray) -> tuple[int, float, bool]:
    """The smallest size's index (the first of equal ones), its weight among all, and whether the margin is narrow."""
    best = int(sizes.argmin())
    others = np.delete(sizes, best)
    margin = others.min() - sizes[best] if len(others) else np.inf
    score = 1.0 / np.exp2(-(sizes - sizes[best]) / HALF).sum()
    return best, float(score), bool(margin <= max(MARGIN_BYTES, MARGIN_SHARE * sizes[best]))


def identify(docs: DataFrame, built: dict[str, bytes], order: list[str]) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` for every row of ``docs``; equal sizes go to the first in ``order``.

    Null texts, texts without a letter, and all texts when no language was learnt: ``und``, score 0, rejected.
    Rows are judged one by one, whatever their id; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        compressors = [_compressor(built[k]) for k in order]
        for batch in batches:
            langs, scores, rejected = [], [], []
            for value in batch.column("text"):
                data = folded(value.as_py())
                if not data or not compressors:
                    best = (UNKNOWN, 0.0, True)
                else:
                    blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
                    sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in compressors], np.float64)
                    k, score, narrow = decide(sizes)
                    best = (order[k], score, narrow)
                langs.append(best[0])
                scores.append(best[1])
                rejected.append(best[2])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
