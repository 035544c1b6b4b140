"""Operator 9: benchmark decontamination by latent semantic retrieval.

1. Words (letters and digits, lower case) are hashed into ``BUCKETS``; document frequencies over all documents give
   the inverse frequencies.
2. A randomised SVD of TF-IDF passages finds ``RANK`` latent directions: all passages of the benchmark and of all
   documents.  Tasks project their passages and sum their share of A'(A G), ``PASSES`` times over all texts; blocks of
   buckets are added up in parallel, the driver orthogonalises a matrix of fixed size.
3. Every document is read whole in windows of two blocks of ``BLOCK`` words.  Their latent vectors are block sums of
   one table row per word, compared with all benchmark passages in one matrix product.  What counts is containment,
   the product over the passage's own norm squared: a passage that lies in a window has about 1, whatever words stand
   around it.  ``NEAR`` is under half (``PARAPHRASE``) of the three quarters of a passage that its best window holds
   at the worst alignment.
4. Candidates are checked on words: the longest common subsequence of the item with a stretch of the document
   1.5 times as long (bit-parallel; items of up to ``_LANES`` words for all candidates of a slice at once).  Pairs in which no stretch has enough words of the item, an upper bound, are left out first.  ``COPY`` of the item's words is a leak, as is ``PARAPHRASE`` of them if also ``ANSWER`` of the
   words of its last sentence (taken as the answer) are in the stretch.

Benchmarks are searched in blocks of ``ITEMS`` items, each a broadcast by itself, all in one pass over the documents.
Retrieval departs from a cosine in this: the window's norm is left out, as its other words must not count.
Very long texts are read whole, a slice at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relearn.llm import words as W
from relearn.llm.arrowutil import binary_rows, matrix

BUCKETS, RANK, OVERSAMPLE, PASSES = 1 << 14, 160, 8, 2
BLOCK = 16
#: Tasks of a pass, each with sums of fixed size, and the passages from which on there are more tasks.
TASKS, TASK_PASSAGES = 16, 1 << 20
ITEMS = 5000
#: Squared weight in the decomposition of a benchmark's passage, and of all documents' passages together (1 each at most).
ITEM_WEIGHT, DOCS_WEIGHT = 64.0, 4000.0
NEAR = 0.25
COPY, PARAPHRASE, ANSWER = 0.7, 0.5, 0.5
_SLICE, _CELLS, _ROWS, _LANES, _BLOCKS, _MANY = 1 << 20, 1 << 18, 1 << 9, 64, 1 << 14, 16


def _slices(column: pa.Array) -> Iterator[W.Words]:
    return W.slices(column, lower=True, most=_SLICE, space=W.NOT_ALPHANUMERIC)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(50)).astype(np.int64)


def _cells(row: np.ndarray, n_rows: int, bucket: np.ndarray) -> np.ndarray:
    """A number for each pair of row and bucket, in few bytes, as they are sorted."""
    return (row * BUCKETS + bucket).astype(np.uint32 if n_rows * BUCKETS < 1 << 32 else np.int64)


def inverse_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """ln((1 + n) / (1 + n with the bucket)) of every bucket, over all documents, and the documents' number of passages;
    ``BUCKETS`` rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]):
        have, n, passages = np.zeros(BUCKETS, np.int64), 0, 0
        for batch in batches:
            n += batch.num_rows
            for s in _slices(batch.column("text")):
                pairs = np.sort(_cells(s.doc(), s.n_docs, _bucket(s.hash)))
                have += np.bincount(pairs[np.r_[True, pairs[1:] != pairs[:-1]][:len(pairs)]] % BUCKETS, minlength=BUCKETS)
                passages += len(_passages(s)[1])
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, at]), pa.array(np.r_[passages, n, have[at]])], names=["bucket", "n"])
    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    have = np.zeros(BUCKETS)
    have[at[at >= 0]] = n[at >= 0]
    return np.log((1 + n[at == -1].sum()) / (1 + have)), int(n[at == -2].sum())


def _passages(s: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last block (its end) of every window of a slice as word numbers; and the documents' window counts."""
    n = np.diff(s.first)
    blocks = -(-n // BLOCK)
    count = np.where(n > 0, np.maximum(blocks - 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = s.first[doc] + k * BLOCK
    return np.stack([start, np.minimum(start + 2 * BLOCK, s.first[doc + 1])], 1), doc


def _grid(s: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of a slice's words, a column for each block (``BUCKETS`` for words that a document's last block lacks);
    the document and the last block's mark of each block, and the block of each word."""
    n = np.diff(s.first)
    blocks = -(-n // BLOCK)
    ends = np.cumsum(blocks)
    at = np.arange(len(s.hash)) + np.repeat(BLOCK * (ends - blocks) - s.first[:-1], n)
    flat = np.full(BLOCK * int(blocks.sum()), BUCKETS, np.uint16)
    flat[at] = _bucket(s.hash)
    last = np.zeros(len(flat) // BLOCK, bool)
    last[ends[n > 0] - 1] = True
    return np.ascontiguousarray(flat.reshape(-1, BLOCK).T), np.repeat(np.arange(len(n)), blocks), last, at // BLOCK


def _opening(last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the blocks that open a window: all but the last of several; and of those that open a document."""
    first = np.r_[True, last[:-1]][:len(last)]
    return ~last | first, first


def _squared_norms(words: np.ndarray, last: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Squared norms of the TF-IDF rows of the windows that the blocks open: over pairs of equal buckets, so nothing is sorted."""
    width, flat = words.shape[1], words.ravel()
    squares = np.r_[idf * idf, 0.0].astype(np.float32)[flat]
    same, equal = np.ones((2, len(flat)), np.uint8), np.empty(len(flat), bool)
    inside, across = same
    across[:] = 0
    for d in range(1, BLOCK):                        # in a block: each word and the one d words on, counted twice
        a = (BLOCK - d) * width
        inside[:a] += np.left_shift(np.equal(flat[:a], flat[d * width:], out=equal[:a]).view(np.uint8), 1)
    for d in range(1 - BLOCK, BLOCK):                # in a block and the next one, which is a column on
        a, b = max(0, -d * width - 1), len(flat) - max(0, d * width + 1)
        if a < b:
            across[a:b] += np.equal(flat[a:b], flat[a + d * width + 1:b + d * width + 1], out=equal[:b - a]).view(np.uint8)
    own = (squares * inside).reshape(BLOCK, width).sum(0, dtype=np.float64)
    both = 2 * (squares * across).reshape(BLOCK, width).sum(0, dtype=np.float64)
    both[:-1] += own[1:]
    return own + np.where(last, 0.0, both)


def _add_by_bucket(sums: np.ndarray, bucket: np.ndarray, block: np.ndarray, out: np.ndarray) -> None:
    """Adds to each bucket's row of ``out`` the ``sums`` of the blocks of its words.

    The buckets of many words are one matrix product of their counts; those of few words take a word each at a time, so
    that rows stay in the processor's cache."""
    order = block[np.argsort(bucket, kind="stable")]
    n = np.bincount(bucket, minlength=BUCKETS)
    start = np.cumsum(n) - n
    many = np.flatnonzero(_MANY * n > len(sums))
    if len(many):
        cells = np.concatenate([i * len(sums) + order[start[k]:start[k] + n[k]] for i, k in enumerate(many.tolist())])
        out[many] += np.bincount(cells, minlength=len(many) * len(sums)).reshape(len(many), -1).astype(np.float32) @ sums
    few = np.flatnonzero((n > 0) & (_MANY * n <= len(sums)))
    few = few[np.argsort((_BLOCKS - n[few]).astype(np.uint16), kind="stable")]
    total, row = np.empty((2, _ROWS, sums.shape[1]), np.float32)
    for a in range(0, len(few), _ROWS):
        to = few[a:a + _ROWS]
        first, count = start[to], n[to]
        np.take(out, to, axis=0, out=total[:len(to)], mode="clip")
        lefts = np.searchsorted(-count, -np.arange(count[0]), "left")     # buckets with more than k words
        for k, left in enumerate(lefts.tolist()):
            np.take(sums, order[first[:left] + k], axis=0, out=row[:left], mode="clip")
            total[:left] += row[:left]
        out[to] = total[:len(to)]


def _add_products(s: W.Words, weight: np.ndarray, table: np.ndarray, idf: np.ndarray, out: np.ndarray) -> None:
    """Adds to ``out`` each bucket's share of A'(A G), up to its inverse frequency, for the windows of a slice.

    ``table`` holds the rows of G times their inverse frequencies.  A word stands in the windows of its block, so their
    vectors are added up for each block, and then for each bucket."""
    words, doc, last, block = _grid(s)
    if not len(doc):
        return
    opens, first = _opening(last)
    x = _windows(_block_sums(words, table), last)
    x *= np.where(opens, weight[doc] / np.maximum(_squared_norms(words, last, idf), 1e-18), 0).astype(np.float32)[:, None]
    one = x[first]
    x[1:] += x[:-1]                                  # a document's last block opens no window, unless it is the only one
    x[first] = one
    for a in range(0, len(x), _BLOCKS):
        i, j = np.searchsorted(block, (a, a + _BLOCKS))
        _add_by_bucket(x[a:a + _BLOCKS], _bucket(s.hash[i:j]).astype(np.uint16), block[i:j] - a, out)


def _products(texts: DataFrame, basis: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """A'(A G) for the basis G over all passages of ``texts`` (weight, text); ``BUCKETS`` rows reach the driver."""
    width = basis.shape[1]
    shared = texts.sparkSession.sparkContext.broadcast((np.vstack([basis * idf[:, None].astype(np.float32), np.zeros((1, width), np.float32)]), idf))

    def step(batches: Iterator[pa.RecordBatch]):
        table, idf = shared.value
        out = np.zeros((BUCKETS, width), np.float32)
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for s in _slices(batch.column("text")):
                _add_products(s, weight[s.first_doc:s.first_doc + s.n_docs], table, idf, out)
        keys = np.flatnonzero(out.any(1))
        for i in range(0, len(keys), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 4096]), binary_rows(out[keys[i:i + 4096]])], names=["bucket", "v"])

    def merge(batches: Iterator[pa.RecordBatch]):
        out: dict[int, np.ndarray] = {}
        for batch in (b for b in batches if b.num_rows):
            for b, v in zip(batch.column("bucket").to_pylist(), matrix(batch.column("v"), np.float32, width)):
                out[b] = out[b] + v if b in out else v
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([v.tobytes() for v in out.values()], pa.binary())], names=["bucket", "v"])
    parts = texts.mapInArrow(step, "bucket long, v binary").repartition("bucket").mapInArrow(merge, "bucket long, v binary").toArrow()
    dense = np.zeros((BUCKETS, width), np.float32)
    for part in (p for p in parts.to_batches() if p.num_rows):
        dense[part.column("bucket").to_numpy()] = matrix(part.column("v"), np.float32, width)
    shared.destroy()
    return dense * idf[:, None].astype(np.float32)


def latent_directions(texts: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Right singular directions, ``RANK`` at most, of the passages of ``texts`` (weight, text): orthonormal columns.

    Every pass reads all texts.  The last one's products Y = A'A Q give the decomposition too, as A'A is about
    Y (Q'Y)^-1 Y' (Nystroem)."""
    rng = np.random.Generator(np.random.PCG64(11))
    basis = _orthonormal(rng.standard_normal((BUCKETS, RANK + OVERSAMPLE)).astype(np.float32))
    for k in range(PASSES):
        if k:
            basis = _orthonormal(_orthonormal(dense + 1e-9 * basis))
        dense = _products(texts, basis, idf)
    values, vectors = np.linalg.eigh((basis.T @ dense).astype(np.float64))
    some = values > 1e-6 * max(values[-1], 0)
    if not some.any():                               # no passages, or none with weight
        return basis[:, :RANK]
    half = dense @ (vectors[:, some] / np.sqrt(values[some])).astype(np.float32)
    return _orthonormal(_orthonormal(half)[:, ::-1][:, :RANK])


def _orthonormal(y: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns, from their small Gram matrix; in the order of its eigenvalues, the largest last."""
    values, vectors = np.linalg.eigh((y.T @ y).astype(np.float64))
    return y @ (vectors / np.sqrt(np.maximum(values, 1e-12 * values[-1]))).astype(np.float32)


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence (a bit per word of ``a``)."""
    place: dict[int, int] = {}
    for i, w in enumerate(a):
        place[w] = place.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & place.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _members(whole: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Items' words as a hashed set of (item, word), and the number that stands for each item in it."""
    salt = W.mix(np.arange(1, len(whole) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = sum(map(len, whole))
    member = np.zeros(1 << max(16, (64 * total).bit_length()), bool)
    for x, item in zip(salt, whole):
        member[_place(np.array(item, np.uint64) ^ x, len(member))] = True
    return member, salt


def _place(key: np.ndarray, size: int) -> np.ndarray:
    return (key >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _possible(h: np.ndarray, a: np.ndarray, b: np.ndarray, item: np.ndarray, sizes: np.ndarray, member: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Whether some stretch of the words ``a`` to ``b`` has ``PARAPHRASE`` of the item's words, whatever their order.

    Never False where ``_leak`` finds a share; (item, word) pairs that fall together can only make it True."""
    out, ends, i = np.zeros(len(a), bool), np.cumsum(b - a), 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _CELLS, "right")))
        n = (b - a)[i:j]
        first = np.cumsum(n) - n
        within = np.arange(n.sum()) - np.repeat(first, n)
        hit = member[_place(h[np.repeat(a[i:j], n) + within] ^ np.repeat(salt[item[i:j]], n), len(member))]
        run = np.r_[0, np.cumsum(hit)]
        m = sizes[item[i:j]]
        length = np.maximum((1.5 * m).astype(np.int64), m + 2)
        most = run[np.minimum(np.arange(len(hit)) + np.repeat(length, n), np.repeat(first + n, n))] - run[:-1]
        out[i:j] = np.maximum.reduceat(most, first) >= PARAPHRASE * m
        i = j
    return out


def _leak(item: list[int], answer: set[int], words: list[int]) -> float:
    """The largest share of the item in a stretch of ``words``, 0 if no stretch passes."""
    best, length = 0.0, max(int(1.5 * len(item)), len(item) + 2)
    last = max(len(words) - length, 0)
    for a in (*range(0, last, max(len(item) // 4, 1)), last):        # the last stretch ends with the words
        stretch = words[a:a + length]
        share = common_subsequence(item, stretch) / len(item)
        if share > best and (share >= COPY or share >= PARAPHRASE and len(answer & set(stretch)) >= ANSWER * len(answer)):
            best = share
    return best


def _word_masks(whole: list[list[int]], answers: list[set[int]], salt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the words of items of at most ``_LANES`` words: their (item, word) keys in order, the word's places in the item as bits, and
    the word's number in the answer as a bit (0: none)."""
    rows: dict[int, list[int]] = {}
    for k, item in enumerate(whole):
        if len(item) > _LANES:
            continue
        numbers = {w: i for i, w in enumerate(sorted(answers[k]))}
        for i, w in enumerate(item):
            row = rows.setdefault(int(w) ^ int(salt[k]), [0, 1 << numbers[w] if w in numbers else 0])
            row[0] |= 1 << i
    keys = np.array(sorted(rows), np.uint64)
    return keys, np.array([rows[int(x)][0] for x in keys], np.uint64), np.array([rows[int(x)][1] for x in keys], np.uint64)


def _leaks(h: np.ndarray, a: np.ndarray, b: np.ndarray, item: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, salt: np.ndarray,
           masks: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """``_leak`` for many pairs of words ``a`` to ``b`` and an item of at most ``_LANES`` words, a lane for each stretch.

    The subsequences of all lanes grow together, a word of every stretch at a time.  ``wanted`` counts the answers' words."""
    out, keys = np.zeros(len(a)), masks[0]
    ends, i = np.cumsum(b - a), 0
    while i < len(a) and len(keys):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _CELLS, "right")))
        n, m = (b - a)[i:j], sizes[item[i:j]]
        offset = np.cumsum(n) - n
        key = h[np.repeat(a[i:j], n) + np.arange(n.sum()) - np.repeat(offset, n)] ^ np.repeat(salt[item[i:j]], n)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        places, answer = (np.where(hit, x[at], np.uint64(0)) for x in masks[1:])
        length = np.maximum((1.5 * m).astype(np.int64), m + 2)
        last, step = np.maximum(n - length, 0), np.maximum(m // 4, 1)
        count = -(-last // step) + 1                                 # stretches: each step before the last one, and that
        of = np.repeat(np.arange(j - i), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        start = np.minimum(k * step[of], last[of])
        size = np.minimum(length, n)[of]
        order = np.argsort(-size, kind="stable")
        of, start, size = of[order], start[order] + offset[of[order]], size[order]
        v, seen = np.full(len(of), ~np.uint64(0)), np.zeros(len(of), np.uint64)
        going = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), "left")   # lanes with more than t words
        for t, g in enumerate(going.tolist()):
            x = start[:g] + t
            u = v[:g] & places[x]
            v[:g] = (v[:g] + u) | (v[:g] - u)
            seen[:g] |= answer[x]
        full = np.uint64(2) ** (m[of].astype(np.uint64) - np.uint64(1)) * np.uint64(2) - np.uint64(1)
        share = (m[of] - np.bitwise_count(v & full)) / m[of]
        good = (share >= COPY) | (share >= PARAPHRASE) & (np.bitwise_count(seen) >= ANSWER * wanted[item[i:j]][of])
        np.maximum.at(out, i + of, np.where(good, share, 0.0))
        i = j
    return out


def _items(texts: pa.Array) -> tuple[list[list[int]], list[set[int]]]:
    """Words and answer words (those of the last sentence) of benchmark items."""
    whole = [s.hash[a:b].tolist() for s in _slices(texts) for a, b in zip(s.first[:-1], s.first[1:])]
    lasts = [next((p for p in reversed(re.split(r"(?<=[.!?])\s+|\n", t or "")) if re.search(r"\w", p)), "") for t in texts.to_pylist()]
    answers = [set(s.hash[a:b].tolist()) for s in _slices(pa.array(lasts, pa.string())) for a, b in zip(s.first[:-1], s.first[1:])]
    return whole, answers


def _block(ids: list[int], texts: pa.Array, table: np.ndarray) -> tuple:
    """What the search needs of one block of items: latent passages over their norms, words, answers and ids."""
    whole, answers = _items(texts)
    of, vectors = [], []
    for k, item in enumerate(whole):
        starts = range(0, max(len(item) - 2 * BLOCK, 0) + BLOCK // 2, BLOCK // 2) if item else []
        for a in starts:
            part = np.array(item[max(min(a, len(item) - 2 * BLOCK), 0):][:2 * BLOCK], np.uint64)
            of.append(k)
            vectors.append(table[_bucket(part)].sum(0))
    q = np.array(vectors, np.float32).reshape(len(of), table.shape[1])
    own = (q * q).sum(1)
    plain = own <= 1e-6                              # words of no weight, as every document has them: all windows are checked
    member, salt = _members(whole)
    return (q / np.maximum(own, 1e-6)[:, None]).T.copy(), plain, np.array(of, np.int64), whole, answers, ids, member, salt, _word_masks(whole, answers, salt)


def _block_sums(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of ``table`` rows over the words of each block, a word of every block at a time, so that rows and sums stay in
    the processor's cache.  The table's last row is zero."""
    sums = np.empty((words.shape[1], table.shape[1]), np.float32)
    rows = np.empty((_ROWS, table.shape[1]), np.float32)
    for a in range(0, len(sums), _ROWS):
        part = sums[a:a + _ROWS]
        np.take(table, words[0, a:a + _ROWS], axis=0, out=part, mode="clip")
        for k in range(1, BLOCK):
            np.take(table, words[k, a:a + _ROWS], axis=0, out=rows[:len(part)], mode="clip")
            part += rows[:len(part)]
    return sums


def _windows(sums: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the windows that the blocks open, in place: with the next block's, if the document has one."""
    ends = sums[last]
    sums[:-1] += sums[1:]
    sums[last] = ends
    return sums


def _latent(s: W.Words, table: np.ndarray) -> np.ndarray:
    """Latent vectors of a slice's windows."""
    words, _, last, _ = _grid(s)
    return _windows(_block_sums(words, table), last)[_opening(last)[0]]


def _found(s: W.Words, spans: np.ndarray, doc: np.ndarray, x: np.ndarray, block: tuple, found: list[dict[int, float]]) -> None:
    """Adds to each document's ``found`` the items of a block that it holds, with their shares."""
    q, plain, of, whole, answers, ids, member, salt, masks = block
    if not len(of):
        return
    sizes = np.array([len(w) for w in whole])
    least = np.where(plain, -np.inf, NEAR).astype(np.float32)
    hits = [np.flatnonzero(x[i:i + 4 * _ROWS] @ q >= least) + i * len(of) for i in range(0, len(x), 4 * _ROWS)]
    at, near = np.divmod(np.concatenate(hits), len(of))
    pairs = np.unique(at * len(whole) + of[near])                 # of a window and an item
    at, item = pairs // len(whole), pairs % len(whole)
    a = np.maximum(spans[at, 0] - sizes[item], s.first[doc[at]])
    b = np.minimum(spans[at, 1] + sizes[item], s.first[doc[at] + 1])
    good = _possible(s.hash, a, b, item, sizes, member, salt)
    at, item, a, b = at[good], item[good], a[good], b[good]
    short = sizes[item] <= _LANES
    share = np.zeros(len(at))
    share[short] = _leaks(s.hash, a[short], b[short], item[short], sizes, np.array([len(x) for x in answers]), salt, masks)
    for i in np.flatnonzero(~short).tolist():
        share[i] = _leak(whole[item[i]], answers[item[i]], s.hash[a[i]:b[i]].tolist())
    leaks = share > 0
    for d, k, value in zip(doc[at[leaks]].tolist(), item[leaks].tolist(), share[leaks].tolist()):
        if value > found[d].get(ids[k], 0):
            found[d][ids[k]] = value


def _search(rows: DataFrame, blocks: list[tuple], table: np.ndarray) -> DataFrame:
    """``rows`` (doc_id, text, rest) with items and share: one pass over the texts for all blocks of items.

    The table goes out once, each block by itself."""
    sc = rows.sparkSession.sparkContext
    shared, parts = sc.broadcast(np.vstack([table, np.zeros((1, table.shape[1]), np.float32)])), [sc.broadcast(b) for b in blocks]

    def run(batches: Iterator[pa.RecordBatch]):
        table = shared.value
        for batch in batches:
            for s in _slices(batch.column("text")):
                spans, doc = _passages(s)
                found: list[dict[int, float]] = [{} for _ in range(s.n_docs)]
                if len(spans):
                    x = _latent(s, table)
                    for part in parts:
                        _found(s, spans, doc, x, part.value, found)
                part = batch.slice(s.first_doc, s.n_docs)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                                                  pa.array([max(f.values(), default=0.0) for f in found], pa.float64())],
                                                 names=["doc_id", "text", "rest", "items", "share"])
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("items", T.ArrayType(T.LongType())), T.StructField("share", T.DoubleType())]))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, text, rest, items, share)`` for every row: the benchmark items in the text, the largest share of one.

    ``rest`` is a struct of the other columns of ``docs``.  items is sorted and empty for a clean document; a null or
    empty text is clean.  Items without text or words are never found; of items with one id each is looked for.
    Rows that repeat a doc_id are judged each by its own text.  An empty benchmark leaves every document clean, an
    empty table gives no rows.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("row"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    idf, passages = inverse_frequencies(rows)
    texts = rows.select(F.lit(min(1.0, DOCS_WEIGHT / max(passages, 1))).alias("weight"), "text").unionByName(items.select(F.lit(ITEM_WEIGHT).alias("weight"), "text"))
    directions = latent_directions(texts.coalesce(max(TASKS, passages // TASK_PASSAGES)), idf)
    table = directions * idf[:, None].astype(np.float32)
    n_blocks = max(1, -(-items.count() // ITEMS))
    blocks = []
    for k in range(n_blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).orderBy("item_id", "text").toArrow()
        blocks.append(_block(block["item_id"].to_pylist(), block["text"].combine_chunks(), table))
    return _search(rows, blocks, table)
