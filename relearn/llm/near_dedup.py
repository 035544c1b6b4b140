"""Operator 2: near-duplicates by a chosen-path set similarity join over minwise tokens.

A document's set holds its distinct shingles; two documents are linked at Jaccard similarity >= percent / 100.

1. Every set gets ``MINHASHES`` minwise tokens.  Equal sets are one *class* (key: size and two sums of mixed hashes).
2. Stars: classes that agree in four tokens meet, in ``STARS`` such nodes each; each is paired with the node's
   smallest key if enough tokens agree (no more than 4.5 standard deviations under the threshold).  This ties large
   groups of near copies together in linear work.
3. Trees: in ``TREES`` independent trees every node branches on one or two (1 / threshold on average) chosen
   positions, a child per token there.  Nodes whose members are all tied already are dropped.  Nodes of at most
   ``LEAF`` members are compared exhaustively, larger ones branch again; after ``DEPTH`` levels what is still larger
   is compared exhaustively in blocks.  A node gives a spanning set of its ties only, never all pairs.
4. What is tied together is a *family*.  Its sets are compared whole.  First each class with the smallest one that it
   is tied to: linear work, which joins most families at once.  Only families that are still apart go on: each
   class outside the family's largest component is compared with all classes of other components, in blocks of
   ``FAMILY``, so a family with few such classes is read about twice, whatever its size.  Both steps give spanning links only; components of
   the links are the result.  Whole sets are
   computed again from the texts, only for the documents that a bitmap of fixed size lets through (it marks a
   document of each wanted class and a few others by chance), so texts are never shuffled.

A pair at the threshold shares a leaf of one tree with probability 0.84 (one level) to 0.58 (four), so twelve trees
miss it with probability 3e-5 at most.  Whole sets are sets of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relearn.llm import words as W
from relearn.llm.arrowutil import as_long, binary_list, binary_rows, hashes, matrix, sorted_groups
from relearn.llm.common import cut
from relearn.llm.components import components

MINHASHES = 96
#: Bits of the bitmap that marks the documents whose sets are wanted: 2 MB, whatever the input; more set bits let more rows through.
MARK_BITS = 1 << 24
TREES, STARS, STAR_DEPTH = 12, 8, 4
LEAF, DEPTH, FAMILY = 2000, 6, 300
DEVIATIONS = 4.5

_rng = np.random.Generator(np.random.PCG64(20240501))
_MULTIPLY = _rng.integers(1, 1 << 63, MINHASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, MINHASHES, dtype=np.uint64)
_STAR_AT = np.stack([_rng.permutation(MINHASHES)[:STAR_DEPTH] for _ in range(STARS)])


def distinct_shingles(s: W.Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Document number and hash of each distinct shingle of a slice, sorted by both."""
    at, h = s.runs(shingle)
    doc = np.searchsorted(s.first, at, "right") - 1
    count = np.diff(s.first)
    for n in range(1, shingle):                     # fewer words: the whole sequence is the one shingle
        short = np.flatnonzero(count == n)
        if len(short):
            starts, hs = s.runs(n)
            doc = np.r_[doc, short]
            h = np.r_[h, hs[np.searchsorted(starts, s.first[short])]]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
    return doc[new], h[new]


def _class_of(n: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(one + n.astype(np.uint64)) ^ two)


def _signed(doc: np.ndarray, h: np.ndarray, n_docs: int):
    """Per document: set size, class key, and the first hash's index in ``h`` (documents with a set only)."""
    n = np.bincount(doc, minlength=n_docs)
    has = np.flatnonzero(n)
    at = np.r_[0, np.cumsum(n)[:-1]][has]
    key = np.zeros(n_docs, np.uint64)
    if len(has):
        key[has] = _class_of(n[has], np.add.reduceat(W.mix(h), at), np.add.reduceat(W.mix(h * np.uint64(3) + np.uint64(7)), at))
    return n, has, at, key


def set_features(docs: DataFrame, shingle: int, with_tokens: bool) -> DataFrame:
    """``(doc_id, text_key, n_shingles, key)`` and, if asked for, ``tokens``; key is null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for s in W.slices(batch.column("text"), lower=True):
                doc, h = distinct_shingles(s, shingle)
                n, has, at, key = _signed(doc, h, s.n_docs)
                empty = n == 0
                out = [batch.column(c).slice(s.first_doc, s.n_docs) for c in ("doc_id", "text_key")] + [pa.array(n.astype(np.int64)), pa.array(key.view(np.int64), mask=empty)]
                if with_tokens:
                    tokens = np.zeros((s.n_docs, MINHASHES), np.uint32)
                    for k in range(MINHASHES if len(has) else 0):
                        tokens[has, k] = np.minimum.reduceat((h * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32), at)
                    out.append(binary_rows(tokens))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "text_key", "n_shingles", "key", "tokens"][:len(out)])
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_key"))
            .mapInArrow(run, "doc_id long, text_key long, n_shingles long, key long" + ", tokens binary" * with_tokens))


def _mark(doc_id: str):
    return F.pmod(F.xxhash64(doc_id), F.lit(MARK_BITS)).cast("int")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """The marks of the ids, as bits; at most ``MARK_BITS`` / 64 words reach the driver."""
    at = _mark("doc_id")
    words = (ids.groupBy(F.shiftright(at, 6).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, pmod(xxhash64(doc_id), {MARK_BITS}) & 63)")).alias("bits")).toArrow())
    bits = np.zeros(MARK_BITS // 64, np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bits


def whole_sets(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """``(key, hashes)``: sorted distinct hashes of a document of each of the classes ``(key, doc_id)``, and of some others."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(classes))

    def run(batches: Iterator[pa.RecordBatch]):
        seen: set[int] = set()                       # a class once a task, also if rows repeat a doc_id
        for batch in batches:
            at = batch.column("mark").to_numpy()
            marked = (bits.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            texts = batch.column("text").filter(pa.array(marked.astype(bool)))
            for s in W.slices(texts, lower=True):
                doc, h = distinct_shingles(s, shingle)
                n, has, at, key = _signed(doc, h, s.n_docs)
                new = [i for i, k in enumerate(key[has].tolist()) if not (k in seen or seen.add(k))]
                if new:
                    yield pa.RecordBatch.from_arrays(
                        [as_long(key[has][new]), binary_list([h[at[i]:at[i] + n[has[i]]] for i in new])], names=["key", "hashes"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    return rows.select(_mark("doc_id").alias("mark"), "text").mapInArrow(run, "key long, hashes binary")


class _Labels:
    """Which rows of a task are joined so far, and the spanning pairs that joined them."""

    def __init__(self, label: np.ndarray):
        self.label, self.pairs = label.copy(), []

    def join(self, i: int, others: np.ndarray) -> None:
        for k, j in zip(*np.unique(self.label[others], return_index=True)):
            if k != self.label[i]:
                self.pairs.append((i, int(others[j])))
                self.label[self.label == k] = self.label[i]

    def open(self, i: int, side: np.ndarray) -> np.ndarray:
        """Rows to compare with row ``i`` of side 0: of side 1, or later ones, that aren't joined with it."""
        return np.flatnonzero((self.label != self.label[i]) & ((side == 1) | (np.arange(len(side)) > i)))


def _linked(sets: list[np.ndarray], side: np.ndarray, comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning pairs of the rows of different components whose whole sets reach the threshold."""
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    n = np.array([len(x) for x in sets])
    at = np.r_[0, np.cumsum(n)]
    joined, flags = _Labels(comp), np.zeros(codes.max() + 1, np.int32)
    for i in np.flatnonzero(side == 0):
        others = joined.open(i, side)
        others = others[100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])]
        if not len(others):
            continue
        flags[codes[at[i]:at[i + 1]]] = 1
        mine = codes if 4 * len(others) > len(sets) else np.concatenate([codes[at[j]:at[j + 1]] for j in others])
        first = at[:-1] if mine is codes else np.r_[0, np.cumsum(n[others])[:-1]]
        both = np.add.reduceat(flags[mine], first)
        both = both[others] if mine is codes else both
        flags[codes[at[i]:at[i + 1]]] = 0
        joined.join(i, others[100 * both >= percent * (n[others] + n[i] - both)])
    return joined.pairs


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning links ``(a, b)`` of the nodes of ``rows`` (node, key, comp, side, hashes): rows of side 0 against those of side 1."""
    def run(batches: Iterator[pa.RecordBatch]):
        for table, at in sorted_groups(batches, "node"):
            key, side, comp = (table[c].combine_chunks().to_numpy() for c in ("key", "side", "comp"))
            hashed = table["hashes"].combine_chunks()
            a, b = [], []
            for x, y in zip(at[:-1], at[1:]):
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in hashed[x:y]]
                for i, j in _linked(sets, side[x:y], comp[x:y], percent):
                    a.append(key[x + i])
                    b.append(key[x + j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    rows = rows.select("node", "key", "comp", F.col("side").cast("int").alias("side"), "hashes")
    return rows.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a long, b long")


def _spread(column: str, count: str):
    """A block number of a key among ``count`` rows in blocks of ``FAMILY``, and all such numbers."""
    blocks = F.ceil(F.col(count) / FAMILY)
    return F.pmod(F.xxhash64(F.col(column), F.lit("block")), blocks), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))


def pivot_rows(ties: DataFrame) -> DataFrame:
    """``(node, key, comp, side)``: each class (side 1) with the smallest class that it is tied to (side 0), in blocks."""
    both = ties.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    first = cut(both.groupBy("b").agg(F.min("a").alias("a")))
    held = first.groupBy("a").agg(F.count("*").alias("size"))
    mine, every = _spread("b", "size")
    of = F.xxhash64("a", "block").alias("node")
    members = first.join(held, "a").withColumn("block", mine).select(of, F.col("b").alias("key"), F.col("b").alias("comp"), F.lit(1).alias("side"))
    pivots = held.withColumn("block", every).select(of, F.col("a").alias("key"), F.col("a").alias("comp"), F.lit(0).alias("side"))
    return members.unionByName(pivots)


def apart_rows(rows: DataFrame) -> DataFrame:
    """``(node, key, comp, side)`` of the families of ``rows`` (family, key, comp) that hold several components: classes outside the
    largest component on side 0, all classes on side 1, so that each two of different components meet in a node."""
    sizes = rows.groupBy("family", "comp").agg(F.count("*").alias("n"))
    whole = sizes.groupBy("family").agg(F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("top")).where("top.n < size")
    whole = whole.select("family", "size", F.col("top.comp").alias("largest"), (F.col("size") - F.col("top.n")).alias("outside"))
    rows = rows.join(whole, "family")
    (own, every_own), (mine, every) = _spread("key", "outside"), _spread("key", "size")
    node = F.xxhash64("family", "i", "j").alias("node")
    few = rows.where("comp <> largest").withColumn("i", own).withColumn("j", every).select(node, "key", "comp", F.lit(0).alias("side"))
    return few.unionByName(rows.withColumn("j", mine).withColumn("i", every_own).select(node, "key", "comp", F.lit(1).alias("side")))


def linked_classes(docs: DataFrame, classes: DataFrame, ties: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``(node, component)`` of the class keys by links on whole sets within the families that ``ties`` (a, b) hold together.

    A family that the first links join is done.  Of the others ties lead from component to component: what these hold together is
    compared class by class."""
    keys = cut(ties.select(F.col("a").alias("key")).unionByName(ties.select(F.col("b").alias("key"))).distinct())
    sets = whole_sets(docs, classes.select("key", "doc_id").join(keys, "key"), shingle)
    sets = cut(sets.join(keys, "key", "left_semi").dropDuplicates(["key"]))
    links = cut(_compared(pivot_rows(ties).join(sets, "key"), percent))
    linked = components(links)
    for side in ("a", "b"):
        of = linked.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        ties = ties.join(of, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    across = cut(ties.where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct())
    if across.isEmpty():
        return linked
    families = components(across).select(F.col("node").alias("comp"), F.col("component").alias("family"))
    rows = keys.join(linked.withColumnRenamed("node", "key"), "key", "left").select("key", F.coalesce("component", "key").alias("comp"))
    apart = apart_rows(cut(rows.join(families, "comp")))
    return components(links.unionByName(_compared(apart.join(sets, "key"), percent)))


def _least_same(percent: int) -> int:
    p = percent / 100
    return int(np.floor(MINHASHES * p - DEVIATIONS * np.sqrt(MINHASHES * p * (1 - p))))


def star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """Ties of each class to the smallest key of each node (four equal tokens) it is in."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            key, tokens = hashes(batch.column("key")), matrix(batch.column("tokens"), np.uint32, MINHASHES)
            for r, at in enumerate(_STAR_AT):
                node = np.full(len(key), r + 1, np.uint64)
                for k in at:
                    node = W.mix(node * np.uint64(5) + tokens[:, k])
                yield pa.RecordBatch.from_arrays([as_long(node), batch.column("key")], names=["node", "key"])
    nodes = classes.select("key", "tokens").mapInArrow(run, "node long, key long")
    pivots = nodes.groupBy("node").agg(F.min("key").alias("a"), F.max("key").alias("top")).where("a <> top").drop("top")
    pairs = nodes.join(pivots, "node").where("a <> key").select("a", F.col("key").alias("b")).distinct()
    return _near(pairs, classes, percent)


def _near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    least = _least_same(percent)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            same = (matrix(batch.column("x"), np.uint32, MINHASHES) == matrix(batch.column("y"), np.uint32, MINHASHES)).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least))
    met = (pairs.join(classes.select(F.col("key").alias("a"), F.col("tokens").alias("x")), "a")
           .join(classes.select(F.col("key").alias("b"), F.col("tokens").alias("y")), "b"))
    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _positions(node: np.ndarray, second: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The positions that each node branches on: one for all, a second one for a part of the nodes."""
    one = W.mix(node + np.uint64(11))
    first = (one % np.uint64(MINHASHES)).astype(np.int64)
    yield np.arange(len(node)), first
    more = np.flatnonzero((W.mix(node + np.uint64(13)) >> np.uint64(11)).astype(np.float64) < second * 2.0 ** 53)
    step = (W.mix(node[more] + np.uint64(17)) % np.uint64(MINHASHES - 1)).astype(np.int64) + 1
    yield more, (first[more] + step) % MINHASHES


def _branch(rows: DataFrame, percent: int) -> DataFrame:
    """Children (node, key, comp) of the rows' nodes.  Rows without a node begin every tree."""
    second, root = 100 / percent - 1, "node" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            key, tokens = batch.column("key"), matrix(batch.column("tokens"), np.uint32, MINHASHES)
            for r in range(TREES if root else 1):
                node = np.full(len(key), W.mix(np.array([r + 1000], np.uint64))[0]) if root else hashes(batch.column("node"))
                for rows_, at in _positions(node, second):
                    child = W.mix(W.mix(node[rows_] + at.astype(np.uint64)) ^ tokens[rows_, at])
                    take = pa.array(rows_)
                    yield pa.RecordBatch.from_arrays([as_long(child), key.take(take), batch.column("comp").take(take)], names=["node", "key", "comp"])
    return rows.mapInArrow(run, "node long, key long, comp long")


def _mixed(nodes: DataFrame) -> DataFrame:
    """Rows of nodes that hold more than one component, with the node's size."""
    sizes = (nodes.groupBy("node").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .where("lo <> hi").select("node", "size"))
    return nodes.join(sizes, "node")


def _exhaustive(rows: DataFrame, percent: int) -> DataFrame:
    """Spanning ties of each node of bounded size; a node may be one block pair (``side`` 0 and 1) of a larger node."""
    least = _least_same(percent)

    def run(batches: Iterator[pa.RecordBatch]):
        for table, at in sorted_groups(batches, "node"):
            key = table["key"].combine_chunks().to_numpy()
            comp, side = table["comp"].combine_chunks().to_numpy(), table["side"].combine_chunks().to_numpy()
            tokens = matrix(table["tokens"].combine_chunks(), np.uint32, MINHASHES)
            a, b = [], []
            for x, y in zip(at[:-1], at[1:]):
                joined, part = _Labels(comp[x:y]), tokens[x:y]
                for i in np.flatnonzero(side[x:y] == 0):
                    others = joined.open(i, side[x:y])
                    if len(others):
                        joined.join(i, others[(part[others] == part[i]).sum(1) >= least])
                a += [key[x + i] for i, _ in joined.pairs]
                b += [key[x + j] for _, j in joined.pairs]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return (rows.select("node", "key", "comp", "side", "tokens").repartition("node").sortWithinPartitions("node")
            .mapInArrow(run, "a long, b long"))


def _blocks(rows: DataFrame, block: int, *columns: str) -> DataFrame:
    """Each pair of blocks of ``block`` members of a node (``size``) becomes a node; a block with itself has side 0 only."""
    blocks = F.ceil(F.col("size") / block)
    mine = F.pmod(F.xxhash64("key", "node"), blocks)
    rows = rows.withColumn("blocks", blocks).withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    return rows.select(F.xxhash64("node", lo, hi).alias("node"), "key", (F.col("mine") > F.col("other")).cast("int").alias("side"), *columns)


def tree_pairs(classes: DataFrame, linked: DataFrame, percent: int) -> DataFrame:
    """Ties across the components ``linked`` (node, component) from all leaves of all trees."""
    spark = classes.sparkSession
    rows = (classes.join(linked.withColumnRenamed("node", "key"), "key", "left")
            .select("key", F.coalesce("component", "key").alias("comp"), "tokens"))
    tokens = classes.select("key", "tokens")
    members = _mixed(_branch(rows, percent))
    found = spark.createDataFrame([], "a long, b long")
    for depth in range(1, DEPTH + 1):
        members = cut(members.select("node", "key", "comp", "size"))
        small, large = members.where(F.col("size") <= LEAF), members.where(F.col("size") > LEAF)
        found = found.unionByName(_exhaustive(small.join(tokens, "key").withColumn("side", F.lit(0)), percent))
        if large.isEmpty():
            return found.distinct()
        large = large.join(tokens, "key")
        if depth < DEPTH:
            members = _mixed(_branch(large, percent))
    return found.unionByName(_exhaustive(_blocks(large, LEAF, "comp", "tokens"), percent)).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, component, text_key)``, one row per row of ``docs``.

    Texts are lower-cased (A-Z); a set holds the distinct shingles of ``shingle`` words, or the whole sequence when
    there are fewer words.  component is a key of the row's component, null for an empty set; text_key is xxhash64 of
    the text.  component_id is the smallest doc_id reachable over links, kept is doc_id = component_id.
    Null text, empty text and text without words: empty set, linked with nothing, component_id = doc_id.  Rows that
    repeat a doc_id are judged each by its own text.  A null doc_id never names a component; a set that
    only such rows have is linked with nothing else, and its rows are kept.  Other columns are ignored; an empty table gives no rows.
    """
    classes = cut(set_features(docs, shingle, True).where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("tokens").alias("tokens")))
    ties = cut(star_pairs(classes, percent))
    ties = cut(ties.unionByName(tree_pairs(classes, components(ties), percent)))
    linked = linked_classes(docs, classes, ties, shingle, percent).withColumnRenamed("node", "key")
    named = classes.select("key", "doc_id").join(linked, "key", "left").select("key", "doc_id", F.coalesce("component", "key").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(smallest, "comp").select("key", "comp", "component_id")
    out = set_features(docs, shingle, False).join(of_class, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      F.col("comp").alias("component"), "text_key")
