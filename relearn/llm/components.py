"""Connected components of an edge table by alternating star contractions.

Each round maps every node to its smallest neighbour, first from the larger neighbours and then from the smaller
ones.  A node's minimum is a map-side combined aggregate and the edges meet it in a join (which Spark can split at a
hot node), so no group is ever gathered.  Rounds are O(log^2 n) at most; every round is cut at the checkpoint folder.

Before each round tasks contract portions of at most ``PORTION`` edges, each by itself, to the stars of its own
components: linear work without a shuffle.  Edges that fit in one portion are done with that, so small tables need
neither rounds nor shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relearn.llm.common import cut


#: Edges that a task contracts at once; 8 MB.
PORTION = 1 << 19


def _stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """The edges' components as stars ``(a, b)``: the smallest node with each other one."""
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    one, two = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[one], label[two]                # roots: every node's label is its component's smallest node so far
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[label[rest]], pa.int64()), pa.array(nodes[rest], pa.int64())], names=["a", "b"])


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges with the components of ``edges``: those of each portion of a partition as stars."""
    def run(batches: Iterator[pa.RecordBatch]):
        parts, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, PORTION):
                part = batch.slice(at, PORTION)
                if n and n + part.num_rows > PORTION:
                    yield _stars(*(np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("a", "b")))
                    parts, n = [], 0
                parts.append(part)
                n += part.num_rows
        if n:
            yield _stars(*(np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("a", "b")))
    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(a, b)``; component is the smallest node.

    Loops, repeated edges and null ends are ignored; no edges give no rows.
    """
    pairs = (edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") < F.col("b"))))
    pairs = cut(_contracted(pairs.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))))
    mark = None
    for _ in range(most_rounds):
        now = tuple(pairs.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            break
        mark = now
        portions = -(-now[0] // PORTION)
        pairs = cut(_contracted(pairs.coalesce(portions)))
        if portions == 1:
            break
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select("b", "m")
        large = large.where(F.col("b") != F.col("m")).select(F.col("b").alias("n"), F.col("m")).distinct()
        low = large.groupBy("n").agg(F.min("m").alias("l"))
        small = large.join(low, "n")
        pairs = cut(small.select(F.col("l").alias("a"), F.col("m").alias("b"))
                    .unionByName(small.select(F.col("l").alias("a"), F.col("n").alias("b")))
                    .where(F.col("a") < F.col("b")).distinct())
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = pairs.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionByName(pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
