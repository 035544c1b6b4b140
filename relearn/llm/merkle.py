"""Operator 12: a Merkle manifest of a dataset, proved by a recursive query that climbs the stored levels.

Leaves are SHA-256 hashes of rows.  Per source they stand in order of doc_id; every ``FAN`` consecutive nodes become
one parent until one node, the subroot, remains.  Subroots in order of source become the root in the same way.

Every built level is stored as parent-linked node rows: a node's key, its digest, its children's digests side by side
and its parent's key.  A recursive query then ascends from every run of ``FAN`` leaves: at each level it finds the
parent's row, appends the siblings to the proof and folds the run's hashes, one for each leaf as it would be if that
leaf alone were tampered with, into the parent's hash.  The leaves of a run climb side by side in one row, since above
its first level they share all siblings; nothing else about a leaf is carried.

No level is ranked or gathered in one task: positions come from ranges of (source, doc_id), a parent gathers ``FAN``
children, and the rows of nodes above many runs are stored as several copies, one for each ``SPREAD`` runs below, so
that runs of a hot source, and all runs at the root, meet their parents in many tasks.  The number of levels grows with
the logarithm of the rows; each is written to the shared checkpoint folder.

Nulls are hashed as ``-``; a null source comes first.  Rows without a doc_id come first in their source.  Equal doc_ids
stand in the order of their leaves, so repeated rows have leaves of their own with the same hash.  Texts of any length
are hashed whole.  Extra columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relearn.llm.common import cut
from relearn.operators.ordered import global_rank

FAN = 16
#: Runs below a node for which one copy of its row is stored.
SPREAD = 256
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Key of the tree over the subroots; those of sources begin with n (null) or s.
TOP = "t"
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated parts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def leaf(*values: Column) -> Column:
    """The hash of a row: each value as ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    texts = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def tampered(doc_id: Column) -> Column:
    """Whether the row's text is tampered with: 5 divides crc32 of its id; never without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``(tree, pos, doc_id, leaf, bad)``: the place and hash of every row, and its hash after tampering (null: no change)."""
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    rest = [doc_id, F.col("source"), F.col("lang"), F.col("n_chars")]
    lowered = F.translate(text, CAPITALS, SMALL)
    rows = docs.select(F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("tree"), doc_id.alias("doc_id"),
                       leaf(*rest, text).alias("leaf"), F.when(tampered(doc_id) & (lowered != text), leaf(*rest, lowered)).alias("bad"))
    held = cut(rows).withColumn("tie", F.monotonically_increasing_id())      # rows that are equal take any order
    return global_rank(held, ["doc_id", "leaf", "tie"], out="pos", group_cols=["tree"]).select("tree", "pos", "doc_id", "leaf", "bad")


def runs(placed: DataFrame) -> DataFrame:
    """``(tree, run, n, items)``: the leaves of each run in order; n counts the leaves of the tree."""
    placed = cut(placed)
    item = F.struct("pos", "doc_id", "leaf", "bad")
    out = placed.groupBy("tree", F.expr(f"pos div {FAN}").alias("run")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    sizes = placed.groupBy("tree").agg(F.count("*").alias("n"))
    # a hot tree's runs meet its size in many tasks: one copy of it for each SPREAD runs
    copies = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {FAN * SPREAD}"))
    sizes = sizes.select("tree", "n", F.explode(copies).alias("copy"))
    return cut(out.withColumn("copy", F.expr(f"run div {SPREAD}")).join(sizes, ["tree", "copy"]).select("tree", "run", "n", "items"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level above ``nodes`` (tree, pos, n, below, digest), of trees that have more than one node."""
    item = F.struct("pos", "digest")
    groups = nodes.where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("at")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.max("n").alias("was"), F.sum("below").alias("below"))
    children = F.concat(F.lit(b""), *[F.coalesce(F.get("items", F.lit(i))["digest"], F.lit(b"")) for i in range(FAN)])
    rows = groups.select("tree", F.col("at").alias("pos"), F.expr(f"(was + {FAN - 1}) div {FAN}").alias("n"), "below", children.alias("children"))
    return rows.withColumn("digest", digest(hexed(F.col("children"))))


COLUMNS = ["tree", "level", "pos", "n", "below", "digest", "children"]


def _levels(base: DataFrame, level: int) -> list[DataFrame]:
    """``base`` (of that level) and the levels above it, up to the one with a single node in every tree."""
    built = [cut(base.withColumn("level", F.lit(level)).select(*COLUMNS))]
    while not built[-1].where("n > 1").isEmpty():
        level += 1
        built.append(cut(_parents(built[-1]).withColumn("level", F.lit(level)).select(*COLUMNS)))
    return built


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def node_rows(runs: DataFrame) -> DataFrame:
    """All nodes above the leaves, and lone leaves, as parent-linked rows.

    ``(tree, level, pos, digest, children, is_subroot, up_tree, up_level, up_pos, slot, copies, up_copies)``; the parent's
    key is null at the root."""
    children = F.concat(F.lit(b""), *[F.coalesce(F.get("items", F.lit(i))["leaf"], F.lit(b"")) for i in range(FAN)])
    first = runs.select("tree", F.col("run").alias("pos"), F.col("n").alias("leaves"), children.alias("children"), F.lit(1).cast("long").alias("below"))
    first = first.withColumn("digest", F.when(F.col("leaves") == 1, F.col("children")).otherwise(digest(hexed(F.col("children")))))
    first = first.withColumn("n", F.expr(f"(leaves + {FAN - 1}) div {FAN}"))
    trees = _union(_levels(first, 1))
    subroots = global_rank(trees.where("n = 1").select("tree", "digest", "below"), ["tree"], out="pos")
    subroots = cut(subroots)
    total = subroots.count()
    top = _levels(subroots.select(F.lit(TOP).alias("tree"), "pos", F.lit(total).cast("long").alias("n"), "below", "digest", F.lit(b"").alias("children")), 0)
    own = F.expr(f"pos div {FAN}")
    linked = trees.where("n > 1").select(*COLUMNS, F.lit(False).alias("is_subroot"), F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"),
                                         own.alias("up_pos"), (F.col("pos") % FAN).cast("int").alias("slot"))
    place = subroots.select("tree", F.col("pos").alias("place"))
    more = total > 1
    joined = trees.where("n = 1").join(place, "tree").select(
        *COLUMNS, F.lit(True).alias("is_subroot"), F.lit(TOP if more else None).cast("string").alias("up_tree"), F.lit(1 if more else None).cast("int").alias("up_level"),
        F.expr(f"place div {FAN}").alias("up_pos"), F.expr(f"cast(place % {FAN} as int)").alias("slot"))
    if len(top) > 1:
        above = _union(top[1:])
        goes_on = F.col("n") > 1
        joined = joined.unionByName(above.select(
            *COLUMNS, F.lit(False).alias("is_subroot"), F.when(goes_on, F.col("tree")).alias("up_tree"), F.when(goes_on, F.col("level") + 1).alias("up_level"),
            own.alias("up_pos"), (F.col("pos") % FAN).cast("int").alias("slot")))
    nodes = cut(linked.unionByName(joined).withColumn("copies", F.expr(f"(below + {SPREAD - 1}) div {SPREAD}")))
    up = nodes.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("pos").alias("up_pos"), F.col("copies").alias("up_copies"))
    return cut(nodes.join(up, ["up_tree", "up_level", "up_pos"], "left").select(
        "tree", "level", "pos", "digest", "children", "is_subroot", "up_tree", "up_level", "up_pos", "slot", "copies", "up_copies"))


def _without(children: str, slot: str) -> tuple[str, str]:
    return f"substring({children}, 1, 32 * {slot})", f"substring({children}, 32 * {slot} + 33, {32 * FAN})"


def climb(spark: SparkSession, runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(tree, run, folds, proof, subroot, root)``: what the ascent of every run ends with, by a recursive query.

    ``folds`` are the root hashes that follow from each of the run's leaves after tampering; ``proof`` is the siblings'
    digests above the run's leaves."""
    leaves = "concat(x'', " + ", ".join(f"coalesce(get(items, {i}).leaf, x'')" for i in range(FAN)) + ")"
    left, right = _without("ls", "i")
    folded = f"""CASE WHEN n = 1 THEN transform(items, x -> coalesce(x.bad, x.leaf))
                 ELSE transform(items, (x, i) -> unhex(sha2(CAST(lower(hex(concat({left}, coalesce(x.bad, x.leaf), {right}))) AS BINARY), 256))) END"""
    start = runs.withColumn("ls", F.expr(leaves)).select("tree", "run", F.expr(folded).alias("folds"))
    start = start.withColumn("h", F.xxhash64("tree", "run"))
    copied = nodes.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    own = nodes.where("level = 1").select("tree", F.col("pos").alias("run"), "digest", "is_subroot", "up_tree", "up_level", "up_pos", "up_copies", "slot")
    start = start.join(own, ["tree", "run"]).select(
        "tree", "run", "h", "folds", F.lit(b"").alias("proof"), F.when(F.col("is_subroot"), F.col("digest")).alias("subroot"), F.col("digest").alias("root"),
        "up_tree", "up_level", "up_pos", F.pmod("h", F.coalesce("up_copies", F.lit(1).cast("long"))).alias("up_copy"), "slot")
    names = {"start": f"merkle_start_{id(start)}", "nodes": f"merkle_nodes_{id(nodes)}"}
    cut(start).createOrReplaceTempView(names["start"])
    cut(copied).createOrReplaceTempView(names["nodes"])
    left, right = _without("n.children", "c.slot")
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")       # the rows are one per run and level
    try:
        return cut(spark.sql(f"""
            WITH RECURSIVE climb(tree, run, h, folds, proof, subroot, root, up_tree, up_level, up_pos, up_copy, slot) AS (
                SELECT tree, run, h, folds, proof, subroot, root, up_tree, up_level, up_pos, up_copy, slot FROM {names['start']}
                UNION ALL
                SELECT c.tree, c.run, c.h,
                       transform(c.folds, x -> unhex(sha2(CAST(lower(hex(concat({left}, x, {right}))) AS BINARY), 256))),
                       concat(c.proof, {left}, {right}),
                       CASE WHEN n.is_subroot THEN n.digest ELSE c.subroot END, n.digest,
                       n.up_tree, n.up_level, n.up_pos, pmod(c.h, coalesce(n.up_copies, 1)), n.slot
                FROM climb c JOIN {names['nodes']} n
                  ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND c.up_copy = n.copy)
            SELECT tree, run, folds, proof, subroot, root FROM climb WHERE up_tree IS NULL"""))
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        for name in names.values():
            spark.catalog.dropTempView(name)


def manifest(docs: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row of ``docs``; hashes as hex."""
    held = runs(leaves(docs))
    ends = climb(docs.sparkSession, held, node_rows(held))
    siblings = [F.when(F.lit(i) != F.col("k"), F.coalesce(F.get("items", F.lit(i))["leaf"], F.lit(b""))).otherwise(F.lit(b"")) for i in range(FAN)]
    rows = held.join(ends, ["tree", "run"]).select("items", "folds", "proof", "subroot", "root", F.posexplode("items").alias("k", "item"))
    return rows.select("item.doc_id", hexed(F.col("item.leaf")).alias("leaf"), hexed(F.col("subroot")).alias("subroot"), hexed(F.col("root")).alias("root"),
                       F.sha2(hexed(F.concat(*siblings, F.col("proof"))).cast("binary"), 256).alias("proof_sha256"),
                       hexed(F.get("folds", F.col("k"))).alias("folded_root"), (F.get("folds", F.col("k")) == F.col("root")).alias("verified"))
