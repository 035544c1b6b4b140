import hashlib
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from brute import kept_words, near_components
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, empty, odd  # noqa: F401
from relearn.llm import queries
from relearn.llm import words as W
from relearn.llm.common import cut, documents
from relearn.llm.components import components
from relearn.llm.near_dedup import near_duplicates
from relearn.llm.substring_dedup import remove_repeats


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def family(n, words, changes, seed):
    """A text and variants with some words changed."""
    rng = random.Random(seed)
    base = [f"f{seed}w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(changes + 1)):
            w[rng.randrange(words)] = f"v{k}{rng.randrange(1000)}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_match_brute_force(spark):
    texts = [t for seed in range(12) for t in family(8, 60 + 20 * seed, 1 + seed, seed)] + ["a b c", "A  b\nc", "a b", "", None, "Z"]
    random.Random(3).shuffle(texts)
    want = near_components(list(enumerate(texts)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(table(spark, texts), shingle=4).collect()}
    assert got == want and len({c for _, c in want.values()}) < len(texts) - 20


def test_large_group_of_near_copies(spark):
    """Larger than a leaf's family block: pairs on both sides of the threshold, components as by brute force."""
    texts = family(420, 120, 9, 77)
    want = near_components(list(enumerate(texts)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(table(spark, texts), shingle=4).collect()}
    assert got == want


def test_near_query_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).select("doc_id", "text").collect()]
    want = near_components(docs)
    for r in queries.op2_near_dedup(spark, SF_SMALL).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_near_edge_cases(odd, empty):
    rows = near_duplicates(odd(), shingle=4).collect()
    assert len(rows) == 11 and near_duplicates(empty).count() == 0
    by = {(r.doc_id, r.n_shingles): r for r in rows}
    assert by[(1, 297)].kept and by[(2, 297)].component_id == 1 and not by[(2, 297)].kept
    assert by[(2, 2)].component_id == 2 and by[(None, 297)].component_id == 1
    assert [by[(i, 0)].component_id for i in (3, 4, 5)] == [3, 4, 5] and by[(6, 1)].kept and by[(7, 1)].n_shingles == 1


@pytest.mark.parametrize("edges, want", [([(1, 2), (2, 3), (5, 4), (4, 4), (2, 1)], {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}), ([], {}),
                                         ([(i, i + 1) for i in range(40)], {i: 0 for i in range(41)})])
def test_components(spark, edges, want):
    assert {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == want


@pytest.mark.parametrize("portion", [7, 1 << 19])
def test_components_of_portions_of_edges(spark, monkeypatch, portion):
    """Portions of a few edges need rounds; edges that fit in one need three jobs at most."""
    from relearn.llm import components as C
    monkeypatch.setattr(C, "PORTION", portion)
    rng = random.Random(6)
    edges = [(rng.randrange(150) - 40, rng.randrange(150) - 40) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)] + [(3, 4)] * 20 + [(None, 1), (2, None)]
    want = {}
    for a, b in (e for e in edges if None not in e and e[0] != e[1]):
        one, two = want.get(a, {a}), want.get(b, {b})
        for x in one | two:
            want[x] = one | two
    rows = spark.createDataFrame(edges, "a long, b long").repartition(6)
    group = f"components-{portion}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = components(rows)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.node: r.component for r in out.collect()} == {x: min(c) for x, c in want.items()} and out.count() == len(want)
    assert portion == 7 or jobs <= 6


def test_passages_match_brute_force(spark):
    rng = random.Random(5)
    pool = [f"p{i}" for i in range(400)]
    passages = [[rng.choice(pool) for _ in range(rng.choice([49, 50, 51, 80, 140]))] for _ in range(6)]
    docs = []
    for d in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            w += [f"u{d}_{rng.randrange(50)}" for _ in range(rng.randrange(60))] + rng.choice(passages)[rng.randrange(3):]
        docs.append((d * 3, rng.choice([" ", "\n", "\t "]).join(w)))
    docs += [(500, " ".join(["same"] * 400)), (501, " ".join(["same"] * 120)), (502, " ".join(["same"] * 49))]
    want = kept_words(docs)
    out = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in out.collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 1000


def test_passages_query_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF_SMALL).select("doc_id", "text").collect()]
    want = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, (n, g, t) in kept_words(docs).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op4_substring_dedup(spark, SF_SMALL).collect()} == want


def test_passages_edge_cases(odd, empty):
    rows = remove_repeats(odd()).collect()
    assert len(rows) == 11 and remove_repeats(empty).count() == 0
    gone = {(r.doc_id, r.n_words): (r.n_removed, r.text) for r in rows}
    assert gone[(1, 300)][0] == 0 and gone[(2, 300)] == (300, "") and gone[(None, 300)][0] == 0 and gone[(2, 5)][0] == 0
    assert gone[(3, 0)] == (0, "") and gone[(4, 0)] == (0, "") and gone[(7, 60_000)][0] == 0
    kept = {(r.doc_id, r.n_words): r for r in remove_repeats(odd(), original=True).collect()}
    assert kept[(5, 0)].text == " \t\n " and kept[(4, 0)].text == "" and kept[(1, 300)].rest["a.b"] == "q" and kept[(1, 300)].rest.rest == "r"


def test_passages_are_located_by_the_automaton_alone(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(90))) for i in range(3)], "doc_id long, text string")
    assert sum(r.n_removed for r in remove_repeats(docs).collect()) == 180
    from relearn.llm import substring_dedup as S
    (s,) = W.slices(pa.array([" ".join(f"w{j}" for j in range(90))] * 2))
    passage = b" ".join(b"w%d" % j for j in range(40, 60))
    found = S.locate(s, [[passage], [b" ".join(b"v%d" % j for j in range(20))]])
    assert np.flatnonzero(found).tolist() == [40, 130]
    assert not S.locate(s, [[], []]).any()


def test_a_forged_hash_collision_removes_nothing():
    """Two texts whose phrases and windows all have equal hashes but other words: only the true copy is located."""
    from relearn.llm import substring_dedup as S
    one, other = " ".join(f"w{j}" for j in range(60)), " ".join(f"v{j}" for j in range(60))
    (s,) = W.slices(pa.array([one, other, one]))
    s.hash[60:120] = s.hash[:60]
    runs, starts, hashes, least = S._phrases(s, 50, S.PHRASE)
    assert (hashes[:11] == hashes[11:22]).all() and (least[:11] == least[11:22]).all()
    words = one.encode().split()
    mine = [b" ".join(words[i:i + S.PHRASE]) for i in range(41)]       # the table holds the words of the smallest id
    here = np.where(S.locate(s, [mine] * 3), runs, S._NONE)
    hit = S.sliding_min(here, 50 - S.PHRASE + 1)[starts] == least
    assert hit[:11].all() and not hit[11:22].any() and hit[22:].all()


def test_rows_compared_in_a_large_family_grow_with_it(spark):
    """Rows handed to the comparison: about the family's size, also if some of its classes stay apart."""
    from relearn.llm import near_dedup as N
    for n in (1000, 5000):
        ties = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
        rows = N.pivot_rows(ties)
        assert rows.count() <= n + n / N.FAMILY + 1 and rows.where("side = 1").count() == n - 1
        assert rows.groupBy("node").count().agg(F.max("count")).first()[0] < 2 * N.FAMILY
        named = spark.range(n).select(F.col("id").alias("key"), F.lit(0).cast("long").alias("family"))
        apart = N.apart_rows(named.withColumn("comp", F.least("key", F.lit(20))))
        assert apart.count() <= n + 20 * (n / N.FAMILY + 1) and apart.where("side = 0 and key < 20").select("key").distinct().count() == 20
        assert N.apart_rows(named.withColumn("comp", F.lit(0).cast("long"))).count() == 0


def test_components_left_apart_all_meet(spark):
    from relearn.llm import near_dedup as N
    n = 900
    named = spark.range(n).select(F.col("id").alias("key"), (F.col("id") % 2).alias("family"))
    rows = N.apart_rows(named.withColumn("comp", F.when(F.col("key") % 3 == 0, F.col("key")).otherwise(F.col("key") % 2 + 10_000))).collect()
    nodes = {}
    for r in rows:
        nodes.setdefault(r.node, ([], []))[r.side].append((r.key, r.comp))
    met = {(x, y) for few, every in nodes.values() for x, cx in few for y, cy in every if cx != cy}
    comp = {k: c for few, every in nodes.values() for k, c in every}
    want = {(x, y) for x in range(n) for y in range(n) if x % 2 == y % 2 and comp[x] != comp[y] and comp[x] < 10_000}
    assert want <= met


def test_shuffle_files_go_with_each_cut(spark):
    disks = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f for d in disks for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    before = shuffled()
    rows = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(6, "k")
    counts = cut(rows.groupBy("k").count())
    twice = cut(counts.join(rows.groupBy("k").agg(F.max("id").alias("top")), "k"))
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert sorted(map(tuple, twice.collect())) == [(k, len(range(k, 20_000, 7)), range(k, 20_000, 7)[-1]) for k in range(7)]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
