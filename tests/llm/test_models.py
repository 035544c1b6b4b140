import collections
import math
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from brute import base_counts, fold, lower, words
from pyspark.sql import functions as F

from llm_fixtures import SF_SMALL, empty, odd  # noqa: F401
from relearn.llm import gru, language, lm, queries, toxicity
from relearn.llm import words as W
from relearn.llm.common import documents
from relearn.llm.quality import CUTOFF, FLOORS, quality_rules

SF_MID = "/root/testdata/sf0.01"


# -- words ---------------------------------------------------------------------------

def test_word_scan_matches_the_pattern():
    texts = [None, "", " \t", "a", " a\x0bb\x0cc ", "é x y z", "A" * 5000 + " b", "one\ntwo  three", "x\x1cy"]
    column = pa.array(texts, pa.string())
    got = [[s.word(i).decode() for i in range(s.first[d], s.first[d + 1])] for s in W.slices(column, most=16) for d in range(s.n_docs)]
    assert got == [words(t) for t in texts]
    part = column.slice(3, 4)
    assert [s.n_docs for s in W.slices(part)] == [4] and sum(len(s.hash) for s in W.slices(part)) == sum(len(words(t)) for t in texts[3:7])


def test_word_hashes_are_equal_only_for_equal_words():
    texts = [f"w{i} W{i} {i % 50}x" for i in range(3000)]
    seen = {}
    for s in W.slices(pa.array(texts), lower=True, most=700):
        for i, h in enumerate(s.hash.tolist()):
            assert seen.setdefault(h, lower(s.word(i).decode())) == lower(s.word(i).decode())
    assert len(set(seen.values())) == len(seen) == 3050


def test_scan_works_in_place():
    texts = pa.array(["Some words " * 90_000, "", None, "x" * 70_000 + " some words"])
    whole = next(W.slices(texts.slice(0, 1), lower=True))
    tracemalloc.start()
    s = W.scan(whole.data, np.array([0, len(whole.data)]), lower=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 * len(s.data)                   # 8 bytes of sums for a byte of text, marks and the words; nothing as large beside the sums
    assert np.array_equal(s.hash, whole.hash) and set(s.hash[::2]) == {s.hash[0]} and set(s.hash[1::2]) == {s.hash[1]}
    last = list(W.slices(texts, lower=True))[-1]
    assert last.hash[-2:].tolist() == s.hash[:2].tolist()


def test_power_tables_are_not_sent():
    import pickle
    W._byte_powers(1 << 16)
    back = pickle.loads(pickle.dumps(W._byte_powers))
    assert len(back.up) == 1 and (back(5)[0] == W._byte_powers(5)[0]).all()


# -- op1 -----------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    out = queries.op1_language_id(spark, SF_MID).join(documents(spark, SF_MID).select("doc_id", "lang"), "doc_id")
    rows = out.collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert np.mean([r.lang == r.lang_pred for r in held if not r.rejected]) > 0.99


def test_language_edge_cases(spark, odd, empty):  # noqa: F811
    built, order = language.dictionaries(odd().select("doc_id", "text", "lang"))
    assert order[0] == "en" and all(len(d) <= language.DICTIONARY for d in built.values())
    rows = language.identify(odd(), built, order).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == 11 and all((by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True) for i in (3, 4, 5))
    assert by[1].lang_pred == "en" and language.identify(empty, built, order).count() == 0
    none = language.dictionaries(empty)
    assert none == ({}, []) and {r.lang_pred for r in language.identify(odd(), *none).collect()} == {"und"}


def test_narrow_margins_are_rejected():
    assert language.decide(np.array([100.0, 200.0, 300.0])) == (0, pytest.approx(1.0), False)
    best, score, rejected = language.decide(np.array([100.0, 100.0]))
    assert (best, score, rejected) == (0, 0.5, True) and language.decide(np.array([7.0])) == (0, 1.0, False)


# -- op7 -----------------------------------------------------------------------------

def test_quality_counts_match_brute_force(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF_SMALL).collect()}
    for r in queries.op7_quality_rules(spark, SF_SMALL).collect():
        want = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    rng = np.random.default_rng(1)
    def prose(i, n):
        return " ".join("abcdefgh"[: 2 + int(rng.integers(6))] + str(int(rng.integers(900))) + str(i) for _ in range(n))
    rows = [(i, prose(i, int(rng.integers(60, 400))), "en", "a" if i % 2 else "b") for i in range(600)]
    junk = [(1000 + i, prose(i, 100).replace(" ", "&& "), "en", "a") for i in range(20)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules(docs).collect()}
    assert all(kept[i] for i in range(600)) and not any(kept[1000 + i] for i in range(20))


def test_a_cluster_of_bad_copies_is_rejected(spark):
    """Near copies of one text that passes the base rules, more than a third of one group."""
    rng = np.random.default_rng(3)
    def prose(n):
        return " ".join("abcdefgh"[: 2 + int(rng.integers(6))] + str(int(rng.integers(100_000))) for _ in range(n))
    good = [(i, prose(int(rng.integers(60, 400))), "en", "a") for i in range(300)]
    bad = prose(90).replace(" ", " &%|# ")
    rows = good + [(1000 + i, bad + f" copy{i}", "en", "a") for i in range(160)]
    kept = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(kept[i] for i in kept if i >= 1000) and sum(kept[i] for i in range(300)) >= 297


def test_shortest_halves_match_brute_force(spark):
    from relearn.llm.quality import _shortest_halves
    rng = np.random.default_rng(5)
    rows = [(g, d, int(c), int(rng.integers(1, 9))) for g in "ab" for d in range(3) for c in rng.choice(60, 3 + 7 * d, replace=False)]
    got = {(r.group, r.dim): r.hi - r.lo for r in _shortest_halves(spark.createDataFrame(rows, "group string, dim int, cell long, n long")).collect()}
    for key in got:
        cells = sorted((c, n) for g, d, c, n in rows if (g, d) == key)
        half = sum(n for _, n in cells) / 2
        assert got[key] == min(e - b for b, _ in cells for e, _ in cells if sum(n for c, n in cells if b <= c <= e) >= half)
    assert len(got) == 6


def test_mahalanobis_distances_match_numpy(spark):
    """One group: the last reweighting step, from its own inner rows, done again with NumPy."""
    from relearn.llm import quality as Q
    docs = documents(spark, SF_MID).where("lang = 'en'").withColumn("source", F.lit("one"))
    stats = Q.statistics(Q.counts(docs)).where("not base_failed").withColumn("group", F.lit("g")).cache()
    est = Q.robust_estimates(stats).first()
    x = np.array([[r[c] for c in Q.STATS] for r in stats.orderBy("doc_id").collect()])
    mean = np.array([est[f"m_{i}"] for i in range(Q.DIM)])
    inverse = np.zeros((Q.DIM, Q.DIM))
    for i, j in Q._pairs():
        inverse[i, j] = est[f"r_{i}_{j}"]
    d2 = (((x - mean) @ inverse.T) ** 2).sum(1)
    got = stats.select("doc_id", "group", *Q.STATS).join(Q.robust_estimates(stats), "group").select("doc_id", Q._distance().alias("d")).orderBy("doc_id")
    assert np.allclose([r.d for r in got.collect()], d2, rtol=1e-6)
    cov = np.linalg.inv(inverse.T @ inverse)
    inner = x[d2 <= CUTOFF]
    assert len(inner) > 0.7 * len(x) and np.all(np.diag(cov) >= np.square(FLOORS) * 0.99) and np.abs(mean - np.median(x, 0)).max() < 1
    assert est.factor >= 1


def test_quality_starts_few_jobs(spark):
    """Each exchange costs the driver a job and threads that stay for a minute: about 150 a run took it beyond its memory."""
    spark.sparkContext.setJobGroup("quality-jobs", "quality rules")
    try:
        quality_rules(documents(spark, SF_MID)).collect()
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(name, None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("quality-jobs")) < 100


def test_moments_from_sums_match_numpy(spark):
    from relearn.llm import quality as Q
    x = np.random.default_rng(4).normal(3, 0.01, (400, Q.DIM)) + 15
    rows = spark.createDataFrame([("g", 0, *map(float, r)) for r in x], "group string, start int, " + ", ".join(f"{c} double" for c in Q.STATS))
    got = Q._moments(rows.groupBy("group", "start").agg(*Q._sums())).first()
    assert np.allclose([got[f"m_{i}"] for i in range(Q.DIM)], x.mean(0), rtol=1e-12)
    want = np.cov(x.T, bias=True) + np.diag(np.square(FLOORS))
    assert np.allclose([got[f"s_{i}_{j}"] for i, j in Q._pairs()], [want[i, j] for i, j in Q._pairs()], rtol=1e-8, atol=1e-11)


def test_rows_of_small_groups_are_judged_by_larger_ones(spark):
    """A table of 22 rows, each of a source of its own; a small language beside a large one."""
    rng = np.random.default_rng(8)
    prose = lambda n: " ".join("abcdefgh"[: 2 + int(rng.integers(6))] + str(int(rng.integers(100_000))) for _ in range(n))
    def row(i, lang, source, bad=False):
        text = prose(int(rng.integers(60, 300)))
        return i, text.replace(" ", " &%|#*$ ") if bad else text, lang, source
    few = [row(i, "en", f"s{i}", i >= 20) for i in range(22)]
    mixed = [row(i, "en", "a") for i in range(220)] + [row(300 + i, "xx", f"s{i % 7}", i >= 15) for i in range(17)] + [row(400 + i, "en", "rare", i >= 4) for i in range(5)]
    for rows, bad in ((few, {20, 21}), (mixed, {315, 316, 404})):
        got = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
        assert all(r.distance is not None for r in got) and {r.doc_id for r in got if not r.kept} >= bad
        assert sum(not r.kept for r in got) <= len(bad) + 2


def test_quality_edge_cases(odd, empty):  # noqa: F811
    rows = quality_rules(odd()).collect()
    assert len(rows) == 11 and quality_rules(empty).count() == 0
    assert {r.doc_id for r in rows if r.kept} == {1, 2, None} and all(r.distance is None for r in rows)


# -- op10 ----------------------------------------------------------------------------

def test_gradients_match_differences():
    (s,) = W.slices(pa.array(["a few words to read", "more of them " * 30, "x"]), lower=True, most=1 << 40, space=W.NOT_ALPHANUMERIC)
    model = gru.start(np.unique(s.hash), 1)
    number, _, _, _, x = gru.inputs(model, s)
    at, mask, _ = gru.windows(s.first)
    p, x, d = {k: v.astype(np.float64) for k, v in model.p.items()}, x.astype(np.float64), np.linspace(-1, 1, len(at))
    keep = {}
    gru.forward(p, x, number[at], mask, keep)
    grads, d_x = gru.backward(p, x, number[at], keep, d)
    total = lambda: (gru.forward(p, x, number[at], mask) * d).sum()
    for values, got in [(p[k], grads[k]) for k in grads] + [(x, d_x)]:
        i = np.unravel_index(np.abs(got).argmax(), got.shape)
        old = values[i]
        values[i] = old + 1e-3
        up = total()
        values[i] = old - 1e-3
        down = total()
        values[i] = old
        assert (up - down) / 2e-3 == pytest.approx(got[i], rel=0.02, abs=1e-5)


def test_every_word_is_in_a_window():
    first = np.cumsum([0, 0, 1, 31, 32, 33, 48, 49, 100])
    at, mask, doc = gru.windows(first)
    for d, (a, b) in enumerate(zip(first[:-1], first[1:])):
        assert set(at[doc == d][mask[doc == d]]) == set(range(a, b))


def test_toxicity_finds_held_out_words(spark):
    rows = queries.op10_toxicity(spark, SF_MID).join(
        spark.read.parquet(f"{SF_MID}/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and r.predicted == int(r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted for r in held if r.toxic == 1]) > 0.6 and np.mean([r.predicted for r in held if r.toxic == 0]) < 0.05


def test_toxicity_edge_cases(spark, odd, empty):  # noqa: F811
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (7, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.sample(odd(), labels), updates=2)
    rows = toxicity.score(odd(), model).collect()
    assert len(rows) == 11 and all(r.score == 0 for r in rows if r.doc_id in (3, 4, 5)) and toxicity.score(empty, model).count() == 0
    assert toxicity.fit(toxicity.sample(odd(), labels.where("toxic = 1"))) == 1.0 and toxicity.fit(toxicity.sample(empty, labels)) == 0.0
    assert {r.score for r in toxicity.score(odd(), 0.0).collect()} == {0.0}


def test_long_labelled_documents_are_sampled(spark):
    """Toxic documents that are all long: they are in the sample, from start to end, each once."""
    long = lambda i: f"first{i} " + "filler words " * 4000 + f"last{i}"
    rows = [(i, f"some short text {i}") for i in range(20)] + [(100 + i, long(i)) for i in range(5)] + [(200, "mid " * 3000), (1, "some short text 1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in {r[0] for r in rows}], "doc_id long, toxic int")
    got = toxicity.sample(docs, labels).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(set(rows))
    model = toxicity.fit(toxicity.sample(docs, labels), updates=1)
    assert {*hashed("filler words some")} <= set(model.vocabulary.tolist()) and not {*hashed("mid")} & set(model.vocabulary.tolist())


def hashed(text):
    (s,) = W.slices(pa.array([text]), lower=True, space=W.NOT_ALPHANUMERIC)
    return s.hash.tolist()


def plain_logit(model, text):
    """The highest window's logit, word by word and state by state."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    row = {h: i + 1 for i, h in enumerate(model.vocabulary.tolist())}
    ws = re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower(text))
    vectors = []
    for w in ws:
        codes = [1, *w.encode(), 2]
        grams = [int(W.mix(np.array([(a << 16) | (b << 8) | c], np.uint64))[0]) % gru.TRIGRAMS for a, b, c in zip(codes, codes[1:], codes[2:])]
        vectors.append(p["word"][row.get(hashed(w)[0], 0)] + np.mean([p["gram"][g] for g in grams], 0))
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    best, n, h = -np.inf, len(ws), gru.HIDDEN
    for k in range(max(1, -(-(n - gru.WINDOW) // gru.STRIDE) + 1) if n else 0):
        a = min(k * gru.STRIDE, max(n - gru.WINDOW, 0))
        window, states = vectors[a:a + gru.WINDOW], []
        for side, seq in (("f", window), ("b", window[::-1])):
            state, out = np.zeros(h), []
            for x in seq:
                g, r = x @ p[f"w_{side}"] + p[f"c_{side}"], state @ p[f"u_{side}"]
                z, reset = sigmoid(g[:h] + r[:h]), sigmoid(g[h:2 * h] + r[h:2 * h])
                state = z * state + (1 - z) * np.tanh(g[2 * h:] + reset * r[2 * h:])
                out.append(state)
            states.append(out if side == "f" else out[::-1])
        both = np.array([np.r_[f, b] for f, b in zip(*states)])
        e = np.exp(np.tanh(both @ p["attend"] + p["attend_c"]) @ p["attend_v"])
        best = max(best, float((e / e.sum()) @ both @ p["out"] + p["out_c"][0]))
    return best


def test_scores_are_those_of_a_plain_network(spark, odd):  # noqa: F811
    docs = documents(spark, SF_SMALL).where("length(text) < 1500").limit(25).select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(toxicity.sample(documents(spark, SF_SMALL), labels), updates=30)
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: "Émigré ÉTÉ x " * 30, -2: "", -3: "!?", -4: "one"}
    rows = toxicity.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), model).collect()
    for r in rows:
        want = plain_logit(model, texts[r.doc_id])
        assert r.score == pytest.approx(1 / (1 + np.exp(-want)) if want > -np.inf else 0.0, abs=2e-4)


def test_highest_windows_hold_their_trigrams():
    (s,) = W.slices(pa.array(["a few words to read " * 9, "", "x", "more of them " * 30]), lower=True, space=W.NOT_ALPHANUMERIC)
    model = gru.start(np.unique(s.hash)[::2], 1)
    for by_odds in (True, False):
        t = gru.highest(model, s, by_odds)
        x = model.p["word"][t.rows.ravel()] + np.add.reduceat(model.p["gram"][t.grams] * t.share[:, None], t.first[:-1])
        logits = gru.forward(model.p, x, np.arange(len(x)).reshape(-1, gru.WINDOW), t.mask)
        assert t.doc.tolist() == [0, 2, 3]
        if not by_odds:
            assert np.allclose(logits, gru.document_logits(model, s)[t.doc], atol=1e-5)
        part = t.take(np.array([2, 0]))
        assert (part.rows == t.rows[[2, 0]]).all() and part.first[-1] == len(part.grams)


def test_document_counts_of_words_and_trigrams():
    texts = ["some some words", "words", "", "here are other words and some"]
    (s,) = W.slices(pa.array(texts), lower=True, space=W.NOT_ALPHANUMERIC)
    doc, word, in_gram, gram = gru.documents_with(s)
    assert sorted(zip(doc.tolist(), word.tolist())) == sorted((i, h) for i, t in enumerate(texts) for h in (set(hashed(t)) if t else ()))
    want = set()
    for i, t in enumerate(texts):
        if t:
            (one,) = W.slices(pa.array([t]), lower=True, space=W.NOT_ALPHANUMERIC)
            want |= {(i, g) for g in gru.trigrams(one, np.arange(len(one.hash)))[0].tolist()}
    assert sorted(zip(in_gram.tolist(), gram.tolist())) == sorted(want)


# -- op5 -----------------------------------------------------------------------------

def test_base_score_matches_brute_force_and_model_is_better(spark):
    tokens = {r.doc_id: words(lower(r.text)) + [None] for r in documents(spark, SF_SMALL).collect()}
    counts = collections.Counter(t for d, ts in tokens.items() if fold(d, 5) != 1 for t in ts)
    n, v = sum(counts.values()), len(counts)
    held = collections.Counter()
    for r in queries.op5_language_model(spark, SF_SMALL).collect():
        ts = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ts), sum(t in counts for t in ts), n, fold(r.doc_id, 5) == 1)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), rel=1e-9)
        if r.held_out:
            held.update(base=r.base_score, model=r.score)
    assert held["model"] > held["base"]


def test_class_softmax_sums_to_one():
    weights = np.random.default_rng(0).normal(size=(lm.FEATURES, lm.CLASSES))
    z = lm._log_softmax(weights[lm.features(np.arange(50))].sum(1))
    assert np.allclose(np.exp(z).sum(1), 1)


def test_own_classes_do_not_depend_on_the_broadcast(spark, monkeypatch):
    """Words of one count, more than are broadcast: the commonest keep their classes, and the rest meet the whole table."""
    rng = np.random.default_rng(2)
    every = [f"w{k}" for k in range(300)] * 4
    rng.shuffle(every)
    docs = spark.createDataFrame([(i, " ".join(every[40 * i:40 * i + 40])) for i in range(30)] + [(99, "w1 w2 new")], "doc_id long, text string")
    train = docs.where("doc_id < 30")
    whole = {r.doc_id: tuple(r) for r in lm.score(docs, train).collect()}
    for top in (100, 8):
        monkeypatch.setattr(lm, "TOP", top)
        few = {r.doc_id: tuple(r) for r in lm.score(docs, train).collect()}
        assert few.keys() == whole.keys() and all(few[i][:4] == whole[i][:4] and few[i] == pytest.approx(whole[i], rel=1e-6) for i in whole)
    assert len(lm.own_words(lm.word_counts(train)).collect()) == lm.OWN


def test_language_model_edge_cases(spark, odd, empty):  # noqa: F811
    rows = lm.score(odd(), odd()).collect()
    assert len(rows) == 11 and all(r.n_known == r.n_tokens and r.train_tokens == rows[0].train_tokens for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (3, 4, 5)] == [1, 1, 1]
    pair = [r for r in rows if r.doc_id == 2]
    assert len(pair) == 3 and len({r.score for r in pair}) == 2
    untaught = lm.score(odd(), empty).collect()
    assert len(untaught) == 11 and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in untaught)
    assert lm.score(empty, odd()).count() == 0


def test_languages_are_those_of_the_smallest_sizes(spark):
    """Each text compressed once more with each dictionary, one compressor a text."""
    import zstandard
    docs = documents(spark, SF_SMALL)
    built, order = language.dictionaries(docs.select("doc_id", "text", "lang"))
    got = {r.doc_id: r for r in language.identify(docs, built, order).collect()}
    how = zstandard.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=16, search_log=3, min_match=4, target_length=16,
                                              strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_dict_id=0)

    def size(data, dictionary):
        content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return sum(len(zstandard.ZstdCompressor(compression_params=how, dict_data=content).compress(data[i:i + language.BLOCK])) for i in range(0, len(data), language.BLOCK))
    for r in docs.select("doc_id", "text").limit(60).collect():
        words = "".join(c if c.isalpha() else " " for c in r.text).split()
        if not words:
            assert got[r.doc_id].lang_pred == language.UNKNOWN
            continue
        sizes = {k: size((" " + " ".join(words).lower() + " ").encode(), built[k]) for k in order}
        least = min(sizes.values())
        assert got[r.doc_id].lang_pred == next(k for k in order if sizes[k] == least)
        assert got[r.doc_id].score == pytest.approx(1 / sum(2 ** (-(n - least) / language.HALF) for n in sizes.values()))
