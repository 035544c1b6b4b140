import numpy as np
import pytest
from brute import words
from pyspark.sql import functions as F

import corpus_pipeline
from llm_fixtures import SF_SMALL, empty, odd  # noqa: F401
from relearn.llm import licences, pieces, queries
from relearn.llm.decontaminate import _leak, common_subsequence, decontaminate

VOCABULARY = pieces.load()


# -- op6 -----------------------------------------------------------------------------

def test_trie_holds_its_keys():
    keys = {b"a": 1, b"ab": 2, b"abc": 3, b"\xff\x00": 4, b"b": 5}
    t = pieces.build_trie(keys)

    def find(key):
        node = 0
        for b in key:
            child = t.base[node] + b + 1
            if t.check[child] != node:
                return -1
            node = child
        return t.value[node]
    assert all(find(k) == v for k, v in keys.items()) and find(b"ac") == find(b"c") == find(b"abcd") == -1


def test_segmentation_scores_match_the_library(spark):
    """The same vocabulary and scores as a unigram model of the library: equal total scores, mostly equal pieces."""
    import numpy as np
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.VOCABULARY, "rb") as f:
        model.ParseFromString(f.read())
    for i, piece in enumerate(model.pieces):
        if np.isfinite(VOCABULARY.score[i]):
            piece.score, piece.type = float(VOCABULARY.score[i]), 1
    model.trainer_spec.model_type = 1
    library, encoder = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()), pieces.Encoder(VOCABULARY)
    same = total = 0
    cost = lambda ids: sum(VOCABULARY.score[i] if np.isfinite(VOCABULARY.score[i]) else 0 for i in ids)
    for row in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect():
        ours, theirs = encoder.encode(row.text), library.encode(row.text)
        total, same = total + 1, same + (ours == theirs)
        assert cost(ours) == pytest.approx(cost(theirs), rel=1e-6)
    assert same > 0.9 * total


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b", "▁x▁ ▁▁", "\n\n", "日本語😀 é", "a\0b", " lead", "trail ", "﷐", "x" * 3000, "<0x41> <s>"])
def test_round_trip(text):
    import numpy as np
    ids = pieces.Encoder(VOCABULARY).encode(text)
    assert pieces.Decoder(VOCABULARY.bytes_of).decode(np.array(ids, np.int32)) == text


def test_pieces_query_restores_every_text(spark):
    rows = queries.op6_pieces(spark, SF_SMALL).collect()
    assert rows and all(r.restored and r.n_pieces == len(r.ids) >= r.n_byte_pieces for r in rows)


def test_pieces_edge_cases(spark, odd, empty):  # noqa: F811
    rows = pieces.decode(pieces.encode(odd(), VOCABULARY, keep=("doc_id", "text", "a.b")), VOCABULARY).collect()
    assert len(rows) == 11 and all(r.decoded == (r.text or "") for r in rows) and rows[0]["a.b"] == "q"
    assert pieces.encode(empty, VOCABULARY).count() == 0
    odd_ids = spark.createDataFrame([([-5, 10**6, None],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(odd_ids, VOCABULARY).collect()] == ["", "", ""]


# -- op8 -----------------------------------------------------------------------------

MIT = """The MIT License (MIT)\n\nCopyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""


def test_licence_sentences_and_rules():
    found = licences.sentences(MIT)
    assert [n for n, _, _ in found] == ["mit-name", "permission-grant", "notice-included"]
    assert all(licences.KNOWN[licences.normalised(MIT[a:b])] == n for n, a, b in found)
    assert [k for k, _ in licences.licences([n for n, _, _ in found])] == ["MIT", "MIT"]
    assert licences.licences(["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "cc0"]) == [("BSD-3-Clause", 0), ("CC0-1.0", 4)]
    assert licences.licences(["bsd-grant", "bsd-source", "bsd-binary"]) == [("BSD-2-Clause", 0)] and licences.licences(["bsd-source"]) == []
    assert licences.sentences("A licence is not a licence. Licensed under nothing.") == []


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""


@pytest.mark.parametrize("clause", [
    "3. Neither the name of X Inc. nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.",
    "* Neither the name of the University of Y nor the names of its contributors may be used to endorse or\npromote products derived from this software without "
    "specific prior written permission.", "3. The name of the author may not be used to endorse or promote products derived from this software without prior written permission."])
def test_third_clause_with_any_name(clause):
    of = lambda text: [k for k, _ in licences.licences([n for n, _, _ in licences.sentences(text)])]
    assert of(BSD + clause) == ["BSD-3-Clause"] and of(BSD) == ["BSD-2-Clause"]


@pytest.mark.parametrize("line, licence", [
    ("This file is licensed under the MIT license", "MIT"), ("The code here is distributed under the terms of the Apache License, Version 2.0, see below.", "Apache-2.0"),
    ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1-only"), ("Our tool is released under the LGPL v3 or later.", "LGPL-3.0-or-later"),
    ("Licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0-only"), ("All text is available under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("SPDX-License-Identifier: AGPL-3.0-or-later", "AGPL-3.0-or-later"),
    ("Photos are licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 licence.", "CC-BY-NC-SA-4.0"), ("This is not licensed under the MIT license.", None),
    ("Some of it was published under the MIT Press imprint of 1990.", None), ("It is distributed under the GPL.", None)])
def test_licence_statements_with_other_words(line, licence):
    found = licences.licences([n for n, _, _ in licences.sentences(f"Some text.\n{line}\nMore text.")])
    assert [k for k, _ in found] == ([licence] if licence else [])


def test_licences_match_plain_search(spark):
    lines = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    hits = 0
    for r in queries.op8_licences(spark, "/root/testdata/sf0.01").collect():
        places = sorted((texts[r.doc_id].find(line), k) for line, k in lines.items() if line in texts[r.doc_id])
        assert [k for _, k in places] == r.licences and len(r.starts) == len(r.ends) == len(r.sentences)
        hits += len(places)
    assert hits > 10


def test_licence_edge_cases(odd, empty):  # noqa: F811
    rows = licences.scan(odd((9, MIT, "en", "s", 1, None, None, None, None))).collect()
    assert len(rows) == 12 and [r.doc_id for r in rows if r.licences] == [9] and licences.scan(empty).count() == 0


# -- op9 -----------------------------------------------------------------------------

def test_common_subsequence():
    assert common_subsequence([1, 2, 3, 2], [2, 3, 9, 2]) == 3 and common_subsequence([], [1]) == 0 and common_subsequence([1], []) == 0


def test_the_last_stretch_ends_with_the_document():
    item = list(range(1, 41))
    for before in range(100):
        assert _leak(item, set(item[-8:]), [0] * before + item) == 1
    changed = [0 if k % 2 and k < 32 else w for k, w in enumerate(item)]       # half of the question, the whole answer
    assert all(_leak(item, set(item[-8:]), [0] * before + changed) == 0.6 for before in range(100))


def test_leaks_and_paraphrases_are_found(spark):
    import random
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(rng.choice([2, 3])))
    vocabulary = [word() for _ in range(4000)]
    prose = lambda n: [rng.choice(vocabulary[:50] if rng.random() < 0.4 else vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(30)) + ". " + " ".join(prose(8)) + ".") for i in range(30)]
    docs, want = [], {}
    for d in range(300):
        w = prose(rng.randrange(20, 400))
        if d % 10 == 0:
            i = rng.randrange(30)
            leak = words(items[i][1])
            if d % 20 == 0:                         # a paraphrase: every fifth word another
                leak = [rng.choice(vocabulary) if k % 5 == 0 else x for k, x in enumerate(leak)]
            at = rng.randrange(len(w))
            w, want[d] = w[:at] + leak + w[at:], [i]
        docs.append((d, " ".join(w)))
    out = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: r["items"] for r in out.collect() if r["items"]} == want


def test_short_items_and_loose_paraphrases_match_brute_force(spark):
    """Items of 5 to 38 words in longer texts, whole or with 50 to 70% of the words, against the word check of every pair."""
    import random

    import pyarrow as pa
    from relearn.llm import decontaminate as D
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bdgklmnrst") + rng.choice("aeiou") for _ in range(rng.choice([2, 3])))
    vocabulary = [word() for _ in range(4000)]
    prose = lambda n: [rng.choice(vocabulary[:50] if rng.random() < 0.4 else vocabulary) for _ in range(n)]
    texts = [" ".join(prose(n - n // 4)) + ". " + " ".join(prose(n // 4)) + "." for n in (5, 7, 10, 16, 24, 38) for _ in range(5)]
    docs, whole = [], set()
    for d in range(400):
        i, w = rng.randrange(30), prose(rng.randrange(80, 300))
        leak, share = words(texts[i]), rng.choice([1, 1, 0.7, 0.6, 0.5])
        for k in rng.sample(range(len(leak)), int(len(leak) * (1 - share))):
            leak[k] = rng.choice(vocabulary)
        if share == 1:
            whole.add((d, i))
        at = rng.randrange(len(w))
        docs.append((d, " ".join(w[:at] + leak + w[at:])))
    items, answers = D._items(pa.array(texts))
    hashed, _ = D._items(pa.array([t for _, t in docs]))
    brute = {(d, i) for d, w in enumerate(hashed) for i in range(30) if D._leak(items[i], answers[i], w)}
    out = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    found = {(r.doc_id, i) for r in out.collect() for i in r["items"]}
    assert whole <= found and len(brute) > len(whole) + 80 and len(found & brute) >= 0.95 * len(brute)


def test_latent_directions_are_those_of_all_passages(spark):
    """The energy of the passages of all documents, many more than a thousand, and of the items against the exact decomposition."""
    import pyarrow as pa
    from relearn.llm import decontaminate as D
    rng = np.random.default_rng(8)
    odds = 1 / np.arange(1, 601)
    prose = lambda n: " ".join(f"w{k}" for k in rng.choice(600, n, p=odds / odds.sum()))
    texts, items = [prose(int(rng.integers(5, 250))) for _ in range(2500)] + [None, "", "w1"], [prose(40) for _ in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    idf, n = D.inverse_frequencies(docs)
    blocks = [max(-(-len((t or "").split()) // D.BLOCK) - 1, 1) if t else 0 for t in texts]
    assert n == sum(blocks) > 8000
    weights = [D.DOCS_WEIGHT / n] * len(texts) + [D.ITEM_WEIGHT] * len(items)
    both = spark.createDataFrame(list(zip(weights, texts + items)), "weight double, text string")
    v = D.latent_directions(both.repartition(5), idf)
    rows = []
    for weight, text in zip(weights, texts + items):
        for s in D._slices(pa.array([text], pa.string())):
            for a, b in D._passages(s)[0]:
                x = np.bincount(D._bucket(s.hash[a:b]), minlength=D.BUCKETS) * idf
                rows.append(np.sqrt(weight) * x / max(np.linalg.norm(x), 1e-9))
    a = np.array(rows)[:, idf < np.log(1 + len(texts))]
    exact = np.sort(np.linalg.eigvalsh(a.T @ a))[::-1][:D.RANK].sum()
    assert np.abs(v.T @ v - np.eye(D.RANK)).max() < 1e-3
    assert np.square(a @ v[idf < np.log(1 + len(texts))]).sum() > 0.97 * exact


def test_products_of_a_slice_are_those_of_its_passages(monkeypatch):
    """A'(A G) against the dense matrix of all passages, also in parts; the norms take no sorted copy of every window's words."""
    import pyarrow as pa
    from relearn.llm import decontaminate as D
    rng = np.random.default_rng(3)
    prose = lambda n: " ".join(f"w{k}" for k in rng.zipf(1.3, n) % 900)
    texts = ["", prose(1), None, *(prose(n) for n in (15, 16, 17, 31, 32, 33, 48, 700)), prose(16), "...", *(prose(int(n)) for n in rng.integers(1, 200, 60))]
    idf, basis = rng.random(D.BUCKETS), rng.standard_normal((D.BUCKETS, 24)).astype(np.float32)
    table = np.vstack([basis * idf[:, None].astype(np.float32), np.zeros((1, 24), np.float32)])
    weight = rng.random(len(texts))
    (s,) = D._slices(pa.array(texts, pa.string()))
    spans, doc = D._passages(s)
    a = np.array([np.bincount(D._bucket(s.hash[x:y]), minlength=D.BUCKETS) * idf for x, y in spans])
    norms = np.square(a).sum(1)
    want = (a * (weight[doc] / norms)[:, None]).T @ (a @ basis) / idf[:, None]
    monkeypatch.setattr(np, "unique", None)
    words, of, last, _ = D._grid(s)
    opens, _ = D._opening(last)
    assert np.array_equal(of[opens], doc) and np.allclose(D._squared_norms(words, last, idf)[opens], norms, rtol=1e-5)
    assert np.allclose(D._latent(s, table), a @ basis, atol=1e-3)
    for blocks, many in ((1 << 14, 16), (5, 16), (1 << 14, 0), (64, 1 << 20)):
        monkeypatch.setattr(D, "_BLOCKS", blocks), monkeypatch.setattr(D, "_MANY", many)
        out = np.ones((D.BUCKETS, 24), np.float32)
        D._add_products(s, weight, table, idf, out)
        assert np.allclose(out - 1, want, atol=1e-3)


def test_words_of_texts_that_touch_are_those_of_each_text():
    from relearn.llm import words as W
    rng = np.random.default_rng(6)
    for space in (W._SPACE, W.NOT_ALPHANUMERIC):
        for n in (0, 1, 2, 50, 400):
            data = np.frombuffer(rng.choice(list(b"abZ9 .\n\xc3\xa9"), n).astype(np.uint8).tobytes(), np.uint8)
            offsets = np.r_[0, np.sort(rng.integers(0, n + 1, 30)), n]
            s = W.scan(data, offsets, True, 0, space)
            got = [[s.word(i) for i in range(a, b)] for a, b in zip(s.first[:-1], s.first[1:])]
            table = bytes(32 if x else b for b, x in enumerate(space))
            assert got == [[w for w in data[a:b].tobytes().translate(table).split(b" ") if w] for a, b in zip(offsets[:-1], offsets[1:])]


def test_items_of_words_that_every_document_has_are_found(spark):
    docs = spark.createDataFrame([(1, "what is the question here")], "doc_id long, text string")
    out = decontaminate(docs, spark.createDataFrame([(5, "is the question"), (6, "an other thing")], "item_id long, text string"))
    assert [r["items"] for r in out.collect()] == [[5]]


def test_leak_query_matches_search_for_whole_items(spark):
    items = {r.item_id: words(r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()}
    texts = {r.doc_id: " ".join(words(r.text)) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in queries.op9_decontaminate(spark, "/root/testdata/sf0.01").collect():
        whole = {i for i, w in items.items() if " ".join(w) in texts[r.doc_id]}
        assert whole <= set(r["items"]) and r.leaked == bool(r["items"])


def test_leak_edge_cases(spark, odd, empty):  # noqa: F811
    items = spark.createDataFrame([(1, "another text under one id"), (2, None), (None, "w"), (3, ""), (4, "...")], "item_id long, text string")
    rows = decontaminate(odd(), items).collect()
    assert len(rows) == 11 and [(r.doc_id, r["items"]) for r in rows if r["items"]] == [(2, [1])]
    assert decontaminate(empty, items).count() == 0 and decontaminate(odd(), items.limit(0)).where(F.size("items") > 0).count() == 0


# -- the pipeline ----------------------------------------------------------------------

def test_pipeline_stages_on_odd_rows(spark, odd, empty, scratch):  # noqa: F811
    for k, docs in enumerate((odd(), empty)):
        docs = docs.select(*corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_SMALL).write.parquet(f"{scratch}/{k}{name}")
            docs = spark.read.parquet(f"{scratch}/{k}{name}")
            assert name == "tokens" or docs.columns == corpus_pipeline.COLUMNS
        assert docs.count() == (1 if k == 0 else 0)      # rows 1, 2 and the one without id are copies; row 1 stays


def test_pipeline_is_its_operators(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.quality(spark, docs, SF_SMALL)
    want = {r.doc_id for r in queries.op7_quality_rules(spark, SF_SMALL).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want
    clean = corpus_pipeline.leaks(spark, docs, SF_SMALL)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in queries.op9_decontaminate(spark, SF_SMALL).where("not leaked").collect()}
    passages = {r.doc_id: r.text for r in corpus_pipeline.passages(spark, docs, SF_SMALL).collect()}
    plain = {r.doc_id: r.text for r in docs.collect()}
    for r in queries.op4_substring_dedup(spark, SF_SMALL).collect():
        assert (passages[r.doc_id] == plain[r.doc_id]) if not r.n_removed else len(words(passages[r.doc_id])) == r.n_words - r.n_removed


def test_registered_queries():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}


def test_leaks_of_many_pairs_are_those_of_each(spark):
    from relearn.llm import decontaminate as D
    rng = np.random.default_rng(4)
    vocabulary = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    whole = [rng.choice(vocabulary[:n], n).tolist() for n in (1, 2, 5, 17, 40, 63, 64, 64)]
    answers = [set(w[-(len(w) // 3 + 1):]) for w in whole]
    _, salt = D._members(whole)
    masks, sizes = D._word_masks(whole, answers, salt), np.array([len(w) for w in whole])
    h = rng.choice(vocabulary, 3000)
    a, b, item = [], [], []
    for k, w in enumerate(whole):
        for _ in range(25):
            at, n = int(rng.integers(0, 2500)), int(rng.integers(1, 300))
            keep = rng.random(len(w)) < rng.random()
            if n > len(w):
                h[at:at + keep.sum()] = np.array(w, np.uint64)[keep]
            a.append(at), b.append(at + n), item.append(k)
    got = D._leaks(h, np.array(a), np.array(b), np.array(item), sizes, np.array([len(x) for x in answers]), salt, masks)
    want = [D._leak(whole[k], answers[k], h[x:y].tolist()) for x, y, k in zip(a, b, item)]
    assert np.allclose(got, want) and 20 < np.count_nonzero(want) < len(want)


LICENCE_TEXTS = {
    "BSL-1.0": """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative
works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:""",
    "ISC": """ISC License

Copyright (c) {holder}

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSD-2-Clause": """Copyright (c) {holder}

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.""",
    "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        "
                  "http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.",
    "GPL-3.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.",
    "GPL-2.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.",
    "LGPL-2.1-only": "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n Copyright (C) 1991, 1999",
    "AGPL-3.0-only": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n",
    "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions",
    "EPL-2.0": "Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\").",
    "CC-BY-4.0": "Creative Commons Attribution 4.0 International Public License\n\nBy exercising the Licensed Rights",
}


@pytest.mark.parametrize("licence", LICENCE_TEXTS)
@pytest.mark.parametrize("holder", ["2020 A. Person", "1999-2024 The Something & Co. Ltd., all rights reserved"])
def test_whole_licence_texts(licence, holder):
    """Texts and openings of licences, with other holders and other line breaks."""
    text = LICENCE_TEXTS[licence].format(holder=holder)
    heading, _, rest = text.partition("\n")
    for t in (text, heading + "\n" + " ".join(rest.split(" ")).replace(", ", ",\n"), "Preface of a file.\n\n" + text + "\n\nMore text."):
        assert [k for k, _ in licences.licences([n for n, _, _ in licences.sentences(t)])] == [licence]


@pytest.mark.parametrize("line, want", [
    ("MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("(MIT OR Apache-2.0) AND BSD-3-Clause", ["MIT", "Apache-2.0", "BSD-3-Clause"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("// SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["GPL-2.0-only"]), ("License: BSD", ["BSD"]), ("License: BSD-3-Clause", ["BSD-3-Clause"]),
    ("Licensed under either of MIT or Apache License, Version 2.0 at your option.", ["MIT", "Apache-2.0"]),
    ("This program is dual licensed under the terms of the GPL v3 or the MIT license.", ["GPL-3.0-only", "MIT"]),
    ("Photo: https://creativecommons.org/licenses/by/4.0/", ["CC-BY-4.0"]), ("http://www.apache.org/licenses/LICENSE-2.0.txt", ["Apache-2.0"]),
    ("see https://www.gnu.org/licenses/old-licenses/lgpl-2.1.html", ["LGPL-2.1-only"]), ("https://opensource.org/licenses/MIT", ["MIT"]),
    ("Black or white, he and 3 others.", []), ("MIT", []), ("It is not licensed under the MIT license or the GPL v3.", []), ("Licence fees: none", []), ("ISC and others", []),
])
def test_expressions_lists_and_links(line, want):
    assert [k for k, _ in licences.licences([n for n, _, _ in licences.sentences(f"Some text.\n{line}\nMore text.")])] == want


def test_segmentation_is_the_best_of_all():
    """Every way to cut short texts into pieces and unknown characters, tried out."""
    rng = np.random.default_rng(6)
    alphabet = ["a", "b", "c", pieces.MARK, "é", "日"]
    texts = sorted({"".join(rng.choice(alphabet[:5], rng.integers(1, 4))) for _ in range(40)})
    score = np.r_[-rng.random(len(texts)) * 9 - 0.5, np.full(256, -np.inf)]
    bytes_of = [t.replace(pieces.MARK, " ").encode() for t in texts] + [bytes([b]) for b in range(256)]
    v = pieces.Vocabulary(pieces.build_trie({t.encode(): i for i, t in enumerate(texts)}), score, bytes_of, [len(texts) + b for b in range(256)], False)
    encoder, unknown, known = pieces.Encoder(v), float(score[:len(texts)].min()) - pieces.UNKNOWN_COST, {t: i for i, t in enumerate(texts)}

    def best(text):
        if not text:
            return 0.0
        options = [score[known[text[:n]]] + best(text[n:]) for n in range(1, len(text) + 1) if text[:n] in known]
        if text[0] not in known:
            options.append(unknown + best(text[1:]))
        return max(options)
    for _ in range(300):
        text = "".join(rng.choice(alphabet, rng.integers(1, 9)))
        ids, total, i = encoder.viterbi(text), 0.0, 0
        while i < len(ids):
            if ids[i] < len(texts):
                total, i = total + score[ids[i]], i + 1
            else:                                  # the bytes of one unknown character
                first = ids[i] - len(texts)
                total, i = total + unknown, i + (1 if first < 0x80 else 2 if first < 0xE0 else 3)
        assert total == pytest.approx(best(text)) and b"".join(bytes_of[k] for k in ids).decode() == text.replace(pieces.MARK, " ")
