"""Operators on documents against brute force, on edge cases and on the smallest given tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from isoreach.llm import dartminhash, licences, mixing, ngram_trie, pieces, quality, suffix_index, toxicity
from isoreach.llm.queries import PIECE_MODEL

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"
LONG = " ".join(f"word{i} über tokens" for i in range(3000))
PASSAGE = " ".join(f"shared passage number {i}" for i in range(40))
BASE = " ".join(f"b{i}" for i in range(60))
TEXTS = [
    (1, "alpha beta gamma. " + PASSAGE + " tail one"), (2, PASSAGE + " other tail ä"), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"),
    (8, BASE), (9, BASE + " extra"), (10, BASE.replace("b30", "zz")), (11, LONG), (12, LONG), (None, "no id " + PASSAGE), (13, "a" * 450),
    (14, "x▁y  z▁ \U0001f600 Licensed under the Apache License, Version 2.0.\nno"), (6, "one"), (15, BASE.replace("b30", "zz") + " more words here"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "en", "s", None, None, "k") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def weighted_jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def bag(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def expected_components(texts):
    ids = sorted({i for i, _ in texts if i is not None})
    bags = [(i, bag(t)) for i, t in texts if i is not None]
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(bags):
        for j, b in bags[:n]:
            if a and b and weighted_jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_documents(edge, empty):
    got = {r.doc_id: r for r in dartminhash.near_documents(edge).collect()}
    assert {i: r.component_id for i, r in got.items() if i is not None} == expected_components(TEXTS)
    assert got[None].component_id is None and got[None].kept
    assert all(r.kept == (r.doc_id == r.component_id) for i, r in got.items() if i is not None)
    assert dartminhash.near_documents(empty).count() == 0


def test_second_pass_finds_links_that_no_leader_has(spark):
    # A chain: neighbours are alike, the ends are not.
    rows = [(k, " ".join([f"c{i}" for i in range(4 * k, 4 * k + 100)])) for k in range(8)]
    got = {r.doc_id: r.component_id for r in dartminhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected_components(rows)


def test_dart_agreement_is_weighted_jaccard():
    import numpy as np

    a, b = Counter({k: 1 + k % 5 for k in range(80)}), Counter({k: 1 + k % 3 for k in range(20, 110)})
    owner = np.repeat([0, 1], [len(a), len(b)])
    element = dartminhash.mix64(np.array([*a, *b], np.uint64))
    sig = dartminhash.signatures(owner, element, np.array([*a.values(), *b.values()]), 2, t=4000)
    assert abs((sig[0] == sig[1]).mean() - weighted_jaccard(a, b)) < 0.03
    assert (sig > 0).all()


def repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in data for p in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(edge, empty, monkeypatch):
    monkeypatch.setattr(suffix_index, "ANCHOR_RUNS", 1)  # every shared anchor is dealt to several tasks
    got = suffix_index.remove_repeats(edge, with_text=True, carry=["key"]).collect()
    want = Counter((i, *r) for (i, _), r in zip(TEXTS, repeats([t for _, t in TEXTS]), strict=True))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert all(r._c0 == "k" and len(r.kept_text.encode()) <= r.n_bytes - r.n_removed for r in got)
    assert suffix_index.remove_repeats(empty).count() == 0


def test_repeats_of_given_documents(given):
    rows = given[0].select("doc_id", "text").collect()
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_index.remove_repeats(given[0]).collect()}
    assert got == {(r.doc_id, *e) for r, e in zip(rows, repeats([r.text for r in rows]), strict=True)}


def test_language_model(edge, empty, given):
    for docs in (edge, given[0]):
        rows = [(r.doc_id, words(r.text) + ["</s>"]) for r in docs.select("doc_id", "text").collect()]
        held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        learn = [w for i, w in rows if i is not None and not held(i)]
        c = Counter(x for w in learn for x in w)
        pairs = Counter(p for w in learn for p in zip(["<s>", *w[:-1]], w, strict=True))
        n, v = sum(c.values()), len(c)
        q = lambda k: math.exp(math.floor(math.log(max(k - 0.75, 1)) * 9) / 9)
        mass, context = Counter(), Counter(c) + Counter({"<s>": len(learn)})
        for (u, _), k in pairs.items():
            mass[u] += q(k) if k > 1 else 0
        single = lambda x: (c[x] + 1) / (n + v + 1)

        def p(u, x):
            k = context[u]
            return ((q(pairs[u, x]) if pairs[u, x] > 1 else 0) / k + (1 - mass[u] / k) * single(x)) if k else single(x)

        want = sorted((-1 if i is None else i, held(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10(single(x)) for x in w), sum(math.log10(p(u, x)) for u, x in zip(["<s>", *w[:-1]], w, strict=True))) for i, w in rows)
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_trie.score_texts(docs).collect())
        assert len(got) == len(want)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], abs=1e-6)
        for u in ["<s>", next(iter(c))]:  # known words and the unknown one
            assert sum(p(u, x) for x in [*c, "never seen"]) == pytest.approx(1.0)
    assert ngram_trie.score_texts(empty).count() == 0


def test_query_scores_with_trigrams_and_singletons(spark, edge, given):
    from isoreach.llm.queries import QUERIES

    for docs, got in ((given[0], QUERIES["op9_lm_scores"](spark, DATA)), (edge, ngram_trie.score_texts(edge, order=3, least=1))):
        rows = [(r.doc_id, words(r.text) + ["</s>"]) for r in docs.select("doc_id", "text").collect()]
        learn = [w for i, w in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
        c = Counter(x for w in learn for x in w)
        n, v = sum(c.values()), len(c)
        grams, context, mass = Counter(), Counter(), Counter()
        q = lambda k: (math.exp(math.floor(math.log(k - 0.75) * 9) / 9) if k > 1 else 0.25 * k)
        for w in learn:
            for g in [*zip(["<s>", *w[:-1]], w, strict=True), *zip(["<s>", *w], w, w[1:])]:
                grams[g] += 1
        for g, k in grams.items():
            context[g[:-1]] += k
            mass[g[:-1]] += q(k)

        def p(*g):
            if len(g) == 1:
                return (c[g[0]] + 1) / (n + v + 1)
            k = context[g[:-1]]
            return q(grams[g]) / k + (1 - mass[g[:-1]] / k) * p(*g[1:]) if k else p(*g[1:])

        def score(w):
            return math.log10(p("<s>", w[0])) + sum(math.log10(p(*g)) for g in zip(["<s>", *w], w, w[1:]))

        want = sorted((-1 if i is None else i, score(w)) for i, w in rows)
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in got.collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-6)
        for g in [("<s>",), next(iter(context)), next(g for g in context if len(g) == 2)]:
            assert sum(p(*g, x) for x in [*c, "never seen"]) == pytest.approx(1.0)


def test_many_shards_give_the_scores_of_one(spark, edge, monkeypatch):
    rows = lambda **kw: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in ngram_trie.score_texts(edge, **kw).collect())
    want = [rows(), rows(order=3, least=1), rows(order=3)]
    monkeypatch.setattr(ngram_trie, "SHARD_BYTES", 500)  # most shards get bigrams that nothing follows, or none
    assert [rows(), rows(order=3, least=1), rows(order=3)] == want


def test_ngrams_travel_once_and_short():
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(f"w{int(x)}" for x in rng.zipf(1.2, 500) % 100_000) for _ in range(1000)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), texts, pa.array([True] * 1000)], ["doc_id", "text", "_train"])
    block = ngram_trie.Block(ngram_trie.Texts(batch.column(0), texts), np.ones(1000, bool), 64, 3, np.array([ngram_trie.START]))
    sent = sum(len(x) for b in ngram_trie._gram_rows(64, 3, np.array([ngram_trie.START]))(0, ngram_trie.Texts(batch.column(0), texts), batch) for c in b.columns for x in c.to_pylist() if isinstance(x, bytes))
    assert sent < 6 * (len(block.u) + len(block.context))  # 8.4 bytes for each distinct n-gram when bigrams and trigrams were dealt apart


def test_texts_reach_python_in_bounded_batches(spark):
    import corpus_pipeline
    from isoreach.llm.common import BATCH_TEXTS, map_texts
    from isoreach.operators.joins import ARROW_ROWS, Workspace

    before = spark.conf.get(ARROW_ROWS)
    docs = spark.createDataFrame([(i, f"text {i}", i * 2, "en") for i in range(2500)], "doc_id long, text string, n_chars long, lang string").coalesce(1)
    rows = map_texts(docs, [F.col("doc_id"), F.col("text")], lambda batch, texts: [{"n": np.array([batch.num_rows])}], "n long")
    assert [r.n for r in Workspace(spark).save(rows, "rows", BATCH_TEXTS).collect()] == [1000, 1000, 500]
    assert spark.conf.get(ARROW_ROWS) == before
    try:
        out = corpus_pipeline.repeated_passage_stage(spark, docs, DATA)
        assert out.columns == docs.columns and sorted(out.collect()) == [(i, f"text {i}", len(f"text {i}"), "en") for i in range(2500)]
        assert int(spark.conf.get(ARROW_ROWS)) <= BATCH_TEXTS
    finally:
        spark.conf.set(ARROW_ROWS, before)


def test_elias_fano_finds_members_only():
    import numpy as np

    rng = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), np.array([5], np.uint64), np.unique(rng.integers(0, 1 << 62, 1000)).astype(np.uint64), np.arange(300, dtype=np.uint64)):
        code = ngram_trie.EliasFano(packed=ngram_trie.EliasFano(values).packed)
        assert (code.find(values) == np.arange(len(values))).all()
        others = np.setdiff1d(rng.integers(0, 1 << 62, 500).astype(np.uint64), values)
        assert (code.find(others) == -1).all()


def test_pieces_restore_every_text(edge, empty, given):
    for docs in (edge, given[0]):
        coded = pieces.encode(docs, PIECE_MODEL)
        assert coded.filter("NOT restored").count() == 0
        assert coded.filter("n_tokens <> size(ids)").count() == 0
        back = Counter((r.doc_id, r.text) for r in pieces.decode(coded, PIECE_MODEL).collect())
        assert back == Counter((r.doc_id, r.text or "") for r in docs.collect())
    assert pieces.encode(empty, PIECE_MODEL).count() == 0


def test_best_path_has_the_largest_score():
    with open(PIECE_MODEL, "rb") as f:
        p = pieces.Pieces(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)

    def brute(text):
        best = [0.0] + [-math.inf] * len(text)
        for e in range(1, len(text) + 1):
            for s in range(max(0, e - 20), e):
                piece = text[s:e]
                score = p.scores[piece][1] if piece in p.scores else p.fallback if e - s == 1 else -math.inf
                best[e] = max(best[e], best[s] + score)
        return best[-1]

    for text in ("▁thing", "▁Licensed▁under", "▁éè日本\U0001f600x", "▁▁▁a"):
        got = sum(sp.get_score(i) if not sp.is_byte(i) else 0 for i in p.best_path(text))
        lost = sum(p.fallback for c in text if c not in p.single)
        assert got + lost == pytest.approx(brute(text))


def auc(pairs):
    ones, zeros = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.mark.parametrize("make, column", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_classifiers(spark, edge, empty, make, column):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = make(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())
    held = scored.filter("held_out").join(labels, "doc_id").select(column, "score").collect()
    assert auc(held) > 0.9
    # Held-out labels must not matter.
    flipped = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col(column)).otherwise(F.col(column)))
    same = make(docs, flipped).select("doc_id", F.col("score").alias("again")).join(scored, "doc_id")
    assert same.filter("abs(again - score) > 1e-6").count() == 0
    odd = spark.createDataFrame([(8, 1, 1), (8, 0, 0), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert make(edge, odd).count() == len(TEXTS)
    assert make(empty, odd.limit(0)).count() == 0


def test_prior_is_the_share_of_positives():
    import numpy as np

    positive = np.r_[np.zeros(50), np.full(50, 100)]
    assert quality.estimate_prior(positive, 0.7 * positive * 50 + np.r_[np.full(50, 1500), np.zeros(50)]) == pytest.approx(0.7, abs=0.05)


def test_licences(edge, empty, given):
    got = {r.doc_id: r for r in licences.scan_licences(edge).collect() if r.doc_id is not None}
    assert got[14].family == "Apache-2.0" and got[14].n_found == 1 and got[14].similarity == 1.0
    assert all(r.n_found == 0 and r.family is None for i, r in got.items() if i != 14)
    named = {"Apache License, Version 2.0": "Apache-2.0", "MIT License": "MIT", "GNU General Public License, version 3": "GPL-3.0", "CC BY-NC 4.0": "CC-BY-NC-4.0"}
    found = {r.doc_id: r.families for r in licences.scan_licences(given[0]).collect()}
    for r in given[0].collect():
        assert {f for s, f in named.items() if s in (r.text or "")} <= set(found[r.doc_id])
    assert licences.scan_licences(empty).count() == 0


def test_background_is_drawn_from_whole_texts(spark):
    body = [f"Sentence number {i} " + "goes on " * 60 + "to its end." for i in range(5)]
    rows = [(i, "One title for all\n" + " ".join(body)) for i in range(40)] + [(50, "\nBehind a break"), (51, None), (52, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = licences._background(docs, 100)
    assert sorted(x.strip() for x in got) == sorted([*body, "One title for all", "Behind a break"])
    assert len(licences._background(docs, 3)) == 3 and set(licences._background(docs, 3)) <= set(got)


@pytest.mark.parametrize("before", ["", "# ", " * ", "// "])
def test_wrapped_licence_headers(spark, before):
    headers = {
        "Apache-2.0": "Licensed under the Apache License, Version\n2.0 (the License);\nyou may not use this file except in\ncompliance with the License.",
        "MIT": "Permission is hereby granted, free of charge, to any\nperson obtaining a copy of this software and documentation",
        "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the conditions are met:",
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
        "LGPL": "it under the terms of the GNU Lesser General Public License as\npublished by the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
        "AGPL": "it under the terms of the GNU Affero General Public License as published\nby the Free Software Foundation, either version 3 of the\nLicense, or (at your option) any later version.",
        "MPL-2.0": "This Source Code Form is subject to the terms of the\nMozilla Public License, v. 2.0. If a copy of the MPL was not\ndistributed with this file, You can obtain one.",
        "CC-BY-NC-4.0": "This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.",
        "CC-BY-SA-4.0": "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.",
        "CC-BY-4.0": "This work is licensed under a Creative Commons\nAttribution 4.0 International License.",
        "CC0": "To the extent possible under law, the author has\nwaived all copyright and related rights",
        "Proprietary": "No part of this publication may be reproduced without\nthe prior written permission of the publisher.",
    }
    assert set(headers) == set(licences.FAMILIES)
    wrap = lambda h: "\n".join(before + x for x in h.split("\n"))
    rows = [(i, "Some words stand here\n\n" + wrap(headers[f]) + "\n\nand more follow after it") for i, f in enumerate(licences.FAMILIES)]
    rows += [(99, "Redistribution and use in source and binary forms\n\nwith or without modification, are permitted")]
    got = {r.doc_id: r.families for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: [f] for i, f in enumerate(licences.FAMILIES)}, 99: []}


def test_mixing(spark, edge, empty, given):
    docs = given[0]
    labelled = docs.select("doc_id", F.col("lang").alias("domain"))
    targets = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
    mixed = mixing.mix(docs, labelled, targets).cache()
    total = mixed.agg(F.sum("n_tokens")).first()[0]
    for k, d in enumerate(sorted(targets)):
        share = mixed.agg(F.sum(F.col("rate") * F.col("n_tokens") * F.col("p")[k])).first()[0] / total
        assert share == pytest.approx(targets[d], abs=1e-4)
    assert mixed.filter("rate < 0").count() == 0
    right = mixed.join(docs.select("doc_id", "lang"), "doc_id").filter("domain = lang").count()
    assert right > 0.95 * docs.count()
    grown = mixing.mix(docs, labelled, targets, floor=1.0, keep_all=True, keep=True)
    assert grown.filter("rate < 1").count() == 0 and grown.select("_row.*").columns == docs.columns
    assert mixing.mix(edge, labelled.limit(0), targets).count() == len(TEXTS)
    assert mixing.mix(empty, labelled, targets).count() == 0


def test_pipeline(spark, edge, empty):
    import corpus_pipeline

    for docs in (edge, empty):
        names = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, DATA)
            assert docs.columns == names or i == len(corpus_pipeline.STAGES) - 1
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0


def test_near_duplicate_stage_goes_by_rows(spark):
    import corpus_pipeline

    other = " ".join(f"o{i}" for i in range(60))
    rows = [(1, BASE, "a"), (1, other, "b"), (2, other + " end", "c"), (3, BASE, "d"), (4, "alone", "e"), (4, "not alike", "f")]
    rows += [(None, PASSAGE, "g"), (None, PASSAGE, "g"), (None, BASE, "h"), (None, "", "i"), (5, LONG, "j"), (5, LONG, "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, DATA).collect()
    assert sorted((r.key, r.doc_id) for r in got) == [("a", 1), ("b", 1), ("e", 4), ("f", 4), ("g", None), ("i", None), ("j", 5)]


def test_near_duplicate_stage_keeps_columns_of_any_name_and_type(spark):
    """A column named as the row's key, a dotted name and a map come through; rows equal in all columns become one."""
    import corpus_pipeline

    text = " ".join(f"w{i}" for i in range(80))
    rows = [(3, text, "k", 1, {"a": 1}), (3, text, "k", 1, {"a": 1}), (2, text, "other", 2, None), (9, "something else altogether here", "z", None, {})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_key` string, `a.b` int, more map<string,int>").repartition(3)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [rows[2], rows[3]]
    lone = corpus_pipeline.near_duplicate_stage(spark, docs.filter("doc_id = 3"), "").collect()
    assert [tuple(r) for r in lone] == [rows[0]]


def test_texts_are_found_in_slices():
    from isoreach.llm.common import Texts, hash_spans

    t = Texts(pa.array([1, 2, 3]), pa.array(["ab  cd", "", "ef"]))
    starts, lengths, of = t.words(t.lower())
    assert [bytes(t.data[s : s + n]) for s, n in zip(starts, lengths, strict=True)] == [b"ab", b"cd", b"ef"]
    assert of.tolist() == [0, 0, 2]
    assert len(set(hash_spans(t.data, starts, lengths).tolist())) == 3


def test_signatures_do_not_depend_on_their_group():
    """Many short texts and a long one, signed in groups and all at once."""
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 40, 900)
    counts[5] = 5000
    owner = np.repeat(np.arange(900), counts)
    element, weight = rng.integers(0, 2**63, len(owner), dtype=np.uint64), rng.integers(1, 5, len(owner))
    grouped = dartminhash.signatures(owner, element, weight, 900)
    assert (grouped == dartminhash._signed(owner, element, weight, 900, dartminhash.COORDINATES, 3.0)).all()
    assert dartminhash.signatures(owner[:0], element[:0], weight[:0], 0).shape == (0, dartminhash.COORDINATES)


def test_quality_scores_carried_columns_in_one_python_pass(spark):
    """Texts that are carried along go to one Python worker, with the scores of those that are not (pipeline)."""
    docs = spark.createDataFrame([(i, f"text {i} " + ("Good words, here. " * (i % 7) if i % 2 else "| 12 | 7 " * (i % 5)), i % 3) for i in range(200)], "doc_id long, text string, extra int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    carried = quality.quality_scores(docs, labels, carry=docs.columns)
    assert carried._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    plain = {r["doc_id"]: (r["held_out"], round(r["score"], 9), r["predicted"]) for r in quality.quality_scores(docs, labels).collect()}
    rows = carried.collect()
    assert {r["doc_id"]: (r["held_out"], round(r["score"], 9), r["predicted"]) for r in rows} == plain
    assert sorted((r["_c0"], r["_c1"], r["_c2"]) for r in rows) == sorted(map(tuple, docs.collect()))
