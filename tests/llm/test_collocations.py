"""Phrase mining against a plain counter."""

import re
from collections import Counter

import numpy as np
import pytest

from isoreach.llm import collocations, hat_trie

SCHEMA = "doc_id long, text string, lang string, phrase string, f string, grp int, size int"


def plain(rows, longest=3, least=10, inside=50, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            f.update(tuple(words[i : i + m]) for m in range(1, longest + 1) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * a >= inside * f[p[i:j]]}
        kept = []
        for p, a in frequent.items():
            if p not in dropped:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        out += [(lang, n, p.decode(), a, left, r, totals[lang], s) for n, (_, _, p, a, left, r, s) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    words = ["New", "york", "city", "of", "the", "The", "été", "ÉTÉ", "a.b", "x\x0by", "red", "car!", "-", "naïve", " z", "𝔘", "end;"]
    share = np.array([9, 8, 6, 5, 9, 3, 2, 2, 1, 1, 3, 2, 2, 1, 1, 1, 1], float)
    made = []
    for i in range(400):
        text = "".join(w + (" ", "\t", "  ", "\n", ", ")[int(rng.integers(0, 40)) % 5 if rng.random() < 0.3 else 0] for w in rng.choice(words, int(rng.integers(0, 60)), p=share / share.sum()))
        made.append((text, (None, "en", "und", "de")[i % 4]))
    made += [("New York city " * 3000, "en"), ("", "en"), (None, "en"), (None, None), ("the the the the the the the the the the the the", "xx"), (" \t.,", "zz")]
    return made + made[:50]


@pytest.mark.parametrize(("most", "burst", "part_bytes"), [(1 << 21, 1 << 15, 8 << 20), (40, 8, 2000)])
def test_collocations(spark, rows, monkeypatch, most, burst, part_bytes):
    monkeypatch.setattr(hat_trie, "BURST", burst)
    table = spark.createDataFrame([(i, t, g, "p", "f", 1, 2) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(5)
    got = collocations.collocations(table, most=most, part_bytes=part_bytes)
    want = plain(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths_and_limits(spark, rows, longest):
    table = spark.createDataFrame(rows, "body string, source string")
    got = collocations.collocations(table, "body", "source", longest=longest, least=5, top=9)
    assert got.columns[0] == "source"
    assert sorted(map(tuple, got.collect())) == plain(rows, longest, 5, 50, 9)


def test_nothing(spark):
    none = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(none).count() == 0
    rare = spark.createDataFrame([("one two three", "en")], none.schema)
    assert collocations.collocations(rare).count() == 0


def test_trie_counts(monkeypatch):
    monkeypatch.setattr(hat_trie, "BURST", 50)
    rng = np.random.default_rng(1)
    trie, want = hat_trie.HatTrie(3), Counter()
    for _ in range(30):
        ids = (rng.zipf(1.3, (800, 3)) % 500).astype(np.uint64) + np.uint64(1)
        keys, counts = np.unique((ids[:, 0] << np.uint64(42)) | (ids[:, 1] << np.uint64(21)) | ids[:, 2], return_counts=True)
        trie.add(keys, counts)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert any(isinstance(c, hat_trie.Node) for c in trie.root.children) and trie.n == len(want)
    first, left = trie.take(trie.n // 2), trie.n
    assert left <= len(want) // 2
    rest = trie.take(0)
    assert trie.n == 0
    got = dict(zip(first[0].tolist(), first[1].tolist(), strict=True)) | dict(zip(rest[0].tolist(), rest[1].tolist(), strict=True))
    assert got == want


def test_more_words_than_ids(spark):
    """A task has 32,767 ids for phrases of four words; beyond them its tries are spilled and ids start anew."""
    text = " ".join(f"w{i % 40000} k" for i in range(90000))
    table = spark.createDataFrame([(text, "en")], "text string, lang string")
    got = collocations.collocations(table, longest=4, least=2)
    assert sorted(map(tuple, got.collect())) == plain([(text, "en")], 4, 2)
