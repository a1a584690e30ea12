"""Licence scan: a paragraph classifier with an unknown class, confirmed against templates.

Paragraphs are runs of lines up to a blank one (a line without a word, such as a bare comment mark). Scored are the
sentences of each line and, where lines are joined, the windows of a paragraph in which a template may be found (so a
notice may be wrapped or stand behind comment marks, which are no words). Features are word n-grams (one to three words, hashed) and the share of
words that no template has. A multinomial logistic regression is trained on the templates, with pieces of them and
templates inside other words, against sentences of the whole corpus as the unknown class. Its probabilities are calibrated
by a temperature fitted on held-out examples; below ``cut`` a paragraph is unknown. A named family is confirmed only
if one of its templates is found in the paragraph: at least ``alike`` of the template's word pairs must occur.

A paragraph without any word pair of a template cannot be confirmed as anything, so it is unknown without being scored.

Edge cases: a null or empty text has no paragraphs; texts are scanned whole; an empty table gives an empty result;
repeated rows are scanned each; of equal families in a document the count is kept.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import ByValue, Texts, hash_spans, map_texts, mix64, text_column

# Usual short notices of licence families.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the License", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License", "This project is licensed under the terms of the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "SPDX-License-Identifier: MIT"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "either version 3 of the License, or (at your option) any later version", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "either version 2 of the License, or (at your option) any later version", "SPDX-License-Identifier: GPL-2.0-only"],
    "LGPL": ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "AGPL": ["under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: AGPL-3.0-only"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights", "Released under CC0 1.0 into the public domain"],
    "Proprietary": ["All rights reserved", "No part of this publication may be reproduced without the prior written permission of the publisher"],
}
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)
#: Notices of these families name a version as those of the plain GPL do; that part is not a notice of its own.
LONGER = {"LGPL", "AGPL"}
PLAIN = {"GPL-2.0", "GPL-3.0"}
GAP = 4
#: At most so many sentences of the corpus stand for the unknown class in training.
FIT_ROWS = 4_000
ORDER = 3

_BREAK = np.zeros(256, bool)
_BREAK[[10, 13]] = True
_WORD = np.zeros(256, bool)
_WORD[ord("a") : ord("z") + 1] = True
_WORD[ord("0") : ord("9") + 1] = True
_WORD[0x80:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


def sentences(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice: hash, sentence number (in the slice), and of each sentence its text and start byte.

    A sentence ends at a line break, or behind . ! ? followed by a space.
    """
    lower = texts.lower()
    if not len(lower):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    stop = _BREAK[lower]
    stop[1:] |= _END[lower[:-1]] & (lower[1:] == 32)
    starts, _, of = texts.runs(~stop)
    word, length, _ = texts.runs(_WORD[lower])
    return hash_spans(lower, word, length), np.searchsorted(starts, word, "right") - 1, of, starts


def paragraphs(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of a slice: paragraph number, text, start byte. A paragraph goes on over single line breaks."""
    lower = texts.lower()
    start, _, of = texts.runs(_WORD[lower])
    ends = _BREAK[lower]
    ends[:-1] &= (lower[:-1] != 13) | (lower[1:] != 10)
    line = np.cumsum(ends)[start]
    new = (of[1:] != of[:-1]) | (line[1:] - line[:-1] > 1)
    return np.cumsum(np.r_[False, new])[: len(start)], of, start


def ngrams(word: np.ndarray, paragraph: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, hashes of the n-grams inside paragraphs and their paragraph."""
    out, h = [(word, paragraph)], word
    for n in range(2, ORDER + 1):
        h = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[n - 1 :]) if len(h) else h
        inside = paragraph[n - 1 :] == paragraph[: len(h)]
        out.append((h, paragraph[: len(h)], inside))
    return [out[0]] + [(h[inside], p[inside]) for h, p, inside in out[1:]]


def _of(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of strings taken as one paragraph each."""
    flat = [s.replace(". ", " ").replace("\n", " ") for s in strings]
    texts = Texts(pa.array(range(len(flat))), pa.array(flat, pa.string()))
    word, at, of, _ = sentences(texts)
    return word, of[at] if len(at) else at


class Classifier(ByValue):
    """Sparse logistic regression over the templates' n-grams, a share of foreign words, and a constant."""

    def __init__(self, background: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        flat = [(k, s) for k, f in enumerate(FAMILIES) for s in TEMPLATES[f]]
        word, at = _of([s for _, s in flat])
        grams = ngrams(word, at)
        self.vocabulary = np.unique(np.concatenate([h for h, _ in grams]))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        pair, owner = grams[1]
        self.pair_family = [(FAMILIES.index(FAMILIES[flat[i][0]]), np.unique(pair[owner == i])) for i in range(len(flat))]
        self.pairs = np.unique(pair)
        others = [np.concatenate([t for f, t in self.pair_family if f != k]) for k in range(len(FAMILIES))]
        self.own_pairs = [np.setdiff1d(t, others[k]) for k, t in self.pair_family]
        examples, y = [], []
        filler = [w for s in background for w in s.split()] or ["lorem", "ipsum", "dolor", "sit", "amet"]
        for k, s in flat:
            w = s.split()
            for i in range(24):
                cut = max(3, int(len(w) * rng.uniform(0.7, 1)))
                start = rng.integers(0, len(w) - cut + 1) if len(w) > cut else 0
                around = [str(x) for x in rng.choice(filler, rng.integers(0, 8))] if i else []
                examples.append(" ".join([*around[::2], *(w[start : start + cut] if i else w), *around[1::2]]))
                y.append(k)
        plain = [s for s in background if self.alike(s)[1] < 0.5] + [" ".join(str(x) for x in rng.choice(filler, 9)) for _ in range(300)]
        examples, y = examples + plain, np.array(y + [UNKNOWN] * len(plain))
        x = self.matrix(*_of(examples), len(examples))
        hold = np.arange(len(y)) % 5 == 0
        self.weights = np.zeros((x.shape[1], UNKNOWN + 1))
        m, v = np.zeros_like(self.weights), np.zeros_like(self.weights)
        target = np.eye(UNKNOWN + 1)[y[~hold]]
        for step in range(1, 201):
            g = x[~hold].T @ (self._soft(x[~hold] @ self.weights) - target) / (~hold).sum() + 1e-5 * self.weights
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            self.weights -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            self.weights[np.abs(self.weights) < 1e-3] = 0.0
        z = x[hold] @ self.weights
        grid = np.geomspace(0.3, 5, 30)
        loss = [-np.log(self._soft(z / t)[np.arange(hold.sum()), y[hold]] + 1e-12).mean() for t in grid]
        self.weights = self.weights / grid[int(np.argmin(loss))]

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def matrix(self, word: np.ndarray, paragraph: np.ndarray, n: int) -> np.ndarray:
        x = np.zeros((n, len(self.vocabulary) + 2))
        size = np.bincount(paragraph, minlength=n)
        known = np.zeros(n)
        for order, (h, p) in enumerate(ngrams(word, paragraph)):
            at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == h
            x[p[hit], at[hit]] = 1.0
            if not order:
                known = np.bincount(p[hit], minlength=n)
        x[:, -2] = 1 - known / np.maximum(size, 1)
        x[:, -1] = 1.0
        return x

    def alike(self, text: str) -> tuple[int, float]:
        return self.compared(np.unique(ngrams(*_of([text]))[1][0]))

    def compared(self, pairs: np.ndarray) -> tuple[int, float]:
        """Family of the template most of whose word pairs occur, and that share."""
        share = [(np.isin(t, pairs).mean() if len(t) else 0.0, len(t), k) for k, t in self.pair_family]
        best = max(share)
        return best[2], float(best[0])

    def scan(self, texts: Texts, cut: float, alike: float) -> list[tuple[int, int, str, float, float]]:
        """(text number, start byte, family, probability, similarity) of confirmed notices."""
        word, sentence, of, starts = sentences(texts)
        if len(word) < 2:
            return []
        paragraph, text, start = paragraphs(texts)
        pair, _ = ngrams(word, np.zeros(len(word), np.int64))[1]
        first = np.flatnonzero(self.seen[(pair & np.uint64(0xFFFF)).astype(np.int64)] & (paragraph[1:] == paragraph[:-1]))
        pair = pair[first]
        hit = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        first, pair = first[hit], pair[hit]
        inner = sentence[first] == sentence[first + 1]
        chosen = np.unique(sentence[first[inner]])
        spans = np.c_[np.searchsorted(sentence, chosen), np.searchsorted(sentence, chosen, "right")]
        bytes_ = starts[chosen]
        more = self.windows(first, pair, paragraph, alike)
        spans = np.concatenate([spans, more]) if len(more) else spans
        bytes_ = np.r_[bytes_, start[more[:, 0]]] if len(more) else bytes_
        if not len(spans):
            return []
        size = spans[:, 1] - spans[:, 0]
        number = np.repeat(np.arange(len(spans)), size)
        inside = np.arange(len(number)) - np.repeat(np.cumsum(size) - size, size) + spans[number, 0]
        p = self._soft(self.matrix(word[inside], number, len(spans)) @ self.weights)
        found = []
        for i in np.flatnonzero((p.argmax(1) != UNKNOWN) & (p.max(1) >= cut)):
            k = int(p[i].argmax())
            near = slice(*np.searchsorted(first, [spans[i, 0], spans[i, 1] - 1]))
            family, similarity = self.compared(pair[near])
            if family == k and similarity >= alike:
                found.append((i >= len(chosen), *spans[i].tolist(), int(bytes_[i]), FAMILIES[k], float(p[i, k]), similarity))
        # Sentences come first; a window counts where no sentence or better window of its family is.
        kept, there, longer = [], defaultdict(list), defaultdict(list)
        for x in sorted(found, key=lambda x: (x[0], -x[6], -x[5], x[1])):
            same = there[paragraph[x[1]], x[4]]
            if not x[0] or not any(x[1] < y[2] and y[1] < x[2] for y in same):
                kept.append(x)
                same.append(x)
                if x[4] in LONGER:
                    longer[paragraph[x[1]]].append(x)
        part = lambda x: x[4] in PLAIN and any(x[1] - y[2] <= GAP and y[1] - x[2] <= GAP for y in longer[paragraph[x[1]]])
        return [(int(text[x[1]]), *x[3:]) for x in sorted(kept, key=lambda x: x[1]) if not part(x)]

    def windows(self, first: np.ndarray, pair: np.ndarray, paragraph: np.ndarray, alike: float) -> np.ndarray:
        """Word ranges inside paragraphs with at least ``alike`` of a template's pairs, and one that its family alone has."""
        out = []
        for (_, t), own in zip(self.pair_family, self.own_pairs, strict=True):
            need, width = max(1, int(np.ceil(alike * len(t) - 1e-9))), len(t) + max(GAP, len(t) // 2)
            at = np.flatnonzero(np.isin(pair, t))
            if len(at) < need:
                continue
            h, x = first[at], pair[at]
            a, b = h[: len(h) - need + 1], h[need - 1 :]
            best = None
            for j in np.flatnonzero((b - a < width) & (paragraph[a] == paragraph[b])):
                end = np.searchsorted(h, h[j] + width)
                end = j + int(np.searchsorted(paragraph[h[j:end]], paragraph[h[j]], "right"))
                n = len(np.unique(x[j:end]))
                if n < need or not np.isin(own, x[j:end]).any():
                    continue
                if best is not None and h[j] >= best[2]:
                    out.append(best[1:])
                    best = None
                if best is None or n > best[0]:
                    best = (n, int(h[j]), int(h[end - 1]) + 2)
            if best is not None:
                out.append(best[1:])
        return np.unique(np.array(out, np.int64).reshape(-1, 2), axis=0)


def _background(docs: DataFrame, rows: int) -> list[str]:
    """A hash sample of the sentences of all whole texts: the ``rows`` with the smallest hashes of text and offset.

    Copies of a text give their sentences once, so a repeated text does not fill the sample.
    """

    def each(batch: pa.RecordBatch, texts: Texts):
        word, sentence, of, starts = sentences(texts)
        whole = hash_spans(texts.data, texts.offsets[:-1], np.diff(texts.offsets), seed=3)
        at = np.unique(sentence)
        h = mix64(whole[of[at]] + mix64((starts[at] - texts.offsets[of[at]]).astype(np.uint64)))
        least = np.argsort(h, kind="stable")
        _, one = np.unique(h[least], return_index=True)
        at, h = at[least[one[:rows]]], h[least[one[:rows]]]
        end = np.minimum(np.r_[starts[1:], len(texts.data)], texts.offsets[of + 1]) if len(starts) else starts
        cut = [texts.data[starts[i] : end[i]].tobytes().decode("utf-8", "replace").strip("\r\n") for i in at]
        yield {"h": (h >> np.uint64(1)).view(np.int64), "s": pa.array(cut, pa.string())}

    chosen = map_texts(docs, [F.col("doc_id"), text_column(docs)], each, "h long, s string").distinct()
    return sorted(r["s"] for r in chosen.orderBy("h", "s").limit(rows).collect())


def scan_licences(docs: DataFrame, cut: float = 0.5, alike: float = 0.8, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Every document: doc_id, n_found, families (sorted, distinct), probability and similarity of its surest, first_byte."""
    model = docs.sparkSession.sparkContext.broadcast(Classifier(_background(docs, fit_rows)))

    def each(batch: pa.RecordBatch, texts: Texts):
        found: list[list] = [[] for _ in range(texts.n)]
        for i, at, *rest in model.value.scan(texts, cut, alike):
            found[i].append((*rest, at - int(texts.offsets[i])))
        surest = [max(f, key=lambda x: (x[1], x[2], -x[3])) if f else None for f in found]
        yield {
            "doc_id": batch.column(0), "n_found": np.array([len(f) for f in found], np.int64),
            "families": pa.array([sorted({x[0] for x in f}) for f in found], pa.list_(pa.string())),
            "family": pa.array([s and s[0] for s in surest], pa.string()),
            "probability": pa.array([s and s[1] for s in surest], pa.float64()),
            "similarity": pa.array([s and s[2] for s in surest], pa.float64()),
            "first_byte": pa.array([min(x[3] for x in f) if f else None for f in found], pa.int64()),
        }

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_found long, families array<string>, family string, probability double, similarity double, first_byte long"
    return map_texts(docs, [F.col("doc_id"), text_column(docs)], each, schema)
