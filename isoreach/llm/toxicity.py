"""Toxicity by a factorization machine over hashed terms.

A text is the set of its hashed terms: words, and their first four and five bytes (inflected forms share a stem). Terms
are screened on the labelled sample by how unevenly the two classes use them; the machine then learns a weight for
each and, through factors, for each pair of them, so an insult next to a group mention can weigh more (or less) than
both alone.

Edge cases: a null text is an empty one and gets the bias as its score; null or conflicting labels teach nothing; with
no labels, or one class only, every score is that class's share (0.5 without any); an empty table gives an empty
result; repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import Texts, hash_spans, held_out, lists, map_texts, text_column

#: At most about so many labelled rows are used to fit.
FIT_ROWS = 20_000
BUCKETS = 1 << 20
TERMS = 512
FACTORS = 8
PREFIXES = (4, 5)


def hashed_terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, bucket) pairs of a slice, sorted."""
    lower = texts.lower()
    starts, lengths, of = texts.letters(lower)
    keys = [of * BUCKETS + (hash_spans(lower, starts, lengths) % np.uint64(BUCKETS)).astype(np.int64)]
    for size in PREFIXES:
        long = lengths >= size
        h = hash_spans(lower, starts[long], np.full(long.sum(), size), seed=size)
        keys.append(of[long] * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64))
    pairs = np.unique(np.concatenate(keys))
    return pairs // BUCKETS, pairs % BUCKETS


class Machine:
    """bias + sum of weights + sum over pairs of factor products, for sets of terms."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms)
        self.bias, self.weights = 0.0, np.zeros(len(terms))
        self.factors = np.zeros((len(terms), FACTORS))

    def margins(self, owner: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        total = np.full(n, self.bias)
        if len(self.terms) and len(term):
            at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            known = self.terms[at] == term
            at, owner = at[known], owner[known]
            total += np.bincount(owner, self.weights[at], n)
            for f in range(self.factors.shape[1]):
                v = self.factors[at, f]
                total += 0.5 * (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n))
        return total

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 512, rate: float = 0.02, decay: float = 1e-5) -> None:
        """Adam over mini-batches of a 0/1 matrix."""
        rng = np.random.default_rng(7)
        self.factors = rng.normal(0, 0.05, self.factors.shape)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        params = [np.array([self.bias]), self.weights, self.factors]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
                step += 1
                xb = x[at].astype(np.float64)
                s = xb @ params[2]
                z = params[0] + xb @ params[1] + 0.5 * ((s * s).sum(1) - xb @ (params[2] ** 2).sum(1))
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / len(at)
                pull = xb.T @ (s * e[:, None]) - params[2] * (xb.T @ e)[:, None]
                for i, g in enumerate([np.array([e.sum()]), xb.T @ e + decay * params[1], pull + decay * params[2]]):
                    first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
                    params[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.bias, self.weights, self.factors = float(params[0][0]), params[1], params[2]


def _screened(sample: DataFrame) -> tuple[np.ndarray, float, int]:
    """The TERMS terms used most unevenly by the classes (log odds against their standard error), share of 1, rows."""
    counts = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    zero, one = counts.get(0, 0), counts.get(1, 0)
    if not zero or not one:
        return np.zeros(0, np.int64), (one / (zero + one) if zero + one else 0.5), zero + one

    def each(batch: pa.RecordBatch, texts: Texts):
        owner, term = hashed_terms(texts)
        y = batch.column(2).to_numpy(zero_copy_only=False)[owner]
        found, at = np.unique(term, return_inverse=True)
        yield {"term": found, "a": np.bincount(at, y == 0, len(found)).astype(np.int64), "b": np.bincount(at, y == 1, len(found)).astype(np.int64)}

    used = map_texts(sample, [F.col("doc_id"), F.col("_text"), F.col("y")], each, "term long, a long, b long")
    used = used.groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(b / (one + 1 - b)) - F.log(a / (zero + 1 - a))
    z = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    top = used.select("term", z.alias("z")).orderBy(F.desc("z"), "term").limit(TERMS).collect()
    return np.array([r["term"] for r in top], np.int64), one / (zero + one), zero + one


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, modulus: int = 5) -> Machine:
    """Fit on a bounded hash sample of the labelled rows that are not held out."""
    known = labels.groupBy("doc_id").agg(F.min("toxic").alias("y"), F.max("toxic").alias("_hi"))
    known = known.filter((F.col("y") == F.col("_hi")) & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"), modulus)).select("doc_id", F.col("y").cast("int").alias("y"))
    share = min(1.0, fit_rows / max(known.count(), 1))
    known = known.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * share))
    sample = docs.select("doc_id", text_column(docs).alias("_text")).join(F.broadcast(known), "doc_id")
    terms, ones, rows = _screened(sample)
    machine = Machine(terms)
    if not len(terms):
        ones = min(max(ones, 1e-3), 1 - 1e-3) if rows else 0.5
        machine.bias = float(np.log(ones / (1 - ones)))
        return machine
    names = machine.terms

    def each(batch: pa.RecordBatch, texts: Texts):
        owner, term = hashed_terms(texts)
        at = np.minimum(np.searchsorted(names, term), len(names) - 1)
        known = names[at] == term
        yield {"y": batch.column(2), "at": lists(at[known], np.bincount(owner[known], minlength=texts.n), pa.int32())}

    found = map_texts(sample, [F.col("doc_id"), F.col("_text"), F.col("y")], each, "y int, at array<int>").toArrow()
    at = found.column("at").combine_chunks()
    x = np.zeros((len(at), len(names)), np.float32)
    x[np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False)), at.flatten().to_numpy(zero_copy_only=False)] = 1
    y = found.column("y").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T[:16], y))  # rows arrive in any order; the fit must not depend on it
    machine.fit(x[order], y[order])
    return machine


def toxicity_scores(docs: DataFrame, labels: DataFrame, cut: float = 0.5, fit_rows: int = FIT_ROWS, modulus: int = 5) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted (1 from ``cut`` on)."""
    machine = train(docs, labels, fit_rows, modulus)

    def each(batch: pa.RecordBatch, texts: Texts):
        z = machine.margins(*hashed_terms(texts), texts.n)
        yield {"doc_id": batch.column(0), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    kind = dict(docs.dtypes)["doc_id"]
    scored = map_texts(docs, [F.col("doc_id"), text_column(docs)], each, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), modulus).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
