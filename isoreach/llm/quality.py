"""Quality classifier by positive-unlabelled learning.

Trusted positives are the rows labelled 1; everything else, labelled or not, is unlabelled web text. A linear model
over the shape of a text (transitions between classes of bytes, repetition of words and lines, lengths) minimises the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))        (logistic loss)

so rows labelled 0 are never needed. The class prior is estimated from the data: over any set A of texts,
U(A) >= prior * P(A), and the bound is tight where no negative falls into A. A first model of positives against
unlabelled text orders all texts; the smallest ratio over upper sets of that order is the estimate.

Edge cases: a null text is an empty one and gets a score; null or conflicting labels teach nothing; without any
positive every score is the prior's default; an empty table gives an empty result; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoreach.llm.common import BATCH_TEXTS, Texts, binary_rows, hash_spans, held_out, map_texts, text_column
from isoreach.operators.joins import Workspace

#: At most about so many positives, and so many unlabelled rows, are gathered to fit the model.
FIT_ROWS = 10_000
DEFAULT_PRIOR = 0.5

_CLASS = np.full(256, 10, np.uint8)  # other ASCII signs
_CLASS[:32] = 13
_CLASS[[9, 10, 11, 12, 13]] = 1
_CLASS[32] = 0
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("A") : ord("Z") + 1] = 3
_CLASS[ord("0") : ord("9") + 1] = 4
for _i, _c in enumerate(".,!?|"):
    _CLASS[ord(_c)] = 5 + _i
_CLASS[0x80:0xC0] = 12
_CLASS[0xC0:] = 11
CLASSES = 14
WIDTH = CLASSES * CLASSES + 9


def _share(top: np.ndarray, of: np.ndarray) -> np.ndarray:
    return top / np.maximum(of, 1)


def _repetition(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: items, distinct items, count of its most frequent item."""
    total = np.bincount(owner, minlength=n)
    if not len(h):
        return total, total, total
    order = np.lexsort((h, owner))
    o, x = owner[order], h[order]
    new = np.r_[True, (o[1:] != o[:-1]) | (x[1:] != x[:-1])]
    at = np.flatnonzero(new)
    counts = np.diff(np.r_[at, len(x)])
    most = np.zeros(n, np.int64)
    np.maximum.at(most, o[at], counts)
    return total, np.bincount(o[at], minlength=n), most


def shape_features(texts: Texts) -> np.ndarray:
    """A row of WIDTH numbers for each text, from its whole length."""
    n, size = texts.n, np.diff(texts.offsets)
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    kind = _CLASS[texts.data]
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    pair = (owner[1:] * np.int32(CLASSES) + kind[1:]) * np.int32(CLASSES) + kind[:-1] if len(owner) else np.zeros(0, np.int32)
    steps = np.bincount(pair[inside], minlength=n * CLASSES * CLASSES).reshape(n, -1)
    del owner, kind, inside, pair  # the largest arrays of a slice
    out = np.zeros((n, WIDTH), np.float32)
    out[:, : CLASSES * CLASSES] = np.sqrt(_share(steps, steps.sum(1)[:, None]))
    lower = texts.lower()
    starts, lengths, of = texts.words(lower)
    h = hash_spans(lower, starts, lengths)
    words, distinct, most = _repetition(of, h, n)
    same = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    line_start, line_len, line_of = texts.runs(lower != 10)
    lines, distinct_lines, most_lines = _repetition(line_of, hash_spans(lower, line_start, line_len), n)
    out[:, -9:] = np.stack([
        np.log1p(size), np.log1p(words), _share(size, words) / 10, _share(distinct, words), _share(most, words),
        _share(np.bincount(of[1:][same], minlength=n), words), _share(distinct_lines, lines), _share(most_lines, lines),
        _share(lines * 100, np.maximum(words, 1)),
    ], axis=1)
    return out


def features(docs: DataFrame, columns: dict[str, Column], made: Callable[[np.ndarray], pa.Array] = binary_rows, name_kind: str = "x binary") -> DataFrame:
    """The named columns and ``x``, the features of the text as float32 bytes, or else what ``made`` makes of them."""
    def each(batch: pa.RecordBatch, texts: Texts):
        yield {"_id": batch.column(0)} | {str(i): c for i, c in enumerate(batch.columns[2:])} | {"_made": made(shape_features(texts))}

    first = docs.select(*(c.alias(f"_f{i}") for i, c in enumerate(columns.values())), text_column(docs).alias("_text"))
    kinds = dict(first.dtypes)
    names = list(columns)
    schema = ", ".join(f"`{name}` {kinds[f'_f{i}']}" for i, name in enumerate(names)) + f", {name_kind}"
    order = [F.col("_f0"), F.col("_text"), *(F.col(f"_f{i}") for i in range(1, len(names)))]
    return map_texts(first, order, each, schema)


def _matrix(rows: DataFrame) -> np.ndarray:
    found = rows.select("x").toArrow().column("x").to_pylist()
    return np.frombuffer(b"".join(found), np.float32).reshape(-1, WIDTH).astype(np.float64)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (bias last) minimising the non-negative risk; without a prior, plain positives against unlabelled."""
    p, u = (np.c_[m, np.ones(len(m))] for m in (positive, unlabelled))
    w, first, second = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        up = -(p * sigmoid(-zp)[:, None]).mean(0)  # gradient of R_p(+)
        un = (u * sigmoid(zu)[:, None]).mean(0)  # of R_u(-)
        if prior is None:
            grad = up + un
        else:
            pn = (p * sigmoid(zp)[:, None]).mean(0)  # of R_p(-)
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            # Below zero the bound is over-fitted: step back on that part instead of gaining from it.
            grad = prior * up + un - prior * pn if negative >= 0 else prior * pn - un
        grad[:-1] += decay * w[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest U(A) / P(A) over upper sets of a histogram; both sides are widened by their sampling error."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return DEFAULT_PRIOR
    p, u = np.cumsum(positive[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    enough = p >= 0.2
    ratio = (u + np.sqrt(u * (1 - u) / n_u))[enough] / np.maximum(p - np.sqrt(p * (1 - p) / n_p), 1e-9)[enough]
    return float(np.clip(ratio.min(), 0.01, 0.99))


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, cut: float = 0.3, modulus: int = 5, carry: list[str] | None = None) -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted (1 from ``cut`` on), and the ``carry`` columns as _c0, _c1...

    Labels (doc_id, quality) are used only where the row is not held out. Features are written once; the model is
    fitted on bounded hash samples, the prior on the scores of all rows, and every row is scored.
    """
    spark = docs.sparkSession
    work = Workspace(spark)
    columns = {"doc_id": F.col("doc_id"), "held_out": held_out(F.col("doc_id"), modulus)}
    x = work.save(features(docs, columns), "features", BATCH_TEXTS)
    learn = x.filter(~F.col("held_out") & F.col("doc_id").isNotNull())
    trusted = labels.groupBy(F.col("doc_id")).agg(F.min("quality").alias("_lo"), F.max("quality").alias("_hi"))
    trusted = trusted.filter((F.col("_lo") == 1) & (F.col("_hi") == 1) & ~held_out(F.col("doc_id"), modulus)).select("doc_id")
    chance = lambda total: F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fit")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, fit_rows / max(total, 1)))
    sample = F.broadcast(trusted.filter(chance(trusted.count())))
    positive = _matrix(learn.join(sample, "doc_id", "left_semi"))
    unlabelled = _matrix(learn.filter(chance(learn.count())))
    if len(positive) and len(unlabelled):
        centre, spread = unlabelled.mean(0), unlabelled.std(0) + 0.05
        scaled = [np.clip((m - centre) / spread, -8, 8) for m in (positive, unlabelled)]
        edges = 400
        bins = lambda z: np.clip((z + 10) / 20 * edges, 0, edges - 1).astype(int)
        first = fit(*scaled, None)
        counted = np.zeros(edges)
        for row in _bins(learn, first, centre, spread, edges).collect():
            counted[row["bin"]] = row["n"]
        prior = estimate_prior(np.bincount(bins(scaled[0] @ first[:-1] + first[-1]), minlength=edges), counted)
        weights = fit(*scaled, prior)
    else:
        centre, spread, weights, prior = np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), DEFAULT_PRIOR
    if carry is None:
        scored = _scored(x, weights, centre, spread)
    else:
        # Wanted columns of the documents are not stored a second time: the last pass reads the texts again, and scores
        # them where it has their features: a second Python worker a task would hold the texts once more.
        wanted = columns | {f"_c{i}": F.col(f"`{c}`") for i, c in enumerate(carry)}
        scored = features(docs, wanted, lambda rows: _score(_margin(rows, weights, centre, spread)), "score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def _rows(x: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.to_pylist()), np.float32).reshape(-1, WIDTH)


def _margin(rows: np.ndarray, weights: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((rows - centre) / spread, -8, 8) @ weights[:-1] + weights[-1]


def _score(z: np.ndarray) -> pa.Array:
    return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())


def _bins(x: DataFrame, weights: np.ndarray, centre: np.ndarray, spread: np.ndarray, edges: int) -> DataFrame:
    """Histogram of the first model's margins over all rows: at most ``edges`` rows."""
    def run(batches):
        for b in batches:
            z = _margin(_rows(b.column(0)), weights, centre, spread)
            n = np.bincount(np.clip((z + 10) / 20 * edges, 0, edges - 1).astype(int), minlength=edges)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(edges), pa.int32()), pa.array(n, pa.int64())], ["bin", "n"])

    return x.select("x").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))


def _scored(x: DataFrame, weights: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> DataFrame:
    kept = [c for c in x.columns if c != "x"]

    def run(batches):
        for b in batches:
            score = _score(_margin(_rows(b.column(b.num_columns - 1)), weights, centre, spread))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], score], [*b.schema.names[:-1], "score"])

    kinds = dict(x.dtypes)
    return x.select(*(f"`{c}`" for c in kept), "x").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", score double")
