"""Exact search and hard negatives against plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoreach.llm import exact_search, segment_negatives

SCHEMA = "vec_id long, label int, embedding array<double>, row string, block int, terms string, scores string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    vectors = [rng.normal(size=16).tolist() for _ in range(300)]
    vectors[40:80] = [vectors[40]] * 40  # ties
    vectors[80:120] = [[float(a + 0.2 * b) for a, b in zip(vectors[80], rng.normal(size=16), strict=True)] for _ in range(40)]
    odd = [[0.0] * 16, [], [1.5], [2.0] * 20, None, [None] * 16, [math.nan] * 16, [math.inf] + [0.0] * 15]
    made = [(i, i % 4, v) for i, v in enumerate(vectors)] + [(1000 + i, i % 4, v) for i, v in enumerate(odd)]
    made += [(20, 0, vectors[3]), (20, 0, vectors[3]), (41, 1, vectors[41]), (None, 1, vectors[5]), (1100, None, vectors[6])]
    return made


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(3)


def whole(vector, scale):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def product(a, b):
    return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=False))))


@pytest.mark.parametrize(("postings", "factor"), [(1 << 19, 1.0), (600, 1.0), (2000, 1e5), (2000, 1e12)])
def test_search(spark, rows, postings, factor):
    rows = [(i, label, v if v is None else [None if x is None else float(x * factor) for x in v]) for i, label, v in rows]
    sparse = exact_search.sparse_rows(table(spark, rows), 64)
    got = exact_search.search(sparse, F.col("vec_id") % 20 == 0, k=7, block_postings=postings, chunk_postings=postings)
    clean = [(i, whole(v, 64)) for i, _, v in rows]
    clean = [(i, v) for i, v in clean if i is not None and v is not None]
    want = []
    for at, (query, v) in enumerate(clean):
        if query % 20 == 0:
            found = sorted(((-product(v, w), i) for other, (i, w) in enumerate(clean) if other != at))[:7]
            want += [(query, n, i, -s) for n, (s, i) in enumerate(found, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_search_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0]), (5, [0.0]), (7, [-1.0])], "vec_id long, embedding array<float>")
    got = exact_search.search(exact_search.sparse_rows(few, 64), F.col("vec_id") == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 5, 0), (0, 2, 7, -4096)]
    assert exact_search.search(exact_search.sparse_rows(few.limit(0), 64), F.col("vec_id") == 0).count() == 0
    assert exact_search.search(exact_search.sparse_rows(few, 64), F.col("vec_id") == 99).count() == 0


@pytest.mark.parametrize(("numbers", "factor"), [(1 << 19, 1.0), (640, 1.0), (3000, 1e13)])
def test_hard_negatives(spark, rows, numbers, factor):
    rows = [(i, label, v if v is None else [None if x is None else float(x * factor) for x in v]) for i, label, v in rows]
    got = segment_negatives.hard_negatives(table(spark, rows).select("vec_id", "label", "embedding", "row", "scores"), F.col("vec_id") % 10 == 0, block_numbers=numbers, chunk_numbers=numbers)
    clean = [(i, label, whole(v, 256)) for i, label, v in rows if None not in (i, label)]
    clean = [r for r in clean if r[2] is not None]
    want = []
    for at, (anchor, label, v) in enumerate(clean):
        if anchor % 10:
            continue
        scored = [(-product(v, w), i, other) for n, (i, other, w) in enumerate(clean) if n != at]
        for s, positive, _ in sorted(r for r in scored if r[2] == label)[:5]:
            inside = sorted((t, i) for t, i, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            want += [(anchor, positive, n, i, -s, -t) for n, (t, i) in enumerate(inside, 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_hard_negatives_none(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert segment_negatives.hard_negatives(none, F.col("vec_id") == 0).count() == 0
    one = spark.createDataFrame([(0, 1, [1.0])], none.schema)
    assert segment_negatives.hard_negatives(one, F.col("vec_id") == 0).count() == 0


def test_text_labels(spark):
    named = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "b", [0.75, 0.0]), (3, "b", [0.25, 1.0])], "vec_id long, label string, embedding array<double>")
    got = segment_negatives.hard_negatives(named, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 49152)]


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    whole = np.cumsum(rng.integers(-9, 10, size=(500, 32)), axis=1) * rng.integers(1, 60, size=(500, 1))
    levels = segment_negatives.hierarchy(*segment_negatives.summaries(whole, 4), 4)
    exact, norms = whole @ whole.T, np.linalg.norm(whole, axis=1)
    widths = []
    for means, deviations in levels:
        middle, radius = means @ means.T, deviations @ deviations.T
        assert (np.abs(exact - middle) <= radius + segment_negatives.SLACK * norms * norms[:, None]).all()
        widths.append(radius.mean())
    assert [m.shape[1] for m, _ in levels] == [1, 2, 4, 8] and widths == sorted(widths, reverse=True)
    # Smooth vectors: a few segments tell most rows apart.
    import pyarrow as pa

    from isoreach.llm.common import binary_rows

    means, deviations = segment_negatives.summaries(whole, 4)
    ids = pa.array(range(500), pa.int64())
    block = pa.table({"row": ids, "vec_id": ids, "label": pa.array([0] * 500, pa.int64()), "vector": binary_rows(whole), "means": binary_rows(means), "deviations": binary_rows(deviations)})
    scorer = segment_negatives.Scorer(segment_negatives.Rows(block, 4), segment_negatives.Rows(block.slice(0, 20), 4))
    for i in range(20):
        segment_negatives.best_positives(scorer, i, 5)
    assert scorer.left[0] == 20 * 499 and scorer.left[len(levels)] < 0.2 * scorer.left[0]
