"""Operators on vectors, and components, against brute force."""

import numpy as np
import pytest

from isoreach.llm import grid_join, neighbours
from isoreach.llm.components import components
from isoreach.operators.joins import Workspace

SCHEMA = "vec_id long, embedding array<float>, label int, block int, x string"


def cosines(v):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    return u @ u.T


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(900, 16)).astype(np.float32)
    v[100:300] = v[100] + rng.normal(size=(200, 16)).astype(np.float32) * 0.05
    v[300:340] = v[300]
    v[340:400] = v[340] + rng.normal(size=(60, 16)).astype(np.float32) * 0.2
    return v


def rows(v):
    bad = [(-1, None), (-2, [0.0] * 16), (-3, [float("nan")] * 16), (-4, [None] * 16), (-5, []), (-6, [float("inf")] * 16), (-7, [1.0, 2.0]), (None, [1.0] * 16)]
    return [(i, [float(c) for c in x], 0, 1, "x") for i, x in enumerate(v)] + [(i, x, 0, 1, "x") for i, x in bad]


def linked(v, cosine=0.95):
    near = cosines(v.astype(float)) >= cosine
    np.fill_diagonal(near, False)
    label = np.arange(len(v))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(v)).min(1))
        if (new == label).all():
            return near.sum(1), label
        label = new


@pytest.mark.parametrize("interval", [64, 5000])
def test_near_vectors(spark, vectors, interval):
    table = spark.createDataFrame(rows(vectors), SCHEMA).repartition(4)
    got = {r.vec_id: r for r in grid_join.near_vectors(table, interval_rows=interval).collect()}
    count, label = linked(vectors)
    assert [(got[i].n_links, got[i].component_id) for i in range(len(vectors))] == list(zip(count.tolist(), label.tolist(), strict=True))
    assert all(got[-i].n_links == 0 and got[-i].component_id == -i and got[-i].kept for i in range(1, 8))
    assert got[None].component_id is None and got[None].n_links == 0
    assert len(got) == len(vectors) + 8


@pytest.mark.parametrize("travels", [0, 1000])
def test_near_vectors_where_blocks_travel_or_not(spark, vectors, monkeypatch, travels):
    """repeated ids, equal vectors and both ways for blocks to meet."""
    monkeypatch.setattr(grid_join, "TRAVELS", travels)
    vectors = vectors.copy()
    vectors[305, 3] = vectors[300, 3] = 0.0
    twice = [(7, [float(c) for c in np.sort(vectors[7]) - 9], 0, 1, "x"), (400, [float(c) for c in vectors[400]], 0, 1, "x")]
    some = [(i, [-0.0 if i == 305 and c == 0 else c for c in x], *rest) for i, x, *rest in rows(vectors)[: len(vectors)]]
    got = {r.vec_id: r for r in grid_join.near_vectors(spark.createDataFrame(some + twice, SCHEMA).repartition(3), interval_rows=50).collect()}
    least = np.sort(vectors[7]) - np.float32(9)
    if least.tolist() < vectors[7].tolist():
        vectors[7] = least
    count, label = linked(vectors)
    assert [(got[i].n_links, got[i].component_id) for i in range(len(vectors))] == list(zip(count.tolist(), label.tolist(), strict=True))
    assert len(got) == len(vectors)


def test_blocks_are_not_copied_for_every_pair(spark, monkeypatch):
    """vectors of which no blocks are far apart are not shuffled to their pairs, however many intervals there are."""
    plans, save = {}, Workspace.save

    def saved(self, df, name, *args, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return save(self, df, name, *args, **options)

    monkeypatch.setattr(Workspace, "save", saved)
    v = np.random.default_rng(3).normal(size=(1500, 16)).astype(np.float32)
    table = spark.createDataFrame([(i, x.tolist(), 0, 1, "x") for i, x in enumerate(v)], SCHEMA)
    assert grid_join.near_vectors(table, interval_rows=64).agg({"n_links": "sum"}).first()[0] == linked(v)[0].sum()
    assert "Exchange hashpartitioning" not in plans["met"]


def test_join_blocks_beyond_a_strip():
    """Sides of several strips, links counted by weight, near runs counted as a whole."""
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(size=(2500, 8)), rng.normal(size=8) + rng.normal(size=(700, 8)) * 0.01])
    v /= np.linalg.norm(v, axis=1)[:, None]
    v = v[np.argsort(v[:, 0])]
    w = rng.integers(1, 5, len(v))
    near = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    for cut in (len(v), 1500):
        a = grid_join.Side(np.arange(cut), w[:cut], v[:cut], v[:cut])
        b = a if cut == len(v) else grid_join.Side(np.arange(cut, len(v)), w[cut:], v[cut:], v[cut:])
        cx, cy, forest = grid_join.join_blocks(a, b, 0.95)
        here = near if a is b else near & (np.arange(len(v))[:, None] < cut) & (np.arange(len(v)) >= cut)
        assert (cx == here[:cut] @ w).all() and (a is b or (cy == here.T[cut:] @ w).all())
        both = here | here.T
        label = np.arange(len(v))
        while ((new := np.minimum(label, np.where(both, label[None, :], len(v)).min(1))) != label).any():
            label = new
        found = np.arange(len(v))
        found[forest[:, 1]] = forest[:, 0]
        assert (found == label).all()


def test_no_vectors(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert grid_join.near_vectors(table).count() == 0
    assert neighbours.search(table, table).count() == 0
    lone = spark.createDataFrame([(4, None, 0, 0, "")], SCHEMA)
    assert [tuple(r) for r in grid_join.near_vectors(lone).collect()] == [(4, 0, 4, True)]


def test_search(spark, vectors):
    table = spark.createDataFrame(rows(vectors), SCHEMA).repartition(4)
    got = neighbours.search(table, table.filter("vec_id % 20 = 0"), k=5, block_rows=200, chunk_rows=16).collect()
    cos = cosines(vectors.astype(float))
    np.fill_diagonal(cos, -9)
    hits = total = 0
    for q in range(0, len(vectors), 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - cos[q, r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        fifth = np.sort(cos[q])[-5]
        hits += sum(r.score >= fifth - 1e-12 for r in mine)
        total += 5
    assert hits / total >= 0.9
    assert {r.query_id for r in got} == set(range(0, len(vectors), 20))


def test_few_candidates(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, neighbours.search(table, table.filter("vec_id = 0")).collect()))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2)]


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 360)] + [tuple(map(int, rng.integers(1000, 1200, 2))) for _ in range(120)]
    links = spark.createDataFrame([*pairs, (5, 5), (None, 3), (0, 1)], "u long, v long")
    got = {r.id: r.component_id for r in components(links, Workspace(spark)).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    used = {x for p in pairs if p[0] != p[1] for x in p}
    assert got == {x: find(x) for x in used}
    assert components(links.limit(0), Workspace(spark), "none").count() == 0
