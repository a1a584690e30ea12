"""Operators on hand-made inputs, against brute force where SQL is not the judge."""

import hashlib
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoreach.functions.geometry import edges_contain, polygon_edges, wkt_edges
from isoreach.functions.hexgrid import OFFSET, Q_SHIFT, HexGrid, hex_distance_int
from isoreach.operators import coverage, dissolve, equity, joins, layers, mclp, polyfill, population, quadtree, quantiles, sites, spatial_join
from isoreach.plans import fixtures, queries

GRID = HexGrid(5, -13.0)


def cell(q, r):
    return ((q + OFFSET) << Q_SHIFT) + r + OFFSET


def combos(spark, rows, schema):
    return spark.createDataFrame([("R", 1000, *r) for r in rows], f"region string, distance_m int, {schema}")


def relation_case(spark, weights, cover, existing, candidates, max_new):
    ids = {name: i for i, name in enumerate(weights)}
    return mclp.relation_steps(
        combos(spark, [(ids[c], w) for c, w in weights.items()], "cell long, w long").withColumn("w", F.col("w") * population.MICRO),
        combos(spark, [(f, ids[c]) for c, fs in cover.items() for f in fs], "facility_ID string, cell long"),
        combos(spark, [(e,) for e in existing], "ID string"),
        combos(spark, [(c,) for c in candidates], "ID string"),
        max_new,
    ).orderBy("p").collect()


WEIGHTS = {"h1": 100, "h2": 200, "h3": 150}


def test_greedy_relation(spark):
    steps = relation_case(spark, WEIGHTS, {"h1": ["A"], "h2": ["A", "B"], "h3": ["B"]}, [], ["A", "B"], 2)
    assert [(s["facility_id"], s["objective"]) for s in steps] == [("B", 350.0), ("A", 450.0)]


def test_greedy_relation_with_existing(spark):
    steps = relation_case(spark, WEIGHTS, {"h1": ["X", "A"], "h2": ["A", "B"], "h3": ["B"]}, ["X"], ["A", "B"], 2)
    assert [(s["facility_id"], s["objective"]) for s in steps] == [("B", 450.0)]


def test_greedy_relation_nothing_to_gain(spark):
    assert relation_case(spark, {"h1": 100}, {"h1": ["X"]}, ["X"], ["A"], 5) == []
    assert relation_case(spark, {}, {}, [], [], 5) == []


def random_case(seed, n_cells=60, n_sites=25):
    rng = random.Random(seed)
    at = lambda: cell(rng.randrange(14), rng.randrange(14))
    cells = list({at() for _ in range(n_cells)})
    weights = {c: rng.randrange(1, 50) for c in cells}
    return weights, {f"e{i}": at() for i in range(2)}, {f"c{i:02d}": at() for i in range(n_sites)}


def brute_greedy(weights, existing, candidates, k, max_new):
    near = lambda s: {c for c in weights if hex_distance_int(c, s) <= k}
    covered = set().union(*[near(s) for s in existing.values()]) if existing else set()
    left, out = dict(candidates), []
    total = sum(weights[c] for c in covered)
    for p in range(1, max_new + 1):
        gains = sorted((-sum(weights[c] for c in near(s) - covered), name) for name, s in left.items())
        if not gains or gains[0][0] == 0:
            break
        gain, name = -gains[0][0], gains[0][1]
        covered |= near(left.pop(name))
        total += gain
        out.append((p, name, float(gain), float(total)))
    return out


@pytest.mark.parametrize(("seed", "leaders", "entries"), [(1, 1024, 1 << 22), (2, 3, 1 << 22), (4, 1024, 40), (5, 4, 0)])
def test_greedy_steps_match_brute_force(spark, monkeypatch, seed, leaders, entries):
    """The same picks whether all candidates are looked at together, a few a round, or one (bounds that nothing fits)."""
    monkeypatch.setattr(mclp, "LEADERS", leaders)
    monkeypatch.setattr(mclp, "ENTRIES", entries)
    weights, existing, candidates = random_case(seed)
    site = lambda d: spark.createDataFrame([("R", i, c) for i, c in d.items()], "region string, ID string, cell long")
    w = spark.createDataFrame([("R", c, v * population.MICRO) for c, v in weights.items()], "region string, cell long, w long")
    distances = [8544, 17000]
    steps = mclp.site_steps(w, site(existing), site(candidates), distances, GRID, 14).collect()
    for d in distances:
        got = sorted((s["p"], s["facility_id"], s["gain"], s["objective"]) for s in steps if s["distance_m"] == d)
        expected = brute_greedy(weights, existing, candidates, GRID.rings(d), 14)
        assert got == expected
        gains = [g[2] for g in got]
        assert gains == sorted(gains, reverse=True)


@pytest.mark.parametrize(("seed", "leaders", "entries"), [(3, 1024, 1 << 22), (6, 2, 1 << 22), (8, 1024, 5)])
def test_greedy_over_a_relation_in_rounds(spark, monkeypatch, seed, leaders, entries):
    """The relation form agrees too, with ties (weights of 1 to 3) and with catchments beyond what a task may hold."""
    monkeypatch.setattr(mclp, "LEADERS", leaders)
    monkeypatch.setattr(mclp, "ENTRIES", entries)
    weights, existing, candidates = random_case(seed)
    weights = {c: 1 + w % 3 for c, w in weights.items()}
    cover = {c: [i for i, s in {**existing, **candidates}.items() if hex_distance_int(c, s) <= 2] for c in weights}
    steps = relation_case(spark, weights, cover, existing, candidates, 10)
    got = [(s["p"], s["facility_id"], s["gain"], s["objective"]) for s in steps]
    assert got == brute_greedy(weights, existing, candidates, 2, 10)


def test_lazy_picks_stop_at_the_bound():
    """Three leaders share cells; a candidate left out ends the batch as soon as it may come first."""
    cells, values = [[0, 1], [1, 2], [3]], [5, 4, 3, 2]
    run = lambda bound, room=9: mclp.lazy_picks([(9, "a"), (7, "b"), (2, "c")], lambda i: np.array(cells[i]), np.array(values), room, bound)
    assert run(None) == [(0, 9), (1, 3), (2, 2)]
    assert run(None, room=2) == [(0, 9), (1, 3)]
    assert run((3, "c")) == [(0, 9), (1, 3)] and run((3, "a")) == [(0, 9)]
    assert run((9, "b")) == [(0, 9)] and run((2, "d")) == [(0, 9), (1, 3), (2, 2)]


def test_greedy_is_near_optimal(spark):
    weights, _, candidates = random_case(7, 40, 9)
    best = brute_greedy(weights, {}, candidates, 2, 3)[-1][3]
    near = {n: {c for c in weights if hex_distance_int(c, s) <= 2} for n, s in candidates.items()}
    optimum = max(sum(weights[c] for c in set().union(*[near[n] for n in trio])) for trio in itertools.combinations(near, 3))
    w = spark.createDataFrame([("R", c, v * population.MICRO) for c, v in weights.items()], "region string, cell long, w long")
    s = spark.createDataFrame([("R", i, c) for i, c in candidates.items()], "region string, ID string, cell long")
    steps = mclp.site_steps(w, s.limit(0), s, [2 * 8544], GRID, 3)
    assert steps.agg(F.max("objective")).first()[0] == best >= (1 - 1 / 2.718281828) * optimum


def test_sweeps_match_pairwise_distances(spark):
    weights, existing, candidates = random_case(3)
    disks = spark.createDataFrame([("R", 1, c, 3) for c in set(candidates.values())], "region string, distance_m int, cell long, k int")
    cells = spark.createDataFrame([("R", 1, c, v) for c, v in weights.items()], "region string, distance_m int, cell long, w long")
    sums = {r["cell"]: r["w"] for r in coverage.disk_sums(disks, cells).collect()}
    assert sums == {s: sum(v for c, v in weights.items() if hex_distance_int(c, s) <= 3) for s in set(candidates.values())}
    counts = {r["cell"]: r["sites"] for r in coverage.cover_counts(cells, sites=disks).collect()}
    expected = {c: sum(hex_distance_int(c, s) <= 3 for s in set(candidates.values())) for c in weights}
    assert {c: n or 0 for c, n in counts.items()} == expected


def test_id_sets_split_large_groups(spark):
    pairs = combos(spark, [("a", f) for f in range(50)] + [("b", 1)], "cell string, facility_ID long")
    rows = coverage.cell_facilities(pairs).collect()
    ids = sorted(i for r in rows if r["cell"] == "a" for i in r["fac_ids"])
    assert ids == list(range(50)) and len([r for r in rows if r["cell"] == "a"]) > 1
    assert [(r["part"], r["fac_ids"]) for r in rows if r["cell"] == "b"] == [(12, [1])]
    assert len({(r["cell"], r["part"]) for r in rows}) == len(rows)


def test_fixture_coverage_numbers(spark):
    pairs = spark.createDataFrame([("R", 1, "f1", "a"), ("R", 1, "f1", "b"), ("R", 1, "f2", "b"), ("R", 1, "f2", "c")], "region string, distance_m int, facility_ID string, pop_ID string")
    pixels = spark.createDataFrame([("R", "a", 100.0), ("R", "b", 200.0), ("R", "c", 150.0), ("R", "d", 50.0)], "region string, ID string, population double")
    sums = pairs.join(pixels.withColumnRenamed("ID", "pop_ID"), ["region", "pop_ID"]).groupBy("facility_ID").agg(F.sum("population").alias("p"))
    assert {r["facility_ID"]: r["p"] for r in sums.collect()} == {"f1": 300.0, "f2": 350.0}
    first = pairs.filter("facility_ID = 'f1'")
    assert layers.pixels_without_access(pixels, first, [1]).agg(F.sum("population")).first()[0] == 200.0
    assert layers.pixels_with_access(pixels, first).agg(F.sum("population")).first()[0] == 300.0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_join_is_a_plain_join(spark, how):
    big = spark.range(2000).selectExpr("IF(id % 3 = 0, 7, id % 40) AS k", "id AS v").withColumn("k", F.expr("nullif(k, 11)"))
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(0, 30, 1)], "k long, name string")
    got = joins.hot_join(big, lookup, ["k"], how, hot_rows=100)
    expected = big.join(lookup, ["k"], how)
    assert got.select(expected.columns).exceptAll(expected).count() == 0 == expected.exceptAll(got.select(expected.columns)).count()
    assert "_piece" in got._jdf.queryExecution().analyzed().toString()
    calm = joins.hot_join(big, lookup, ["k"], how, hot_rows=10_000)
    assert "_piece" not in calm._jdf.queryExecution().analyzed().toString()


def test_density_bands(spark):
    pixels = spark.range(1, 101).selectExpr("'R' AS region", "CAST(id * 10 AS DOUBLE) AS population")
    counts = population.density_bands(pixels).groupBy("opacity").count().collect()
    sizes = {r["opacity"]: r["count"] for r in counts}
    assert sizes == {0.1: 25, 0.3: 25, 0.6: 25, 1.0: 25}
    many = spark.range(20_000).selectExpr("'R' AS region", "CAST((id * 7919) % 20011 AS DOUBLE) AS population")
    exact = {r["opacity"]: r["count"] for r in population.density_bands(many).groupBy("opacity").count().collect()}
    assert exact == {0.1: 5_000, 0.3: 5_000, 0.6: 5_000, 1.0: 5_000}


@pytest.mark.parametrize("buckets", [16, 4096])
def test_quantiles_are_exact(spark, buckets):
    rng = random.Random(5)
    values = {
        "even": [rng.uniform(0, 1) for _ in range(500)], "ties": [float(rng.randint(0, 3)) for _ in range(300)], "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(200)],
        "one": [7.5], "same": [2.0] * 50, "zero": [0.0, -0.0, 0.0], "ends": [-1.7e308, 1.7e308, 0.0], "close": [1.0 + i * 2.0**-52 for i in range(40)],
    }
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("even", None), ("even", float("nan")), ("even", float("inf")), ("none", None)]
    table = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["q"]): r["quantile"] for r in quantiles.exact_quantiles(table, ["g"], "v", shares, buckets).collect()}
    assert got == {(g, i): sorted(vs)[max(math.ceil(s * len(vs)), 1) - 1] for g, vs in values.items() for i, s in enumerate(shares)}
    assert quantiles.exact_quantiles(table.limit(0), ["g"], "v", shares).count() == 0


def test_polygon_join_scans_stored_cells(spark):
    """The scan filter of the pixel side holds no cell formula: it would run outside of compiled code."""
    area = queries.Area(spark, "/root/testdata/sf0.001")
    plan = population.clip_population(area.pixels, area.regions, fixtures.GRID)._jdf.queryExecution().toString()
    scan = [line for line in plan.splitlines() if "h3_index" in line and "Filter" in line]
    assert scan and not any("FLOOR" in line.upper() for line in scan)


def test_totals(spark):
    rows = [("a", 100.0), ("a", 200.0), ("b", 150.0), ("b", 50.0), ("c", 75.0)]
    df = spark.createDataFrame(rows, "region string, population double")
    assert {r["region"]: r["total_pop"] for r in population.totals_by(df, "region").collect()} == {"a": 300.0, "b": 200.0, "c": 75.0}
    assert tuple(population.totals(df).first()) == (575.0, 5)
    assert tuple(population.totals(df.limit(0)).first()) == (0.0, 0)


RING = "POLYGON ((24.1 -13.9, 27.3 -14.4, 28.2 -11.1, 25.0 -10.2, 24.1 -13.9), (25.5 -13, 26.5 -13, 26.5 -12, 25.5 -12, 25.5 -13))"


def test_polyfill_matches_ray_cast(spark):
    shape = spark.createDataFrame([("a", RING)], "name string, geometry_wkt string")
    box = spark.createDataFrame([("b", "POLYGON ((23 -15, 29 -15, 29 -9, 23 -9, 23 -15))")], "name string, geometry_wkt string")
    filled = polyfill.polyfill(shape, ["name"], GRID)
    every = polyfill.polyfill(box, ["name"], GRID).select("cell").crossJoin(shape.select(wkt_edges().alias("e")))
    inside = every.filter(edges_contain(F.col("e"), GRID.center_lon(F.col("cell")), GRID.center_lat(F.col("cell")), "half_open")).select("cell")
    assert filled.select("cell").exceptAll(inside).count() == 0 == inside.exceptAll(filled.select("cell")).count()
    assert 0 < filled.count() <= polyfill.max_cells(shape, GRID)
    tiny = spark.createDataFrame([("t", "POLYGON ((24 -13, 24.001 -13, 24.001 -12.999, 24 -13))")], "name string, geometry_wkt string")
    assert polyfill.polyfill(tiny, ["name"], GRID).count() in (0, 1)


def test_pixels_of_a_large_area_stay_in_place(spark):
    fine = HexGrid(8, -13.0)
    area = [("all", "POLYGON ((22 -18, 33 -18, 33 -8, 22 -8, 22 -18))"), ("part", RING)]
    regions = spark.createDataFrame(area, "region string, geometry_wkt string")
    pixels = population.with_cell(spark.range(2000).selectExpr("id", "21 + id % 131 / 10 AS lon", "-19 + id % 127 / 10 AS lat"), fine)
    assert not joins.fits_broadcast(polyfill.polyfill(regions, ["region"], fine), polyfill.max_cells(regions, fine))
    clipped = population.clip_population(pixels, regions, fine)
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_row" in plan and "SortMergeJoin" not in plan
    at = F.col("h3_index")
    located = pixels.crossJoin(regions.select("region", wkt_edges().alias("e")))
    expected = located.filter(edges_contain(F.col("e"), fine.center_lon(at), fine.center_lat(at), "half_open")).select("id", "region")
    got = clipped.select("id", "region")
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 0


@pytest.mark.parametrize(("boundary", "max_tests"), [("strict", 20), ("half_open", 1_000_000), ("inclusive", 20)])
def test_spatial_join_matches_ray_cast(spark, boundary, max_tests):
    rng = random.Random(5)
    # Lattice points hit edges and corners exactly.
    spots = [(i, rng.choice([24.0, 25.5, 26.0, 26.5, rng.uniform(24, 29)]), rng.choice([-13.0, -12.0, rng.uniform(-15, -10)])) for i in range(400)]
    points = spark.createDataFrame(spots, "id int, lon double, lat double")
    shapes = spark.createDataFrame([("a", RING), ("b", "POLYGON ((24 -13, 26 -13, 26 -12, 24 -12, 24 -13))")], "name string, geometry_wkt string")
    got = spatial_join.points_in_polygons(points, shapes, "id", ["name"], boundary=boundary, max_tests=max_tests)
    pairs = points.crossJoin(shapes.select("name", wkt_edges().alias("e")))
    expected = pairs.filter(edges_contain(F.col("e"), F.col("lon"), F.col("lat"), boundary)).select("id", "name")
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count()


def test_crowded_coast_is_split(spark):
    """Most points along a dense coastline on a small part of the extent: leaves there become small, results stay exact."""
    rng = random.Random(8)
    coast = [(10 + 2 * i / 3000 + rng.uniform(0, 2e-4), 5 + rng.uniform(0, 0.02)) for i in range(3000)]
    ring = [*coast, (12.5, 40.0), (60.0, 50.0), (9.0, 55.0), (9.5, 6.0)]
    text = lambda pts: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*pts, pts[0]]) + ")"
    shapes = [("land", f"POLYGON ({text(ring)}, {text([(20.0, 30.0), (21.0, 30.0), (21.0, 31.0)])})"), ("other", "MULTIPOLYGON (((11 4, 12 4, 12 6, 11 6, 11 4)), ((40 40, 41 40, 41 41, 40 41, 40 40)))")]
    shapes = spark.createDataFrame(shapes, "name string, geometry_wkt string")
    spots = [(i, 10 + 2 * rng.random(), 5 + 0.025 * rng.random()) for i in range(4000)] + [(4000 + i, rng.uniform(5, 65), rng.uniform(0, 60)) for i in range(500)]
    spots += [(5000 + i, *rng.choice(coast)) for i in range(50)] + [(6000, 20.5, 30.2), (6001, None, 1.0), (6000, 20.5, 30.2)]
    points = spark.createDataFrame(spots, "id int, lon double, lat double").repartition(4)
    work = joins.Workspace(spark)
    edges = work.save(polygon_edges(shapes, ["name"]), "edges")
    located = points.dropna().select("id", F.col("lon").alias("_px"), F.col("lat").alias("_py"))
    tree = quadtree.QuadTree(edges, ["name"], located, work, max_tests=20_000)
    leaves = tree.leaves.collect()
    assert max(r["_points"] * r["_edges"] for r in leaves if r["_level"] < quadtree.LEVELS) <= 20_000 < 4000 * 3000
    assert {r["_level"] for r in leaves} >= {1, 3} and sum(r["_points"] for r in leaves) == len(spots) - 1
    got = spatial_join.points_in_polygons(points, shapes, "id", ["name"], max_tests=20_000)
    pairs = points.distinct().crossJoin(shapes.select("name", wkt_edges().alias("e")))
    expected = pairs.filter(edges_contain(F.col("e"), F.col("lon"), F.col("lat"), "strict")).select("id", "name")
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 1500
    assert spatial_join.points_in_polygons(points.limit(0), shapes, "id", ["name"]).count() == 0
    assert spatial_join.points_in_polygons(points, shapes.limit(0), "id", ["name"]).count() == 0


def test_spatial_join_among_many_small_polygons(spark):
    """A point meets the polygons near it only, and is tested where it meets them (F13, F14)."""
    square = lambda x, y: f"POLYGON (({x + 0.1} {y}, {x + 0.9} {y}, {x + 0.9} {y + 0.8}, {x + 0.1} {y + 0.8}, {x + 0.1} {y}))"
    shapes = spark.createDataFrame([(x * 50 + y, square(x, y)) for x in range(50) for y in range(50)], "name long, geometry_wkt string")
    points = spark.range(20_000).selectExpr("id", "(id * 7919) % 100003 / 100003D * 50 AS lon", "(id * 104729) % 99991 / 99991D * 50 AS lat").cache()
    work = joins.Workspace(spark)
    spots = points.selectExpr("id", "lon AS _px", "lat AS _py")
    tree = quadtree.QuadTree(work.save(polygon_edges(shapes, ["name"]), "edges"), ["name"], spots, work)
    assert tree.leaves.selectExpr("sum(_points * _edges)").first()[0] <= 64 * 20_000
    assert tree.meet(spots).count() <= 8 * 20_000
    got = {tuple(r) for r in spatial_join.points_in_polygons(points.unionAll(points.limit(50)), shapes, "id", ["name"]).collect()}
    inside = "lon - floor(lon) > 0.1 AND lon - floor(lon) < 0.9 AND lat > floor(lat) AND lat - floor(lat) < 0.8"
    assert got == {tuple(r) for r in points.filter(inside).selectExpr("id", "floor(lon) * 50 + floor(lat)").collect()}
    assert {r["_local"] for r in tree.claims.filter("size(_sides) <> _local").collect()} == set()


def test_many_polygons_over_each_other(spark):
    """cells are not cut where that makes more claims than it saves tests; boxes are told apart by the join; matches of
    points with ids of their own are not compared, and the first polygon is found without its name."""
    shapes = spark.range(3000).selectExpr("id AS position", "'n' || id AS name", "(id * 7919) % 1009 / 1009D * 60 AS x", "(id * 104729) % 997 / 997D * 60 AS y")
    corner = lambda dx, dy: f"format_string('%.3f %.3f', x + {dx}, y + {dy})"
    ring = ", ', ', ".join(corner(*c) for c in ((0, 0), (10, 0), (10, 10), (0, 10), (0, 0)))
    shapes = shapes.selectExpr("position", "name", f"concat('POLYGON ((', {ring}, '))') AS geometry_wkt").cache()
    points = spark.range(4000).selectExpr("id", "(id * 7919) % 100003 / 100003D * 70 AS lon", "(id * 104729) % 99991 / 99991D * 70 AS lat").cache()
    work = joins.Workspace(spark)
    spots = points.selectExpr("id", "lon AS _px", "lat AS _py")
    tree = quadtree.QuadTree(work.save(polygon_edges(shapes, ["position"]), "edges"), ["position"], spots, work)
    assert tree.levels == [1] and tree.claims.count() < 20_000
    box = "_px BETWEEN _x0 AND _x1 AND _py BETWEEN _y0 AND _y1"
    assert tree.meet(spots).filter(f"NOT ({box})").count() == 0
    expected = points.crossJoin(shapes.select("position", wkt_edges().alias("e"))).filter(edges_contain(F.col("e"), F.col("lon"), F.col("lat"), "strict")).select("id", "position").cache()
    got = spatial_join.points_in_polygons(points, shapes, "id", ["position"])
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count() and got.count() > 100_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [id" not in plan
    first = spatial_join.first_polygon(points, shapes, "id", "name", "position")
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()
    least = {r["id"]: f"n{r['p']}" for r in expected.groupBy("id").agg(F.min("position").alias("p")).collect()}
    assert {r["id"]: r["district"] for r in first.collect()} == {i: least.get(i) for i in range(4000)}


def test_repeated_and_null_point_ids(spark):
    """matches of repeated ids, null ones too, are one row for each polygon; polygons of equal order keep their names."""
    points = spark.createDataFrame([(1, 0.5, 0.5), (1, 0.6, 0.5), (2, 1.5, 0.5), (None, 0.5, 0.5), (None, 1.5, 0.5), (3, 9.0, 9.0)], "id int, lon double, lat double")
    square = lambda x: f"POLYGON (({x} 0, {x + 1} 0, {x + 1} 1, {x} 1, {x} 0))"
    shapes = [("a", 5, square(0)), ("b", 5, square(0)), ("c", 7, square(1)), ("d", None, square(1)), ("e", 1, None), ("f", 1, " ")]
    shapes = spark.createDataFrame(shapes, "name string, position int, geometry_wkt string")
    got = spatial_join.points_in_polygons(points, shapes, "id", ["name"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "a"), (1, "b"), (2, "c"), (2, "d"), (None, "a"), (None, "b"), (None, "c"), (None, "d")]))
    named = lambda some: sorted((str(r["id"]), str(r["district"])) for r in spatial_join.first_polygon(points, some, "id", "name", "position").collect())
    assert named(shapes) == [("1", "a"), ("1", "a"), ("2", "c"), ("3", "None"), ("None", "None"), ("None", "None")]
    assert named(shapes.filter("name IN ('b', 'c', 'e')")) == [("1", "b"), ("1", "b"), ("2", "c"), ("3", "None"), ("None", "None"), ("None", "None")]


def test_texts_are_not_made_before_polygons_are_dealt(spark):
    """a condition on the text would be evaluated below the exchange, where a few tasks read a small table."""
    made = spark.range(100).repartition(4).selectExpr("id", "concat('POLYGON ((0 0, ', id, ' 0, 0 1, 0 0))') AS geometry_wkt")
    edges = polygon_edges(made, ["id"])
    below = edges._jdf.queryExecution().optimizedPlan().toString().split("Repartition")[1]
    assert "POLYGON" not in below and edges.count() == 300


def test_equal_names_in_two_provinces(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 0.5)], "id int, lon double, lat double")
    shapes = spark.createDataFrame([("P", "Same", 5, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"), ("Q", "Same", 3, "POLYGON ((0 0, 2 0, 2 1, 0 1, 0 0))")], "province string, LGU string, position int, geometry_wkt string")
    both = spatial_join.points_in_polygons(points, shapes, "id", ["province", "LGU"])
    assert sorted(map(tuple, both.collect())) == [(1, "P", "Same"), (1, "Q", "Same"), (2, "Q", "Same")]
    first = spatial_join.first_polygon(points, shapes, "id", "province", "position", keys=("LGU",))
    assert {r["id"]: r["district"] for r in first.collect()} == {1: "Q", 2: "Q"}


def test_first_polygon_and_unmatched(spark):
    points = spark.createDataFrame([(1, 24.5, -12.5), (2, 50.0, 50.0), (3, None, -12.0)], "id int, lon double, lat double")
    shapes = spark.createDataFrame([("z", 0, "POLYGON ((24 -13, 26 -13, 26 -12, 24 -12, 24 -13))"), ("a", 1, "POLYGON ((24 -13, 26 -13, 26 -12, 24 -12, 24 -13))")], "LGU string, pos int, geometry_wkt string")
    found = spatial_join.first_polygon(points, shapes, "id", "LGU", "pos")
    assert {r["id"]: r["district"] for r in found.collect()} == {1: "z", 2: None, 3: None}
    assert spatial_join.count_unmatched(found).first()["unmatched"] == 2


def test_grid_includes_the_boundary(spark):
    shape = spark.createDataFrame([("s", "POLYGON ((27.9 -15.1, 28.1 -15.1, 28.1 -14.9, 27.9 -14.9, 27.9 -15.1))"), ("t", "POLYGON ((1 1, 3 1, 2 2, 1 1))")], "region string, geometry_wkt string")
    grid = sites.grid_candidates(shape, 0.5, ["region"], GRID)
    assert {(r["longitude"], r["latitude"]) for r in grid.filter("region = 's'").collect()} == {(28.0, -15.0)}
    expected = {(1.0, 1.0), (1.5, 1.0), (2.0, 1.0), (2.5, 1.0), (1.5, 1.5), (2.0, 1.5), (2.5, 1.5)}
    assert {(r["longitude"], r["latitude"]) for r in grid.filter("region = 't'").collect()} == expected


def test_union_of_polygons(spark):
    """Inner borders go, holes stay, rings that touch in a vertex or lie in each other are kept apart."""
    box = lambda x, y, w=1, h=1: f"({x} {y}, {x + w} {y}, {x + w} {y + h}, {x} {y + h}, {x} {y})"
    back = lambda x, y: f"({x} {y}, {x} {y + 1}, {x + 1} {y + 1}, {x + 1} {y}, {x} {y})"
    shapes = [
        ("pair", f"POLYGON ({box(0, 0)})"), ("pair", f"POLYGON ({back(1, 0)})"),
        ("touch", f"MULTIPOLYGON (({box(0, 0)}), ({box(1, 1)}))"),
        *[("ring", f"POLYGON ({box(x, y)})") for x in range(3) for y in range(3) if (x, y) != (1, 1)],
        ("nested", f"POLYGON ({box(0, 0, 9, 9)}, {box(1, 1, 7, 7)})"), ("nested", f"POLYGON ({back(3, 3)})"),
        ("filled", f"POLYGON ({box(0, 0, 3, 3)}, {back(1, 1)})"), ("filled", f"POLYGON ({box(1, 1)})"), ("none", None), ("none", " "),
    ]
    shapes = spark.createDataFrame(shapes, "name string, geometry_wkt string").repartition(3)
    rings = dissolve.outline(shapes, ["name"]).collect()
    count = lambda name, hole: sorted([sum(1 for r in rings if (r["name"], r["ring"]) == (name, k)) for k in {r["ring"] for r in rings if r["name"] == name and r["hole"] == hole}])
    assert (count("pair", False), count("pair", True)) == ([6], [])
    assert (count("touch", False), count("touch", True)) == ([4, 4], [])
    assert (count("ring", False), count("ring", True)) == ([12], [4])
    assert (count("nested", False), count("nested", True)) == ([4, 4], [4])
    assert (count("filled", False), count("filled", True)) == ([4], [])
    assert {r["name"] for r in rings} == {"pair", "touch", "ring", "nested", "filled"}
    pair = sorted((r["seq"], r["x"], r["y"]) for r in rings if r["name"] == "pair")
    assert pair == [(1, 0, 0), (2, 1, 0), (3, 2, 0), (4, 2, 1), (5, 1, 1), (6, 0, 1)]
    texts = {r["name"]: r["geometry_wkt"] for r in dissolve.outline_wkt(dissolve.outline(shapes, ["name"]), ["name"]).collect()}
    assert texts["nested"] == "MULTIPOLYGON (((0 0, 9 0, 9 9, 0 9, 0 0), (1 1, 1 8, 8 8, 8 1, 1 1)), ((3 3, 4 3, 4 4, 3 4, 3 3)))"
    assert texts["filled"] == "MULTIPOLYGON (((0 0, 3 0, 3 3, 0 3, 0 0)))"


def test_facility_ids(spark):
    raw = spark.createDataFrame([(7, "A"), (8, "B")], "id long, name string")
    out = sites.facility_ids(raw, F.col("osm_id"))
    assert out.columns == ["osm_id", "name", "ID"] and {r["ID"] for r in out.collect()} == {"7_current", "8_current"}
    assert sites.facility_ids(out, F.col("osm_id")).columns == out.columns


def test_wide_names_and_same_district_name(spark):
    rows = [("R", 1, 1, "N", "A b", 10.0, 20.0, 50.0), ("R", 1, 1, "S", "A b", 30.0, 30.0, 100.0), ("R", 1, 1, "S", "A-b", 0.0, 0.0, 0.0)]
    curves = spark.createDataFrame(rows, "region string, distance_m int, p int, province string, LGU string, covered double, total double, access_pct double")
    assert equity.district_columns(curves) == {"A b": "lgu_A_b", "A-b": "lgu_A_b_dup"}
    wide = equity.wide_access(curves).first()
    assert (wide["lgu_A_b"], wide["lgu_A_b_dup"]) == (80.0, 0.0)
    assert equity.target_reached(curves, 50.0).first()["steps_needed"] is None
    assert equity.target_reached(curves, 50.0, populated_only=True).first()["steps_needed"] == 1
    assert {(r["province"], r["LGU"]) for r in equity.districts_below(curves, 90.0).collect()} == {("N", "A b"), ("S", "A-b")}


def test_sampling(spark):
    df = spark.range(3000).selectExpr("IF(id < 2900, 'big', 'small') AS g", "id AS ID")
    sample = layers.sample_exact(df, ["g"], "ID", 200)
    assert {r["g"]: r["count"] for r in sample.groupBy("g").count().collect()} == {"big": 200, "small": 100}
    least = lambda ids: sorted(ids, key=lambda i: hashlib.md5(f"{i}|1".encode()).hexdigest())[:200]
    assert {r["ID"] for r in sample.collect()} == {*least(range(2900)), *range(2900, 3000)}
    assert {r["ID"] for r in layers.sample_exact(df.repartition(40), ["g"], "ID", 200, slices=3).collect()} == {r["ID"] for r in sample.collect()}
    assert layers.sample_exact(df.limit(0), ["g"], "ID", 200).count() == 0
    assert layers.sample_rows(df.limit(0), 10).count() == 0
    assert layers.sample_rows(df, 5000).count() == 3000
    assert [layers.sample_size(n) for n in (0, 2000, 9000)] == [5000, 4000, 1000]


def test_sampling_scans_once_and_ranks_before_the_shuffle(spark, tmp_path):
    spark.range(3000).selectExpr("id % 2 AS g", "id AS ID").write.parquet(f"{tmp_path}/layer")
    sample = layers.sample_exact(spark.read.parquet(f"{tmp_path}/layer"), ["g"], "ID", 20)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 4
    assert sample.count() == 40


def test_lineage_cut_uses_the_named_folder(spark):
    assert joins.checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    work = joins.Workspace(spark)
    saved = work.save(spark.range(10), "t")
    assert saved.count() == 10
    work.close()


def test_joins_beyond_the_broadcast_bound(spark, monkeypatch):
    """The same answers when no lookup side may be broadcast."""
    spots = spark.range(300).selectExpr("id", "24 + id % 17 / 4 AS lon", "-14 + id % 13 / 4 AS lat", "1D AS population")
    shapes = spark.createDataFrame([("a", RING)], "region string, geometry_wkt string")
    pixels = population.with_cell(spots, GRID)

    def answers():
        inside = spatial_join.points_in_polygons(spots, shapes, "id", ["region"]).collect()
        return sorted(r["id"] for r in inside), sorted(r["id"] for r in population.clip_population(pixels, shapes, GRID).collect())

    expected = answers()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    assert answers() == expected and all(expected)


def small_tables(spark, folder, orders, suppliers, price=50_000.0):
    """A folder of tables: one region of one nation, orders and suppliers with the given keys."""
    spark.createDataFrame([(0, "AFRICA")], "r_regionkey long, r_name string").write.parquet(f"{folder}/region.parquet")
    nations = spark.createDataFrame([(i, f"NATION_{i}", 0) for i in (0, 5)], "n_nationkey long, n_name string, n_regionkey long")
    nations.write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(k, price) for k in orders], "o_orderkey long, o_totalprice double").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(k, f"S{k}") for k in suppliers], "s_suppkey long, s_name string").write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_wide_table_without_steps_has_the_columns_of_the_districts(spark, tmp_path):
    data = small_tables(spark, tmp_path, [1, 2], [1], price=0.0)
    for query in (queries.lgu_access_wide, queries.lgu_accessibility):
        wide = query(spark, data)
        assert [c for c in wide.columns if c.startswith("lgu_")] == ["lgu_NATION_0", "lgu_NATION_5"] and wide.count() == 0


def test_disks_are_dealt_over_tasks_by_the_rows_they_become(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 500)
    places = spark.createDataFrame([("R", str(i), cell(i % 5, 0)) for i in range(40)], "region string, ID string, cell long").coalesce(1)
    weights = spark.createDataFrame([("R", cell(q, r), 1) for q in range(-7, 12) for r in range(-7, 8)], "region string, cell long, w long")
    relation = coverage.coverage_cells(places, weights, (20_000, 50_000), GRID)
    rows = [r["count"] for r in relation.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 40 * (37 + 127) and max(rows) <= 1000
    sets = coverage.facility_cells(relation).select(F.spark_partition_id().alias("p"), F.size("cells").alias("n"))
    rows = [r["n"] for r in sets.groupBy("p").agg(F.sum("n").alias("n")).collect()]
    assert sum(rows) == 40 * (37 + 127) and max(rows) <= 1500


def test_pair_queries_ask_one_pixel_of_each_cell(spark, tmp_path, monkeypatch):
    made, whole = [], coverage.coverage_pairs
    monkeypatch.setattr(coverage, "coverage_pairs", lambda *args: made.append(whole(*args)) or made[-1])
    turn = 100003 * 99991  # keys apart by this share their place
    data = small_tables(spark, tmp_path, [k + i * turn for k in (500003, 14) for i in range(30)], [3])
    at = {r["h3_index"] for r in fixtures.pixels(spark, data).collect()}
    near = queries.pairs_to_cells(spark, data).collect()
    reached, others = queries.pixels_with_access(spark, data).collect(), queries.pixels_without_access(spark, data).collect()
    pixels = queries.Area(spark, data).aoi().count()
    assert len(reached) + len(others) == 3 * pixels and len(set(reached) | set(others)) == 3 * pixels
    assert near and all(0 < pairs.count() <= 2 * 3 * len(at) for pairs in made) and {r["cell"] for r in near} <= at


def test_parcels_and_lattice_points_are_dealt_by_their_work(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 128)
    data = small_tables(spark, tmp_path, [1], [1])
    customers = spark.createDataFrame([(k, f"C{k}", "BUILDING", 0) for k in range(40)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey long")
    customers.coalesce(1).write.parquet(f"{data}/customer.parquet")
    parcels = fixtures.parcels(spark, data)
    assert "Repartition 20, true" in parcels._jdf.queryExecution().optimizedPlan().toString()
    plan = sites.grid_candidates(parcels, 0.004, ["key"])._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.count("RepartitionByExpression") + line.count("Repartition ") for line in plan.splitlines()) >= 3


def test_pixel_pairs_are_dealt_by_the_pairs_they_become(spark, monkeypatch):
    """Few pixels of one cell become many pairs, more than one task's and one key's share (F2)."""
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_ROWS", 1000)
    monkeypatch.setattr(joins.hot_join, "__defaults__", tuple(1000 if d == 1_000_000 else d for d in joins.hot_join.__defaults__))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = coverage.coverage_pairs(
            spark.createDataFrame([("R", f"s{i}", cell(0, 0)) for i in range(40)], "region string, ID string, cell long"),
            spark.createDataFrame([("R", f"p{i}", cell(0, 0)) for i in range(50)], "region string, ID string, cell long"), (10_000,), GRID,
        )
        got = found.withColumn("_task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(tuple(r)[:4] for r in got) == sorted(("R", 10_000, f"s{i}", f"p{j}") for i in range(40) for j in range(50))
    assert len({r["_task"] for r in got}) > 1
