"""Grid, geometry, names: known values and properties."""

import math
import re

import pytest
from pyspark.sql import functions as F

from isoreach.functions import geometry as geo
from isoreach.functions import names, projection
from isoreach.functions.hexgrid import (
    HexGrid,
    disk_size,
    explode_disk,
    explode_disk_rows,
    hex_distance,
    hex_distance_int,
    k_rings,
    k_rings_col,
    per_distance,
)

GRID = HexGrid(8, -13.0)
SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
MULTI = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 0, 11 0, 11 1, 10 1, 10 0)))"


@pytest.mark.parametrize("distance,res,k", [(5000, 8, 11), (10000, 8, 22), (1000, 8, 3), (5000, 7, 5)])
def test_k_rings(spark, distance, res, k):
    assert k_rings(distance, res) == k
    row = spark.createDataFrame([(distance, res)], "d int, r int").select(k_rings_col(F.col("d"), F.col("r")).alias("k"))
    assert row.first()["k"] == k


@pytest.mark.parametrize("res", [3, 11])
def test_k_rings_rejects_other_resolutions(spark, res):
    with pytest.raises(ValueError, match="resolution must be 4-10"):
        k_rings(5000, res)
    bad = spark.createDataFrame([(5000, res)], "d int, r int").select(k_rings_col(F.col("d"), F.col("r")))
    with pytest.raises(Exception, match="resolution must be 4-10"):
        bad.collect()


def test_disk_is_symmetric_and_complete(spark):
    at = spark.createDataFrame([(k, 25.0 + k, -13.0 - k) for k in range(6)], "k int, lon double, lat double")
    at = at.withColumn("cell", GRID.cell("lon", "lat"))
    disk = explode_disk(at, "k").withColumn("back", hex_distance("disk_cell", "cell")).collect()
    for k in range(6):
        mine = [r for r in disk if r["k"] == k]
        assert len({r["disk_cell"] for r in mine}) == len(mine) == disk_size(k)
        assert all(r["ring"] == r["back"] == hex_distance_int(r["cell"], r["disk_cell"]) <= k for r in mine)
    runs = explode_disk_rows(at, "k").groupBy("k").agg(F.sum(F.expr("q_hi - q_lo + 1")).alias("n")).collect()
    assert {r["k"]: r["n"] for r in runs} == {k: disk_size(k) for k in range(6)}


def test_cell_center_is_in_its_cell(spark):
    at = spark.range(5000).selectExpr("22 + (id * 7919 % 10007) / 10007 * 11 AS lon", "-18 + (id * 104729 % 9973) / 9973 * 10 AS lat")
    at = at.withColumn("cell", GRID.cell("lon", "lat"))
    back = at.withColumn("x", GRID.center_lon(F.col("cell"))).withColumn("y", GRID.center_lat(F.col("cell"))).withColumn("again", GRID.cell("x", "y"))
    assert back.filter("cell != again").count() == 0
    # No other centre is nearer: a centre is within one edge of every point of its cell (projected metres).
    mx = (F.col("lon") - GRID.center_lon(F.col("cell"))) / GRID.dx * (3**0.5 * GRID.edge_m)
    my = (F.col("lat") - GRID.center_lat(F.col("cell"))) / GRID.dy * (1.5 * GRID.edge_m)
    assert back.select(F.max(F.sqrt(mx * mx + my * my)).alias("m")).first()["m"] <= GRID.edge_m * 1.000001


def test_per_distance(spark):
    rows = per_distance(spark.createDataFrame([("a",)], "region string"), [2000, 10000], GRID).collect()
    assert [tuple(r) for r in rows] == [("a", 2000, 5), ("a", 10000, 22)]


def test_null_coordinates(spark):
    df = spark.createDataFrame([(None, 1.0)], "lon double, lat double")
    row = df.select(GRID.cell("lon", "lat").alias("c"), geo.point_wkt(F.col("lon"), F.col("lat")).alias("w")).first()
    assert row["c"] is None and row["w"] is None


def test_point_text(spark):
    values = [(28.0, -15.0), (28.1, -15.1), (0.0001, 12345678.5), (-0.5, 0.0)]
    df = spark.createDataFrame(values, "lon double, lat double").withColumn("w", geo.point_wkt(F.col("lon"), F.col("lat")))
    assert [r["w"] for r in df.collect()] == ["POINT (28 -15)", "POINT (28.1 -15.1)", "POINT (0.0001 12345678.5)", "POINT (-0.5 0)"]
    back = df.select(geo.point_x(F.col("w")).alias("x"), geo.point_y(F.col("w")).alias("y")).collect()
    assert [tuple(r) for r in back] == values


def test_rings_and_holes(spark):
    df = spark.createDataFrame([(SQUARE,), (MULTI,), (None,), ("  ",)], "geometry_wkt string")
    rows = df.select(geo.wkt_rings().alias("r"), F.size(geo.wkt_edges()).alias("e")).collect()
    assert [[ring["hole"] for ring in r["r"]] for r in rows] == [[False, True], [False, True, False], [], []]
    assert [r["e"] for r in rows] == [8, 12, 0, 0]


def test_bounds_and_centroid(spark):
    df = spark.createDataFrame([(SQUARE,), (MULTI,)], "geometry_wkt string")
    rows = df.select(geo.polygon_bounds().alias("b"), geo.area_moments().alias("m")).collect()
    assert tuple(rows[1]["b"]) == (0.0, 0.0, 11.0, 4.0)
    assert rows[0]["m"]["area"] == pytest.approx(15) and rows[1]["m"]["area"] == pytest.approx(16)
    assert rows[0]["m"]["mx"] / rows[0]["m"]["area"] == pytest.approx((16 * 2 - 1.5) / 15)
    reversed_hole = SQUARE.replace("(1 1, 2 1, 2 2, 1 2, 1 1)", "(1 1, 1 2, 2 2, 2 1, 1 1)")
    same = spark.createDataFrame([(reversed_hole,)], "geometry_wkt string").select(geo.area_moments().alias("m")).first()
    assert same["m"]["area"] == pytest.approx(15)


@pytest.mark.parametrize(
    "x,y,half,strict,inclusive",
    [(0.5, 0.5, True, True, True), (1.5, 1.5, False, False, False), (0.0, 2.0, True, False, True), (4.0, 2.0, False, False, True), (1.0, 1.0, None, False, True), (9.0, 9.0, False, False, False)],
)
def test_point_in_polygon(spark, x, y, half, strict, inclusive):
    df = spark.createDataFrame([(SQUARE, x, y)], "geometry_wkt string, x double, y double").withColumn("e", geo.wkt_edges())
    got = df.select(
        *[geo.edges_contain(F.col("e"), F.col("x"), F.col("y"), b).alias(b) for b in ("half_open", "strict", "inclusive")]
    ).first()
    assert (got["strict"], got["inclusive"]) == (strict, inclusive)
    assert half is None or got["half_open"] == half


def test_geojson_text(spark):
    df = spark.createDataFrame(
        [("Point", "[28.0,-15.5]"), ("Polygon", "[[[0,0],[4.0,0],[4,4],[0,0]],[[1,1],[2,1],[2,2],[1,1]]]"), ("MultiPolygon", "[[[[0,0,7],[4,0,7],[4,4,7],[0,0,7]]]]")],
        "k string, c string",
    ).select(geo.geojson_wkt(F.col("k"), F.col("c")).alias("w"))
    texts = [r["w"] for r in df.collect()]
    assert texts == [
        "POINT (28 -15.5)",
        "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",
        "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)))",
    ]


@pytest.mark.parametrize(
    "raw,safe",
    [
        ("Lusaka", "lgu_Lusaka"), ("Kapiri Mposhi", "lgu_Kapiri_Mposhi"), ("Choma (East)", "lgu_Choma_East"),
        ("North-Western", "lgu_North_Western"), ("  Lusaka  ", "lgu_Lusaka"), ("Test--Name  (2)", "lgu_Test_Name_2"), ("123District", "lgu_123District"),
    ],
)
def test_sanitize(spark, raw, safe):
    assert spark.createDataFrame([(raw,)], "n string").select(names.sanitize_name(F.col("n")).alias("s")).first()["s"] == safe


def test_dedupe_columns(spark):
    assert names.dedupe_columns([]) == []
    assert names.dedupe_columns(["a", "b"]) == ["a", "b"]
    assert names.dedupe_columns(["Name", "name", "value"]) == ["Name", "name_dup", "value"]
    many = names.dedupe_columns(["ID", "id", "Id"])
    assert many[0] == "ID" and len({c.lower() for c in many}) == 3
    twice = spark.range(1).selectExpr("id AS a", "id AS b", "id + 1 AS a")
    assert names.drop_repeated_columns(twice).columns == ["a", "b"]


def test_table_names():
    extract = names.table_names("cat", "access", "zambia", "ZMB", "North-Western", 2025)
    assert extract["boundaries"] == "cat.access.wb_boundaries_zmb_north_western_province"
    assert extract["population"] == "cat.access.population_zmb_2025_north_western_province"
    assert names.table_names("cat", "access", "zambia", "ZMB", None, 2025)["facilities"] == "cat.access.health_facilities_zmb_osm"
    transform = names.table_names("cat", "access", "zambia", "ZMB", "Northern", 2025, 5000)
    assert transform["population_aoi"] == "cat.access.population_aoi_zmb_2025_northern_province_5km"
    assert transform["potential_coverage"] == "cat.access.potential_coverage_zmb_northern_province_5km"
    country = names.table_names("cat", "access", "zambia", "ZMB", None, 2025, 10000)
    assert country["lgu_accessibility"] == "cat.access.lgu_accessibility_results_zmb_10km"
    assert len(country) == 10


def test_combinations():
    assert names.combinations(["N", "S"], [5, 10]) == [("N", 5), ("N", 10), ("S", 5), ("S", 10)]
    assert names.combinations([], [5]) == names.combinations(None, [5]) == [(None, 5)]


def test_pct_and_mercator(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 0.0), (None, 5.0)], "a double, b double")
    assert [r[0] for r in df.select(names.pct(F.col("a"), F.col("b"))).collect()] == [33.33, 0.0, 0.0]
    p = spark.createDataFrame([(3117000.0, -1689200.0)], "x double, y double").select(geo.mercator_to_lonlat(F.col("x"), F.col("y")).alias("p")).first()["p"]
    assert p["lon"] == pytest.approx(28.0004, abs=1e-3) and p["lat"] == pytest.approx(-15.0002, abs=1e-2)


def meridian_arc(lat):
    """Metres from the equator along a meridian of WGS 84, by Simpson's rule over the radius of curvature."""
    e2, n = projection.FLATTENING * (2 - projection.FLATTENING), 2000
    h = math.radians(lat) / n
    curve = lambda t: projection.SEMI_MAJOR * (1 - e2) / (1 - e2 * math.sin(t) ** 2) ** 1.5
    return h / 3 * sum((1 if i in (0, n) else 4 if i % 2 else 2) * curve(i * h) for i in range(n + 1))


def test_transverse_mercator_is_true_on_its_meridian_and_conformal(spark):
    """These two properties define the projection; neither uses its series."""
    system = projection.utm(35)
    lats = [-79.0, -33.3, 0.0, 8.25, 61.0]
    on = spark.createDataFrame([(lat,) for lat in lats], "lat double").select(system.project(F.lit(27.0), F.col("lat")).alias("p")).collect()
    for lat, row in zip(lats, on, strict=True):
        assert row["p"]["x"] == pytest.approx(500_000, abs=1e-6) and row["p"]["y"] == pytest.approx(0.9996 * meridian_arc(lat), abs=1e-5)
    e2, step = projection.FLATTENING * (2 - projection.FLATTENING), 1e-4
    spots = [(24.1, -17.2), (30.5, 45.0), (33.0, -8.0), (27.0, 70.0)]
    around = [(a + i * step, b + j * step) for a, b in spots for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    got = [r["p"] for r in spark.createDataFrame(around, "lon double, lat double").coalesce(1).select(system.project(F.col("lon"), F.col("lat")).alias("p")).collect()]
    for i, (_, lat) in enumerate(spots):
        east, west, north, south = got[4 * i : 4 * i + 4]
        s = math.sin(math.radians(lat))
        along, across = projection.SEMI_MAJOR / math.sqrt(1 - e2 * s * s) * math.cos(math.radians(lat)), projection.SEMI_MAJOR * (1 - e2) / (1 - e2 * s * s) ** 1.5
        to_east = ((east["x"] - west["x"]) / along, (east["y"] - west["y"]) / along)
        to_north = ((north["x"] - south["x"]) / across, (north["y"] - south["y"]) / across)
        scale = math.hypot(*to_east)
        assert math.hypot(*to_north) == pytest.approx(scale, rel=1e-8)
        assert (to_east[0] - to_north[1]) / scale == pytest.approx(0, abs=1e-8) and (to_east[1] + to_north[0]) / scale == pytest.approx(0, abs=1e-8)


def test_projected_text_comes_back(spark):
    wkt = "MULTIPOLYGON (((24.5 -15, 30.25 -15, 30.25 -12.5, 24.5 -15)), ((26 -10, 27 -10, 27 -9, 26 -10), (26.5 -9.75, 26.75 -9.5, 26.75 -9.75, 26.5 -9.75)))"
    places = [tuple(map(float, pair.split())) for pair in re.findall(r"[-0-9.]+ [-0-9.]+", wkt)]
    at = spark.createDataFrame(places, "lon double, lat double").coalesce(1).select(projection.utm(35, south=True).project(F.col("lon"), F.col("lat")).alias("p")).collect()
    metres = iter([f"{r['p']['x']!r} {r['p']['y']!r} 1250.5" for r in at])
    rows = [(re.sub(r"[-0-9.]+ [-0-9.]+", lambda _: next(metres), wkt),), ("POINT (500000 10000000)",), (None,), ("",), ("POLYGON EMPTY",)]
    df = spark.createDataFrame(rows, "wkt string").coalesce(1)
    back = [r[0] for r in df.select(projection.wkt_to_lonlat(F.col("wkt"), 32735)).collect()]
    found = [tuple(map(float, pair.split())) for pair in re.findall(r"[-0-9.]+ [-0-9.]+", back[0])]
    assert found == [(pytest.approx(x, abs=1e-9), pytest.approx(y, abs=1e-9)) for x, y in places]
    assert re.sub(r"[-0-9.]+ [-0-9.]+", "", back[0]) == re.sub(r"[-0-9.]+ [-0-9.]+", "", wkt)
    assert back[1:] == ["POINT (27.0 0.0)", None, None, None]
    assert df.select(projection.wkt_to_lonlat(F.col("wkt"), 4326)).first()[0] == rows[0][0]
    one = df.limit(1).select(projection.to_lonlat(F.lit(3117000.0), F.lit(-1689200.0), 3857).alias("p"), projection.to_lonlat(F.lit(None).cast("double"), F.lit(1.0), 3857).alias("n")).first()
    assert one["p"]["lon"] == pytest.approx(28.0004, abs=1e-3) and one["n"] is None
    with pytest.raises(ValueError, match="2056"):
        projection.stages_to_degrees(2056)


def test_projection_keeps_the_digits_that_doubles_have(spark):
    """To fifty digits x is 43121954.9999999993 cm, and the nearest double is the whole number."""
    at = projection.utm(36, south=True).project(F.lit(32.35816925492235), F.lit(-15.678491064195779))
    assert spark.range(1).select(at.alias("p")).first()["p"]["x"] * 100 == 43121955.0
