"""Readers, writers, reuse, the run log, and the pipelines end to end on a small made-up country."""

import datetime
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from isoreach.functions.hexgrid import HexGrid
from isoreach.plans.pipeline import SETTINGS_OF, Pipeline, Settings
from isoreach.sources import features, raster, tables, versions


def square(x, y, w=1.0, h=1.0):
    return [[[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]]


def feature(props, kind, coordinates):
    return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": coordinates}}


def write(path, items, layout="lines"):
    if layout == "lines":
        path.write_text("\n".join(json.dumps(f) for f in items))
    else:
        path.write_text(json.dumps({"type": "FeatureCollection", "features": items}, indent=1))


@pytest.mark.parametrize("layout", ["lines", "collection"])
def test_boundaries(spark, tmp_path, layout):
    rows = [("ZMB", "Zambia", "Muchiga", square(0, 0)), ("ZMB", "Zambia", "Lusaka", square(1, 0)), ("MWI", "Malawi", "Central", square(5, 5))]
    write(tmp_path / "wb_admin1.geojson", [feature({"ISO_A3": i, "NAM_0": c, "NAM_1": p}, "Polygon", g) for i, c, p, g in rows], layout)
    loaded = features.load_boundaries(spark, str(tmp_path), 1, layout)
    assert {r["NAM_1"] for r in loaded.collect()} == {"Muchinga", "Lusaka", "Central"}
    assert features.select_boundaries(loaded, "ZMB", "Lusaka").first()["geometry_wkt"].startswith("POLYGON ((1")
    with pytest.raises(ValueError, match=r"there are \['Lusaka', 'Muchinga'\]"):
        features.select_boundaries(loaded, "ZMB", "Nowhere")
    with pytest.raises(ValueError, match="XXX"):
        features.select_boundaries(loaded, "XXX")
    with pytest.raises(ValueError, match="admin_level must be"):
        features.load_boundaries(spark, str(tmp_path), 3)
    with pytest.raises(FileNotFoundError):
        features.load_boundaries(spark, str(tmp_path), 2)
    with pytest.raises(ValueError, match="no district"):
        features.select_districts(loaded.withColumn("NAM_2", F.lit("x")), "XXX")


def test_osm(spark, tmp_path):
    hospitals = [
        {"type": "node", "id": 1, "lat": -15.0, "lon": 28.0, "tags": {"name": "H1", "amenity": "hospital"}},
        {"type": "way", "id": 2, "center": {"lat": -15.1, "lon": 28.1}, "tags": {"name": "H2"}},
        {"type": "node", "id": 3, "lat": -15.2, "lon": 28.2},
    ]
    clinics = [{"type": "node", "id": 1, "lat": 0.0, "lon": 0.0, "tags": {"name": "C1"}}, {"type": "node", "id": 4, "lat": -15.3, "lon": 28.3, "tags": {}}]
    paths = []
    for name, items in (("h", hospitals), ("c", clinics)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"elements": items}))
        paths.append(str(tmp_path / f"{name}.json"))
    found = {r["osm_id"]: r["name"] for r in features.load_facilities(spark, "osm", paths).collect()}
    assert found == {1: "H1", 3: None, 4: None}
    assert features.load_facilities(spark, "osm", paths, use_center=True).count() == 4
    with pytest.raises(ValueError, match="source must be"):
        features.load_facilities(spark, "web", paths)
    with pytest.raises(ValueError, match="path"):
        features.load_facilities(spark, "file", None)
    write(tmp_path / "f.geojson", [feature({"osm_id": "9", "name": "F"}, "Point", [28.5, -15.5])], "collection")
    row = features.load_facilities(spark, "file", str(tmp_path / "f.geojson")).first()
    assert (row["osm_id"], row["lon"], row["lat"]) == ("9", 28.5, -15.5)
    points = [feature({"ID": "own", "beds": "12"}, "Point", [28.5, -15.5]), feature({"name": "G"}, "Point", [28.6, -15.5]), feature({"name": "G"}, "Point", [28.7, -15.5])]
    write(tmp_path / "g.geojson", points, "collection")
    got = features.load_facilities(spark, "file", str(tmp_path / "g.geojson")).collect()
    assert len({r["ID"] for r in got}) == 3 and None not in {r["ID"] for r in got}
    assert {r["ID"]: r["properties"].get("beds") for r in got}["own"] == "12"


def test_geojson_that_does_not_parse_is_an_error(spark, tmp_path):
    rows = [feature({"name": n}, "Point", [28.5, -15.5]) for n in "ab"]
    write(tmp_path / "c.geojson", rows, "collection")
    assert features.read_geojson(spark, str(tmp_path / "c.geojson"), ["name"]).count() == 2
    (tmp_path / "bad.geojson").write_text('{"type": "Feature", "properties": {"name": "a"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        features.read_geojson(spark, str(tmp_path / "bad.geojson"), ["name"], "lines").count()
    (tmp_path / "none.geojson").write_text("hello\n")
    with pytest.raises(ValueError, match="no GeoJSON feature"):
        features.read_geojson(spark, str(tmp_path / "none.geojson"), ["name"])


@pytest.mark.parametrize("split", [40, 1 << 27])
def test_geojson_in_any_layout(spark, tmp_path, split):
    """Features side by side, over many lines, with braces and quotes in texts, and read in splits of a few bytes."""
    names = ['plain', 'a } { "b" [', 'back\\\\slash \\"', '}}}]', '"type": "Feature"', 'é ] \U0001d518', "", "two\nlines"]
    made = [feature({"name": n, "deep": {"x": [{"y": 1}, {}]}}, "Point", [i + 0.5, -i - 0.25]) for i, n in enumerate(names)]
    flat, tall = json.dumps(made[0]), lambda f: json.dumps(f, indent=2, ensure_ascii=False)
    crs = '"crs": {"type": "name", "properties": {"name": "urn:x"}}, "links": [{"a": {}}], "bbox": [1, 2]'
    layouts = {
        "mixed": '{"type": "FeatureCollection", ' + crs + ', "features": [' + flat + ", " + json.dumps(made[1]) + ",\n" + tall(made[2]) + "\n,\n" + ",".join(json.dumps(f) for f in made[3:]) + "]}\n",
        "oneline": json.dumps({"type": "FeatureCollection", "features": made}),
        "behind": json.dumps({"features": made, "type": "FeatureCollection", "more": {"a": [{}]}}, indent=1),
        "objects": " ".join(json.dumps(f) for f in made),
        "lines": "\n".join(json.dumps(f) for f in made),
    }
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        for layout, text in layouts.items():
            path = tmp_path / f"{layout}.geojson"
            path.write_text(text)
            got = features.read_geojson(spark, str(path), ["name"], "auto" if layout != "objects" else "collection").collect()
            assert sorted((r["name"], r["geometry_wkt"]) for r in got) == sorted((n, f"POINT ({i + 0.5} {-i - 0.25})") for i, n in enumerate(names)), layout
        (tmp_path / "cut.geojson").write_text(layouts["mixed"][: layouts["mixed"].index("back") + 20])
        with pytest.raises(Exception, match="(?i)malformed"):
            features.read_geojson(spark, str(tmp_path / "cut.geojson"), ["name"]).count()
        # Two features on one line are the only fault of this file; of several faults any may be met first.
        (tmp_path / "pair.geojson").write_text(flat + "\n" + flat + ", " + flat + "\n")
        with pytest.raises(Exception, match="more than one feature"):
            features.read_geojson(spark, str(tmp_path / "pair.geojson"), ["name"], "lines").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_raster_tiles(spark):
    tiles = spark.createDataFrame([(0, 0, 2, [1.0, 0.0, -9999.0, 4.0]), (0, 2, 2, [5.0, float("nan"), 7.0, None]), (1, 0, 1, [float("inf"), float("-inf")])], raster.TILE_SCHEMA)
    rows = raster.raster_pixels(tiles, 10.0, 20.0, 0.5, -0.5, HexGrid()).collect()
    assert {(r["xcoord"], r["ycoord"], r["population"]) for r in rows} == {(10.25, 19.75, 1.0), (10.75, 19.25, 4.0), (11.25, 19.75, 5.0), (11.25, 19.25, 7.0)}


def test_tables_and_csv(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    assert not tables.table_exists(spark, "store.none")
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, "store.none")
    geometry = spark.createDataFrame([(1, "POINT (28 -15)"), (2, None)], "id int, geometry_wkt string")
    tables.save_table(geometry, "store.points")
    tables.save_table(geometry.withColumn("more", F.lit(1)), "store.points")
    tables.save_table(geometry.withColumn("more", F.lit(1)), "store.points", mode="append")
    assert tables.load_geometry(spark, "store.points").filter("edges IS NULL").count() == 2
    assert tables.load_table(spark, "store.points").count() == 4
    clash = spark.range(1).toDF("ID").withColumn("x", F.lit(1)).toDF("ID", "Name").select("ID", "Name", F.lit(2).alias("name2")).toDF("ID", "Name", "name")
    tables.save_table(clash, "store.clash")
    assert tables.load_table(spark, "store.clash").columns == ["ID", "Name", "name_dup"]
    values = spark.createDataFrame([(1, 10), (2, 20)], "id int, value int")
    path = str(tmp_path / "csv")
    tables.save_csv(values, path)
    tables.save_csv(values.selectExpr("id + 2 AS id", "value * 2 AS value"), path, mode="append")
    assert tables.load_csv(spark, path, "id int, value int").agg(F.sum("value")).first()[0] == 90
    with pytest.raises(FileNotFoundError):
        tables.load_csv(spark, str(tmp_path / "none"), "id int")
    tables.ensure_dir(spark, str(tmp_path / "d" / "e"))
    assert tables.path_exists(spark, str(tmp_path / "d" / "e"))


def test_materialize_reuses_only_equal_parameters(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    calls = []

    def make():
        calls.append(1)
        return spark.range(len(calls)).toDF("id")

    assert tables.materialize(spark, make, "store.m", {"k": 1}).count() == 1
    assert tables.materialize(spark, make, "store.m", {"k": 1}).count() == 1
    assert tables.materialize(spark, make, "store.m", {"k": 2}).count() == 2
    assert tables.materialize(spark, make, "store.m", {"k": 2}, force=True).count() == 3
    tables.save_table(spark.range(9).toDF("id"), "store.m")
    assert tables.materialize(spark, make, "store.m", {"k": 2}).count() == 4


def broken(spark, n):
    """A table whose last task fails after the others have written."""
    return spark.range(n, numPartitions=4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_write_that_dies_leaves_the_old_version(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    count = lambda: spark.table("store.v").count()
    first = versions.replace_table(spark.range(3).toDF("id"), "store.v")
    seen = spark.table("store.v")
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken(spark, 1000), "store.v")
    with pytest.raises(Exception, match="lost"):
        tables.materialize(spark, lambda: broken(spark, 1000), "store.v", {"k": 1})
    assert count() == 3 and tables.stored_fingerprint(spark, "store.v") is None
    assert versions.versions(spark, "store.v") == [first] and versions.versions(spark, "store.v", complete=False) == []
    # A replacement may read what it replaces and may change the columns; a reader of before still ends.
    second = versions.replace_table(spark.table("store.v").withColumn("more", F.lit("x")), "store.v")
    assert spark.table("store.v").columns == ["id", "more"] and seen.count() == 3
    third = versions.replace_table(spark.range(8).toDF("id"), "store.v")
    assert versions.versions(spark, "store.v") == [second, third] and count() == 8
    versions.restore_version(spark, "store.v", second)
    assert versions.current_version(spark, "store.v") == second and count() == 3
    with pytest.raises(ValueError, match="not a complete version"):
        versions.restore_version(spark, "store.v", first)
    # What a killed session leaves is no version, and goes when told to.
    spark.range(5).write.saveAsTable("store.v__v9_dead")
    assert count() == 3 and versions.drop_versions(spark, "store.v", keep=0, unfinished=True) == ["store.v__v9_dead"]


def test_a_plain_table_becomes_a_version(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    spark.range(2).write.saveAsTable("store.old")
    assert versions.current_version(spark, "store.old") is None and versions.current_version(spark, "store.nowhere") is None
    now = versions.replace_table(spark.range(6).toDF("id"), "store.old")
    assert spark.table("store.old").count() == 6
    before, after = versions.versions(spark, "store.old")
    assert spark.table(before).count() == 2 and after == now


def test_appends_at_once_lose_nothing(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    combos = spark.createDataFrame([("N", 1000), ("S", 2000)], "region string, distance_m int")
    tables.log_run(spark, "store.log", "t", combos)
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: tables.log_run(spark, "store.log", f"t{i}", combos), range(12)))
    assert spark.table("store.log").count() == 26
    assert spark.table("store.log").select("table_name").distinct().count() == 13
    assert {c for c in spark.table("store.log").columns} == {"table_name", "region", "distance_m", "written_at", "batch_id"}
    batch = versions.append_batch(spark.range(3).toDF("id"), "store.batches", "monday")
    versions.append_batch(spark.range(4).toDF("id"), "store.batches", "tuesday")
    with pytest.raises(Exception, match="lost"):
        versions.append_batch(broken(spark, 1000), "store.batches", "tuesday")
    versions.append_batch(spark.range(5).toDF("id"), "store.batches", batch)
    assert {r["batch_id"]: r["count"] for r in spark.table("store.batches").groupBy("batch_id").count().collect()} == {"monday": 5, "tuesday": 4}
    tables.save_table(spark.range(1).toDF("id"), "store.plain")
    with pytest.raises(ValueError, match="not made by appending"):
        versions.append_batch(spark.range(1).toDF("id"), "store.plain")


def test_fresh_combinations(spark):
    def pick(entries, since):
        stamp = lambda h: datetime.datetime(2024, 1, 1, h)
        log = spark.createDataFrame([("t", r, d, stamp(h)) for r, d, h in entries], tables.RUN_LOG_SCHEMA)
        return {(r["region"], r["distance_m"]) for r in tables.fresh_combinations(log, stamp(since)).collect()}

    entries = [("Country", 1, 1), ("Country", 2, 1), ("N", 1, 2), ("N", 1, 5)]
    assert pick(entries, 4) == {("N", 1)}
    assert pick(entries, 9) == {("Country", 1), ("Country", 2)}
    assert pick([("S", 2, 1), ("N", 2, 1), ("N", 1, 1)], 9) == {("N", 1)}
    assert pick([], 9) == set()


def test_pipeline(spark, tmp_path):
    """Two provinces of two districts each; tiles of 8 x 8 pixels over them."""
    iso = {"ISO_A3": "TST", "NAM_0": "Testland", "WB_REGION": "X", "pop": 7}
    write(tmp_path / "wb_admin0.geojson", [feature(iso, "Polygon", square(20.0, -10.0, 2.0, 1.0))])
    write(tmp_path / "wb_admin1.geojson", [feature({**iso, "NAM_1": n}, "Polygon", square(20.0 + i, -10.0)) for i, n in enumerate(["East", "West"])])
    parts = [("East", "A"), ("East", "B"), ("West", "A"), ("West", "C d")]
    write(tmp_path / "wb_admin2.geojson", [feature({**iso, "NAM_1": p, "NAM_2": d}, "Polygon", square(20.0 + i * 0.5, -10.0, 0.5)) for i, (p, d) in enumerate(parts)])
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [{"id": 5, "lat": -9.55, "lon": 20.22, "tags": {"name": "H"}}, {"id": 6, "lat": 40.0, "lon": 20.0, "tags": {}}]}))
    tiles = spark.createDataFrame([(r * 8, c * 8, 8, [float((7 * r + 3 * c + i) % 5) for i in range(64)]) for r in range(5) for c in range(10)], raster.TILE_SCHEMA)

    spark.sql("CREATE DATABASE IF NOT EXISTS tst")
    settings = Settings("tst", "Testland", "TST", resolution=6, ref_lat=-9.5, distances_m=(5000, 20000), spacing=0.2, max_new=4, with_pairs=True)
    run = Pipeline(spark, settings)
    pixels = run.extract_population(tiles, 20.0, -9.0, 0.025, -0.025)
    run.extract_boundaries(str(tmp_path))
    assert features.reference_latitude(features.load_boundaries(spark, str(tmp_path), 0), "TST") == pytest.approx(-9.5)
    run.extract_facilities("osm", str(tmp_path / "osm.json"))
    run.run()

    # Facilities carry every property of their boundary.
    described = {r["region"]: r["attributes"] for r in run.table("health_facilities").collect()}
    assert described["East"] == {"ISO_A3": "TST", "NAM_0": "Testland", "WB_REGION": "X", "pop": "7", "NAM_1": "East"} and "NAM_1" not in described["Country"]
    assert {(r["region"], r["ID"]) for r in run.table("health_facilities").collect()} == {("Country", "5_current"), ("East", "5_current")}
    summary = {(r["region"], r["distance_m"]): r for r in run.table("access_summary").collect()}
    assert len(summary) == 6
    total = pixels.agg(F.sum("population")).first()[0]
    assert summary["Country", 5000]["total_population"] <= total
    assert summary["West", 5000]["current_access"] == 0.0
    # Cell totals equal pixel totals, and pixel pairs give the same catchments.
    aoi = run.table("population_aoi")
    by_region = {r["region"]: r["p"] for r in aoi.groupBy("region").agg(F.sum("population").alias("p")).collect()}
    assert by_region["Country"] == summary["Country", 5000]["total_population"]
    pairs = run.table("facilities_coverage").join(aoi.select("region", F.col("ID").alias("pop_ID"), "population"), ["region", "pop_ID"])
    from_pairs = {(r["region"], r["distance_m"], r["facility_ID"]): r["p"] for r in pairs.groupBy("region", "distance_m", "facility_ID").agg(F.sum("population").alias("p")).collect()}
    access = {(r["region"], r["distance_m"], r["ID"]): r["pop_with_access"] for r in run.table("facilities_h3").collect()}
    assert {k: v for k, v in access.items() if v > 0} == from_pairs

    results = run.table("lgu_accessibility_results")
    assert {"lgu_A", "lgu_C_d", "lgu_B"} <= set(results.columns)
    frontier = run.frontier().collect()
    for combo, row in summary.items():
        rates = [r["access_pct"] for r in frontier if (r["region"], r["distance_m"]) == combo]
        assert rates == sorted(rates) and rates[0] == row["current_access"] and rates[-1] <= row["max_access"]
    dashboard = run.table("base_dashboard_data").collect()
    assert {r["province"] for r in dashboard} == {None, "East", "West"} and dashboard[0]["central_long"] == pytest.approx(21.0)
    reached, below = run.targets()
    assert reached.count() == 6 and below.count() >= 1

    found = run.map_layers(samples=None)
    both = found["with_access"].filter("distance_m = 20000").count() + found["without_access"].filter("distance_m = 20000").count()
    assert both == aoi.count()
    assert run.map_layers(samples=5_000)["with_access"].count() > 0
    assert run.fresh(datetime.datetime(2020, 1, 1)).count() == 6
    views = run.publish_views()
    assert "spark_catalog.tst.lgu_accessibility_results_tst_east_province_5km" in views
    assert spark.table("tst.facilities_h3_tst_20km").count() == 1
    assert len(views) == len(set(views)) == 3 * 2 + 3 * 2 * 6 + 2  # by region, by region and distance, for all
    customary = {
        "wb_boundaries_tst_east_province": "ISO_A3 NAM_0 NAM_1 geometry_wkt", "wb_boundaries_lgu_testland": "province LGU geometry_wkt",
        "population_tst_2025": "xcoord ycoord population h3_index", "population_aoi_tst_2025_5km": "xcoord ycoord population h3_index geom_wkt row_id ID opacity",
        "facilities_h3_tst_east_province_5km": "osm_id lat lon name NAM_1 geom_wkt geometry_wkt ID h3_index pop_with_access",
        "potential_locations_tst_20km": "ID longitude latitude lon lat geom_wkt h3_index pop_with_access", "facilities_coverage_tst_20km": "facility_ID pop_ID",
        "lgu_accessibility_results_tst_5km": "total_facilities new_facility district lat lon h3_index total_population_access_pct lgu_A",
    }
    lacking = {v: set(c.split()) - set(spark.table(f"tst.{v}").columns) for v, c in customary.items()}
    assert not any(lacking.values()), lacking
    assert spark.table("tst.wb_boundaries_tst_east_province").first()["NAM_1"] == "East"

    marks = lambda: {k: tables.stored_fingerprint(spark, settings.table(k)) for k in SETTINGS_OF}
    files = lambda k: sorted(spark.table(settings.table(k)).inputFiles())
    before, written = marks(), {k: files(k) for k in SETTINGS_OF}
    again = Pipeline(spark, replace(settings, target_pct=50.0))
    again.run()
    assert marks() == before and {k: files(k) for k in SETTINGS_OF} == written
    # Another facility file concerns the facilities and what follows from them, nothing else.
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [{"id": 5, "lat": -9.55, "lon": 20.22, "tags": {}}, {"id": 7, "lat": -9.5, "lon": 21.5, "tags": {}}]}))
    again.extract_facilities("osm", str(tmp_path / "osm.json"))
    again.run()
    changed = {k for k, mark in marks().items() if mark != before[k]}
    assert changed == {"health_facilities", "facilities_h3", "covered_cells", "access_summary", "facilities_coverage", "mclp_steps", "lgu_access", "lgu_accessibility_results", "base_dashboard_data"}
    assert again.table("facilities_h3").filter("ID = '7_current'").count() > 0

def test_parts_are_computed_and_written_alone(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS parts")
    asked = []

    def make(parts):
        asked.append(parts)
        return spark.createDataFrame([(v, region, d) for region, d in parts for v in range(d) if region != "empty"], "v long, region string, distance_m int")

    def bring(wanted, **options):
        written = tables.materialize_parts(spark, make, "parts.t", wanted, ("region", "distance_m"), **options)
        assert {tuple(r) for r in spark.table("parts.t").select("v", "region", "distance_m").collect()} == {(v, region, d) for region, d in wanted for v in range(d) if region != "empty"}
        assert tables.part_marks(spark, "parts.t") == wanted
        return written

    files = lambda part: sorted(f for f in spark.table("parts.t").inputFiles() if part in f)
    first = {("Côte d'Or", 2): "a", ("N\\x", 3): "b", ("empty", 2): "c"}
    assert bring(first) == sorted(first)
    held = files("distance_m=2")
    assert bring(first) == [] and len(asked) == 1
    # Another distance for one region, then a changed part: only they are computed, and the files of others stay.
    assert bring({**first, ("N\\x", 5): "d"}) == [("N\\x", 5)] == asked[-1]
    assert files("distance_m=2") == held
    assert bring({**first, ("N\\x", 5): "e"}) == [("N\\x", 5)] and files("distance_m=2") == held
    # A part that is not wanted any more goes; what an interrupted run left behind is not taken for a result.
    assert bring(first) == [] and not files("distance_m=5")
    tables._drop_parts(spark, "parts.t", ("region", "distance_m"), [("empty", 2)])
    spark.sql("INSERT INTO parts.t PARTITION (region='empty', distance_m=2) VALUES (77)")
    assert bring(first) == [("empty", 2)]
    assert bring(first, force=True) == sorted(first)
    # Other columns: everything anew.
    plain_make = make
    wider = lambda parts: plain_make(parts).withColumn("w", F.lit(1))
    assert tables.materialize_parts(spark, wider, "parts.t", {**first, ("Z", 1): "z"}, ("region", "distance_m")) == sorted([*first, ("Z", 1)])
    assert spark.table("parts.t").filter("w = 1").count() == 6


def test_rectangles():
    assert tables.rectangles([("a", 1), ("a", 2), ("b", 1), ("c", 2), ("c", 1)]) == [(["b"], [1]), (["a", "c"], [1, 2])]
    assert tables.rectangles([]) == []


def test_content_marks(spark):
    rows = [("a", 1, {"k": "v"}), ("a", 2, None), ("b", 1, {})]
    schema = "region string, n int, m map<string,string>"
    one = tables.content_marks(spark.createDataFrame(rows, schema).repartition(3), ["region"])
    two = tables.content_marks(spark.createDataFrame(rows[::-1], schema), ["region"])
    other = tables.content_marks(spark.createDataFrame([*rows, rows[0]], schema), ["region"])
    assert one == two and one[("a",)] != other[("a",)] and one[("b",)] == other[("b",)]


def test_pipeline_adds_a_distance_and_a_province(spark, tmp_path):
    """Only the new parts are computed and written, and the tables are those of a run from nothing."""
    iso = {"ISO_A3": "ADD", "NAM_0": "Addland"}
    write(tmp_path / "wb_admin0.geojson", [feature(iso, "Polygon", square(20.0, -10.0, 2.0, 1.0))])
    write(tmp_path / "wb_admin1.geojson", [feature({**iso, "NAM_1": n}, "Polygon", square(20.0 + i, -10.0)) for i, n in enumerate(["East", "O'West"])])
    # The same district name in two provinces, the later one first in the file.
    write(tmp_path / "wb_admin2.geojson", [feature({**iso, "NAM_1": p, "NAM_2": d}, "Polygon", square(20.0 + i, -10.0)) for i, (p, d) in [(1, ("O'West", "Same")), (0, ("East", "Same"))]])
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [{"id": 5, "lat": -9.55, "lon": 20.22, "tags": {"name": "H"}}, {"id": 6, "lat": -9.5, "lon": 21.5, "tags": {}}]}))
    tiles = spark.createDataFrame([(r * 8, c * 8, 8, [float((7 * r + 3 * c + i) % 5) for i in range(64)]) for r in range(5) for c in range(10)], raster.TILE_SCHEMA)

    def go(database, **changes):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        run = Pipeline(spark, replace(Settings(database, "Addland", "ADD", resolution=6, ref_lat=-9.5, distances_m=(5000, 20000), spacing=0.3, max_new=3, provinces=("East",)), **changes))
        run.extract_population(tiles, 20.0, -9.0, 0.025, -0.025)
        run.extract_boundaries(str(tmp_path))
        run.extract_facilities("osm", str(tmp_path / "osm.json"))
        run.run()
        return run

    by_part = ("facilities_h3", "potential_locations", "covered_cells", "access_summary", "mclp_steps", "lgu_access", "lgu_accessibility_results")
    first = go("adds")
    assert all(len(first.written[k]) == 4 for k in by_part)
    files = {k: set(first.table(k).inputFiles()) for k in by_part}
    wider = go("adds", distances_m=(5000, 10000, 20000))
    assert all(wider.written[k] == [("Country", 10000), ("East", 10000)] for k in by_part) and not wider.written["population_cells"] and not wider.written["candidates"]
    more = go("adds", distances_m=(5000, 10000, 20000), provinces=("East", "O'West"))
    assert all(more.written[k] == [("O'West", d) for d in (5000, 10000, 20000)] for k in by_part)
    assert more.written["population_cells"] == more.written["candidates"] == more.written["health_facilities"] == [("O'West",)]
    assert all(files[k] <= set(more.table(k).inputFiles()) for k in by_part)
    whole = go("addsfresh", distances_m=(5000, 10000, 20000), provinces=("East", "O'West"))
    for k in (*by_part, "population_cells", "health_facilities", "candidates", "base_dashboard_data"):
        columns = whole.table(k).columns
        assert sorted(map(str, more.table(k).select(*columns).collect())) == sorted(map(str, whole.table(k).collect())), k
    log = more.table("run_log").filter("table_name = 'lgu_accessibility_results'")
    assert log.count() == 4 + 2 + 3
    # A facility in the east concerns the country and the east.
    (tmp_path / "osm.json").write_text(json.dumps({"elements": [{"id": 5, "lat": -9.55, "lon": 20.22, "tags": {"name": "H"}}, {"id": 6, "lat": -9.5, "lon": 21.5, "tags": {}}, {"id": 7, "lat": -9.2, "lon": 20.8, "tags": {}}]}))
    moved = go("adds", distances_m=(5000, 10000, 20000), provinces=("East", "O'West"))
    assert moved.written["covered_cells"] == [(r, d) for r in ("Country", "East") for d in (5000, 10000, 20000)] and not moved.written["potential_locations"]
    # Fewer distances: the other parts go, nothing is computed.
    fewer = go("adds", distances_m=(5000,), provinces=("East", "O'West"))
    assert not any(fewer.written.values()) and {r[0] for r in fewer.table("access_summary").select("distance_m").collect()} == {5000}


def test_pipeline_with_clusters(spark, tmp_path):
    """Candidates of all regions from one clustering."""
    iso = {"ISO_A3": "KMS", "NAM_0": "K"}
    write(tmp_path / "wb_admin0.geojson", [feature(iso, "Polygon", square(20.0, -10.0, 2.0, 1.0))])
    write(tmp_path / "wb_admin1.geojson", [feature({**iso, "NAM_1": n}, "Polygon", square(20.0 + i, -10.0)) for i, n in enumerate(["East", "West"])])
    write(tmp_path / "wb_admin2.geojson", [feature({**iso, "NAM_1": "East", "NAM_2": "D"}, "Polygon", square(20.0, -10.0, 2.0, 1.0))])
    tiles = spark.createDataFrame([(r * 8, c * 8, 8, [1.0] * 64) for r in range(5) for c in range(10)], raster.TILE_SCHEMA)
    spark.sql("CREATE DATABASE IF NOT EXISTS kms")
    run = Pipeline(spark, Settings("kms", "K", "KMS", resolution=6, ref_lat=-9.5, potential_type="kmeans", n_clusters=9))
    run.extract_population(tiles, 20.0, -9.0, 0.025, -0.025)
    run.extract_boundaries(str(tmp_path))
    run.prepare()
    found = run.table("candidates").groupBy("region").agg(F.count("*").alias("n"), F.min("longitude").alias("lo"), F.max("longitude").alias("hi")).collect()
    assert {r["region"]: r["n"] for r in found} == {"Country": 9, "East": 9, "West": 9}
    assert all(20.0 < r["lo"] < r["hi"] < 22.0 for r in found) and next(r for r in found if r["region"] == "West")["lo"] > 21.0
