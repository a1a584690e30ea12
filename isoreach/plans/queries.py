"""The query roster: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.functions import geometry as geo
from isoreach.functions import names, projection
from isoreach.functions.hexgrid import explode_disk, k_rings_col
from isoreach.operators import coverage, dissolve, equity, layers, mclp, polyfill, population, sites, spatial_join
from isoreach.operators.joins import Workspace
from isoreach.plans import fixtures as fx
from isoreach.plans.fixtures import COUNTRY, DISTANCES, GRID, SPACING
from isoreach.sources import features, raster, tables

# Fixed value: new sites per combination.
MAX_NEW = 55
TARGET = 90.0


# The picks of one session and folder (at most MAX_NEW rows per combination), shared by the queries that ask about steps.
_STEPS: dict[tuple, DataFrame] = {}


class Area:
    """The inputs of one run. Site and cell tables are written once and read by every later stage."""

    def __init__(self, spark: SparkSession, sf_dir: str, max_new: int = MAX_NEW, pixels: DataFrame | None = None):
        self.spark, self.sf_dir, self.max_new = spark, sf_dir, max_new
        self._own_pixels = pixels is not None
        self._pixels = fx.pixels(spark, sf_dir) if pixels is None else pixels
        self._work = Workspace(spark)
        self._stored: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stored:
            self._stored[name] = self._work.save(make(), name)
        return self._stored[name]

    @property
    def pixels(self) -> DataFrame:
        """Stored with their cells, as the population table of a run is: a polygon join on the formula of the cell itself
        puts that formula into the scan filter, outside of what the JIT compiles."""
        return self._once("pixels", lambda: self._pixels)

    @property
    def regions(self) -> DataFrame:
        return self._once("regions", lambda: fx.regions(self.spark, self.sf_dir).coalesce(1))

    @property
    def districts(self) -> DataFrame:
        return self._once("districts", lambda: fx.districts(self.spark, self.sf_dir).coalesce(1))

    def weights(self) -> DataFrame:
        """Pixels are summed to cells, and these are stored before polygons are joined, for the same reason."""
        cells = self._once("cells", lambda: population.population_by_cell(self._pixels))
        return self._once("weights", lambda: polyfill.with_polygon(cells, self.regions, ["region"], GRID).select("region", "cell", "w", "pixels"))

    def aoi(self) -> DataFrame:
        clipped = lambda: population.clip_population(self.pixels, self.regions, GRID)
        return self._once("aoi", lambda: clipped().withColumn("ID", F.concat(F.col("key").cast("string"), F.lit("_pop"))))

    def existing(self) -> DataFrame:
        facilities = fx.facilities(self.spark, self.sf_dir)
        within = lambda: sites.facilities_within(facilities, self.regions, ["region"])
        return self._once("existing", lambda: sites.place_sites(within(), GRID))

    def candidates(self) -> DataFrame:
        return self._once("candidates", lambda: sites.grid_candidates(self.regions, SPACING, ["region"], GRID))

    def covered(self) -> DataFrame:
        return coverage.covered_cells(self.existing(), self.candidates(), self.weights(), DISTANCES, GRID)

    def summary(self) -> DataFrame:
        return coverage.access_summary(self.covered())

    def steps(self) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, id(self.spark), self.sf_dir, self.max_new)
        done = self._stored if self._own_pixels else _STEPS
        if key not in done:
            args = self.weights(), self.existing(), self.candidates(), DISTANCES, GRID, self.max_new
            done[key] = mclp.site_steps(*args)
        return done[key]

    def curves(self) -> DataFrame:
        steps = self.steps()
        first = mclp.first_covering_step(steps, self.weights().select("region", "cell", "w"), self.existing(), DISTANCES, GRID)
        return equity.access_curves(first, steps, self.districts, self.regions, GRID)

    def wide(self) -> DataFrame:
        """Its columns are the districts', so that a run without any step has them too."""
        columns = equity.district_columns(equity.listed_districts(self.districts, self.regions, GRID))
        return equity.wide_access(self.curves(), columns)

    def located_steps(self) -> DataFrame:
        placed = mclp.new_sites(self.steps(), self.candidates()).withColumn(
            "_site", F.concat_ws("|", "region", F.col("distance_m").cast("string"), F.col("p").cast("string"))
        )
        return spatial_join.first_polygon(placed, self.districts, "_site", "LGU", "position", keys=("province",)).drop("_site")

    def coverage_existing(self) -> DataFrame:
        return coverage.coverage_cells(self.existing(), self.weights(), DISTANCES, GRID)

    def coverage_rows(self) -> int:
        return coverage.relation_rows(self.existing(), DISTANCES, GRID)

    def pairs(self) -> DataFrame:
        pixels = self.aoi().select("region", "ID", F.col("h3_index").alias("cell"))
        return coverage.coverage_pairs(self.existing(), pixels, DISTANCES, GRID)

    def stand_ins(self) -> DataFrame:
        return self._once("stand-ins", lambda: coverage.one_per_cell(self.aoi().withColumnRenamed("h3_index", "cell")))

    def reached_cells(self) -> DataFrame:
        """(region, distance_m, cell) of the pairs of one site and one pixel for each cell, which decide for all of the cell."""
        pairs = lambda: coverage.coverage_pairs(coverage.one_per_cell(self.existing()), self.stand_ins(), DISTANCES, GRID)
        cells = lambda: coverage.pairs_to_cells(pairs(), self.stand_ins()).select("region", "distance_m", "cell").distinct()
        return self._once("reached", cells)

    def banded(self) -> DataFrame:
        return population.density_bands(self.aoi())


def hex_cell(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = fx.table(spark, sf_dir, "orders").select(k.alias("key"), fx.key_lon(k).alias("lon"), fx.key_lat(k).alias("lat"))
    return population.with_cell(orders, GRID).select("key", "h3_index")


def hex_disk(spark, sf_dir):
    k = F.col("c_custkey")
    at = fx.table(spark, sf_dir, "customer").select(k.alias("key"), fx.key_lon(k).alias("lon"), fx.key_lat(k).alias("lat"))
    at = at.select("key", GRID.cell("lon", "lat").alias("cell"))
    return explode_disk(at, "key % 4").select("key", "disk_cell", "ring")


def k_rings(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").select("l_extendedprice", (F.lit(4) + F.col("l_linenumber") % 7).alias("resolution"))
    k = k_rings_col(F.col("l_extendedprice"), F.col("resolution"))
    return lines.groupBy("resolution", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def population_totals(spark, sf_dir):
    return population.totals(fx.pixels(spark, sf_dir))


def population_by_cell(spark, sf_dir):
    cells = population.population_by_cell(fx.pixels(spark, sf_dir))
    return cells.select("cell", population.from_micro(F.col("w")).alias("population"), "pixels")


def population_by_region(spark, sf_dir):
    return population.totals_by(Area(spark, sf_dir).aoi(), "region")


def population_aoi(spark, sf_dir):
    clipped = population.pixel_ids(Area(spark, sf_dir).aoi().drop("ID"), F.col("key"))
    return clipped.select("region", "ID", "xcoord", "ycoord", "population", "h3_index")


def raster_pixels(spark, sf_dir):
    """Orders as 32 x 32 tiles: 1,024 consecutive keys each, some pixels NaN or infinite."""
    k = F.col("o_orderkey")
    value = (F.floor(F.col("o_totalprice") / 1000) - 200).cast("float")
    value = F.when(k % 97 == 0, F.lit(float("nan"))).when(k % 89 == 0, F.lit(float("inf"))).otherwise(value)
    tile = F.floor(k / 1024).cast("int")
    tiles = (
        fx.table(spark, sf_dir, "orders")
        .groupBy(tile.alias("t"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), value.alias("v")))), lambda s: s["v"]).alias("values"))
        .select(
            F.floor(F.col("t") / 64).cast("int") * 32, (F.col("t") % 64) * 32, F.lit(32), "values"
        )
        .toDF("row_off", "col_off", "width", "values")
    )
    return raster.raster_pixels(tiles, 22.0, -8.0, 0.01, -0.01, GRID)


def opacity_bands(spark, sf_dir):
    return Area(spark, sf_dir).banded().select("region", "key", "opacity")


def polygon_edges(spark, sf_dir):
    return geo.polygon_edges(fx.parcels(spark, sf_dir), ["key"])


def polygon_bounds(spark, sf_dir):
    return fx.parcels(spark, sf_dir).select("key", geo.polygon_bounds().alias("b")).select("key", "b.*")


def polyfill_cells(spark, sf_dir):
    regions = fx.regions(spark, sf_dir).select(F.col("region").alias("name"), "geometry_wkt")
    districts = fx.districts(spark, sf_dir).select(F.col("LGU").alias("name"), "geometry_wkt")
    return polyfill.polyfill(regions.unionByName(districts), ["name"], GRID)


def polyfill_parcels(spark, sf_dir):
    """Many small polygons with holes and second parts, on a fine grid."""
    return polyfill.polyfill(fx.parcels(spark, sf_dir), ["key"], fx.FINE_GRID)


def grid_candidates_parcels(spark, sf_dir):
    found = sites.grid_candidates(fx.parcels(spark, sf_dir), fx.FINE_SPACING, ["key"], fx.FINE_GRID)
    return found.select("key", "ID", "longitude", "latitude")


def pixels_in_parcels(spark, sf_dir):
    """Spatial join of pixels with parcels; a pixel may lie in several."""
    points = fx.pixels(spark, sf_dir).select(F.col("key").alias("pixel"), "xcoord", "ycoord")
    return spatial_join.points_in_polygons(points, fx.parcels(spark, sf_dir), "pixel", ["key"], "xcoord", "ycoord")


def boundary_centroid(spark, sf_dir):
    def rounded(c, digits):
        return (F.floor(F.col(c) * 10**digits + 0.5) / 10**digits).alias(c)

    centers = layers.boundary_centers(fx.parcels(spark, sf_dir), ["key"])
    return centers.select("key", rounded("center_lon", 6), rounded("center_lat", 6), rounded("area", 9))


def boundary_select(spark, sf_dir):
    corrected = names.correct_names(fx.parcels(spark, sf_dir))
    return features.select_boundaries(corrected, "NATION_3", "MACHINERY").select("key", "ISO_A3", "NAM_1", "NAM_2")


def lgu_normalize(spark, sf_dir):
    return features.normalize_districts(names.correct_names(fx.parcels(spark, sf_dir)))


def name_corrections(spark, sf_dir):
    return names.correct_names(fx.parcels(spark, sf_dir)).groupBy("NAM_1").agg(F.count(F.lit(1)).alias("n"))


def sanitize_names(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(") -"), F.col("p_type"))
    label = names.region_label(F.concat(F.col("p_brand"), F.lit("-"), F.col("p_type")))
    return parts.select("p_partkey", names.sanitize_name(raw).alias("safe_name"), label.alias("label"))


def province_names(spark, sf_dir):
    return equity.province_names(features.select_districts(names.correct_names(fx.parcels(spark, sf_dir)), "NATION_3"))


def combinations(spark, sf_dir):
    combos = names.combinations_df(fx.parcels(spark, sf_dir), DISTANCES, "NAM_2", include_country=COUNTRY)
    return combos.withColumn("label", names.km_label(F.col("distance_m")))


def wkt_roundtrip(spark, sf_dir):
    k = F.col("o_orderkey")
    text = geo.point_wkt(fx.milli(fx.key_lon(k)), fx.milli(fx.key_lat(k)))
    points = fx.table(spark, sf_dir, "orders").select(k.alias("key"), text.alias("geom_wkt"))
    return points.select("key", "geom_wkt", geo.point_x(F.col("geom_wkt")).alias("lon"), geo.point_y(F.col("geom_wkt")).alias("lat"))


def boundaries_geojson(spark, sf_dir):
    """Parcels written as GeoJSON features and read back."""
    work = Workspace(spark)
    path = f"{work.root}/boundaries.geojson"
    features.write_geojson(names.correct_names(fx.parcels(spark, sf_dir)).drop("key"), path)
    return features.read_geojson(spark, path, ["ISO_A3", "NAM_0", "NAM_1", "NAM_2"])


def boundaries_collection(spark, sf_dir):
    """Parcels as collections with many features on a line, read in splits."""
    work = Workspace(spark)
    parcels = names.correct_names(fx.parcels(spark, sf_dir))
    features.write_geojson(parcels.drop("key"), f"{work.root}/features")
    lines = spark.read.text(f"{work.root}/features")
    crowds = lines.groupBy(F.pmod(F.xxhash64("value"), F.lit(40))).agg(F.collect_list("value").alias("_f"))
    framed = F.concat(F.lit('{"type": "FeatureCollection", "crs": {"properties": {}}, "features": ['), F.array_join("_f", ", "), F.lit("]}"))
    crowds.select(framed).write.text(f"{work.root}/collections.geojson")
    return features.read_geojson(spark, f"{work.root}/collections.geojson", ["ISO_A3", "NAM_0", "NAM_1", "NAM_2"])


def facilities_file(spark, sf_dir):
    """Facilities written as point features and loaded from the file."""
    path = f"{Workspace(spark).root}/facilities.geojson"
    points = fx.facilities(spark, sf_dir).select("ID", "name", geo.point_wkt(fx.milli(F.col("lon")), fx.milli(F.col("lat"))).alias("geometry_wkt"))
    features.write_geojson(points, path)
    return features.load_facilities(spark, "file", path).select("ID", "lon", "lat", F.col("properties")["name"].alias("name"))


def facilities_projected(spark, sf_dir):
    """Facilities written in metres of UTM zone 35 south and loaded back in degrees."""
    path = f"{Workspace(spark).root}/projected.geojson"
    at = projection.utm(35, south=True).project(fx.milli(F.col("lon")), fx.milli(F.col("lat")))
    placed = fx.facilities(spark, sf_dir).withColumn("_at", at)
    features.write_geojson(placed.select("ID", "name", geo.point_wkt(F.col("_at.x"), F.col("_at.y")).alias("geometry_wkt")), path)
    loaded = features.load_facilities(spark, "file", path, epsg=32735)
    return loaded.select("ID", fx.milli(F.col("lon")).alias("lon"), fx.milli(F.col("lat")).alias("lat"), F.col("properties")["name"].alias("name"))


def projected_points(spark, sf_dir):
    """Every pixel in whole centimetres of its own UTM zone, and whether it comes back within 1e-9 degrees."""
    zone = F.floor((F.col("xcoord") + 180) / 6).cast("int") + 1
    system = projection.utm(F.col("zone"), south=True)
    points = fx.pixels(spark, sf_dir).select("key", "xcoord", "ycoord", zone.alias("zone"))
    points = points.withColumn("at", system.project(F.col("xcoord"), F.col("ycoord"))).withColumn("back", system.unproject(F.col("at.x"), F.col("at.y")))
    returned = (F.abs(F.col("back.x") - F.col("xcoord")) < 1e-9) & (F.abs(F.col("back.y") - F.col("ycoord")) < 1e-9)
    centimetres = lambda c: F.floor(F.col(c) * 100).cast("long")
    return points.select("key", "zone", centimetres("at.x").alias("x_cm"), centimetres("at.y").alias("y_cm"), returned.alias("returned"))


def csv_append(spark, sf_dir):
    """Facilities written to CSV in two parts and read back."""
    path = f"{Workspace(spark).root}/facilities.csv"
    found = fx.facilities(spark, sf_dir).select("osm_id", "name", fx.milli(F.col("lon")).alias("lon"), fx.milli(F.col("lat")).alias("lat"))
    tables.save_csv(found.filter("osm_id % 3 = 0"), path)
    tables.save_csv(found.filter("osm_id % 3 <> 0"), path, mode="append")
    return tables.load_csv(spark, path, found.schema)


def unmatched_sites(spark, sf_dir):
    """How many pixels lie in no parcel."""
    points = fx.pixels(spark, sf_dir).select(F.col("key").alias("pixel"), F.col("xcoord").alias("lon"), F.col("ycoord").alias("lat"))
    return spatial_join.count_unmatched(spatial_join.first_polygon(points, fx.parcels(spark, sf_dir), "pixel", "NAM_2", "key"))


def reused_access(spark, sf_dir):
    """Catchments stored by region and distance in two runs: the second adds the country and a distance.

    ``run`` tells which run wrote a row; rows of the first stay as they are.
    """
    area, work = Area(spark, sf_dir), Workspace(spark)
    name = "parts_" + work.root.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work.root}/{name}'")
    regions = sorted(r["region"] for r in area.regions.select("region").collect())
    for run, (some, distances) in enumerate([([r for r in regions if r != COUNTRY], DISTANCES[:-1]), (regions, DISTANCES)], 1):

        def make(parts, run=run):
            plans = []
            for firsts, seconds in tables.rectangles(parts):
                existing, weights = (t.filter(F.col("region").isin(*firsts)) for t in (area.existing(), area.weights()))
                plans.append(coverage.facility_access(existing, weights, tuple(seconds), GRID).withColumn("run", F.lit(run)))
            return reduce(DataFrame.unionByName, plans)

        tables.materialize_parts(spark, make, f"{name}.access", {(r, d): "1" for r in some for d in distances}, ("region", "distance_m"))
    return spark.table(f"{name}.access").select("region", "distance_m", "ID", "pop_with_access", "run")


def _elements(spark, sf_dir):
    """Customers as hospital and clinic elements in JSON; some without coordinates, some in both lists."""
    k = F.col("c_custkey")
    at = F.struct(fx.milli(fx.key_lat(k)).alias("lat"), fx.milli(fx.key_lon(k)).alias("lon"))
    node = k % 7 != 0

    def listed(keep, name):
        element = F.struct(
            F.when(node, "node").otherwise("way").alias("type"),
            k.alias("id"),
            F.when(node, at["lat"]).alias("lat"),
            F.when(node, at["lon"]).alias("lon"),
            F.when(~node, at).alias("center"),
            F.when(name.isNotNull(), F.create_map(F.lit("name"), name)).alias("tags"),
        )
        lines = fx.table(spark, sf_dir, "customer").filter(keep).select(F.to_json(element).alias("value"), k.alias("pos"))
        return features.parse_elements(lines, keep=("pos",))

    hospitals = listed(k % 2 == 0, F.concat(F.lit("Hospital "), F.col("c_name")))
    clinics = listed(k % 3 == 0, F.when(k % 4 != 1, F.concat(F.lit("Clinic "), F.col("c_name"))))
    return features.merge_elements(hospitals, clinics)


def osm_elements(spark, sf_dir):
    return _elements(spark, sf_dir)


def facility_ids(spark, sf_dir):
    raw = _elements(spark, sf_dir).withColumnRenamed("osm_id", "id")
    return sites.facility_ids(raw, F.col("osm_id")).select("osm_id", "ID", "lon", "lat", "name")


def facilities_within(spark, sf_dir):
    return Area(spark, sf_dir).existing().select("region", "ID", "name", "lon", "lat", F.col("cell").alias("h3_index"))


def facilities_in_districts(spark, sf_dir):
    k = F.col("c_custkey")
    points = fx.table(spark, sf_dir, "customer").select(
        k.alias("key"), fx.milli(fx.key_lon(k)).alias("lon"), fx.milli(fx.key_lat(k)).alias("lat")
    )
    return spatial_join.points_in_polygons(points, fx.districts(spark, sf_dir), "key", ["province", "LGU"])


def grid_candidates(spark, sf_dir):
    return Area(spark, sf_dir).candidates().select("region", "ID", "longitude", "latitude", "cell")


def grid_candidates_districts(spark, sf_dir):
    return sites.grid_candidates(fx.districts(spark, sf_dir), 0.125, ["LGU"]).select("LGU", "ID", "longitude", "latitude")


def kmeans_candidates(spark, sf_dir):
    """A hundred centres for each region, from the pixels of its cells."""
    found = sites.kmeans_candidates(Area(spark, sf_dir).aoi(), 100, ["region"], GRID)
    return found.select("region", "ID", "longitude", "latitude", F.col("cell").alias("h3_index"))


def coverage_cells(spark, sf_dir):
    area = Area(spark, sf_dir)
    weights = area.weights()
    return coverage.coverage_cells(area.existing(), weights, DISTANCES, GRID).unionByName(
        coverage.coverage_cells(area.candidates(), weights, DISTANCES, GRID)
    )


def coverage_pairs(spark, sf_dir):
    return Area(spark, sf_dir).pairs()


def pairs_to_cells(spark, sf_dir):
    """From the pairs of one pixel for each cell: all pixels of a cell are in the same pairs."""
    area = Area(spark, sf_dir)
    pairs = coverage.coverage_pairs(area.existing(), area.stand_ins(), DISTANCES, GRID)
    return coverage.pairs_to_cells(pairs, area.stand_ins())


def facility_access(spark, sf_dir):
    area = Area(spark, sf_dir)
    found = coverage.facility_access(area.existing(), area.weights(), DISTANCES, GRID)
    return found.select("region", "distance_m", "ID", "pop_with_access")


def candidate_access(spark, sf_dir):
    area = Area(spark, sf_dir)
    found = coverage.facility_access(area.candidates(), area.weights(), DISTANCES, GRID)
    return found.select("region", "distance_m", "ID", "pop_with_access")


def cell_facilities(spark, sf_dir):
    area = Area(spark, sf_dir)
    found = coverage.cell_facilities(area.coverage_existing(), max_rows=area.coverage_rows())
    return found.select("region", "distance_m", "cell", "part", F.array_join("fac_ids", ",").alias("fac_ids"))


def facility_cells(spark, sf_dir):
    area = Area(spark, sf_dir)
    found = coverage.facility_cells(area.coverage_existing(), max_rows=area.coverage_rows())
    return found.select("region", "distance_m", "facility_ID", "part", F.array_join(F.col("cells").cast("array<string>"), ",").alias("cells"))


def access_summary(spark, sf_dir):
    return Area(spark, sf_dir).summary()


def district_population(spark, sf_dir):
    area = Area(spark, sf_dir)
    return equity.district_totals(equity.district_population(area.weights().select("region", "cell", "w"), area.districts, GRID))


def mclp_steps(spark, sf_dir):
    return Area(spark, sf_dir).steps()


def mclp_relation_steps(spark, sf_dir):
    """The greedy over the stored coverage relation instead of hexagon arithmetic."""
    area = Area(spark, sf_dir)
    weights, existing, candidates = area.weights(), area.existing(), area.candidates()
    relation = coverage.coverage_cells(
        existing.select("region", "ID", "cell").unionByName(candidates.select("region", "ID", "cell")), weights, DISTANCES, GRID
    )
    per_distance = lambda df: coverage.weights_per_distance(df, DISTANCES, GRID)
    return mclp.relation_steps(
        per_distance(weights), relation, per_distance(existing.select("region", "ID")), per_distance(candidates.select("region", "ID")), MAX_NEW
    )


def mclp_selected(spark, sf_dir):
    chosen = mclp.selected_facilities(Area(spark, sf_dir).steps())
    return chosen.select("region", "distance_m", "p", F.array_join("selected_facilities", ",").alias("selected"))


def lgu_access_long(spark, sf_dir):
    return Area(spark, sf_dir).curves()


def lgu_access_wide(spark, sf_dir):
    return Area(spark, sf_dir).wide()


def lgu_accessibility(spark, sf_dir):
    area = Area(spark, sf_dir)
    return equity.accessibility_table(area.wide(), area.located_steps(), area.existing(), area.weights())


def target_reached(spark, sf_dir):
    return equity.target_reached(Area(spark, sf_dir).curves(), TARGET, populated_only=True)


def districts_below_target(spark, sf_dir):
    return equity.districts_below(Area(spark, sf_dir).curves(), TARGET)


def site_district(spark, sf_dir):
    return Area(spark, sf_dir).located_steps().select("region", "distance_m", "p", "facility_id", "lat", "lon", "district")


def pareto_frontier(spark, sf_dir):
    area = Area(spark, sf_dir)
    return layers.pareto_frontier(area.summary(), area.steps(), area.existing(), area.candidates())


def _layer(spark, sf_dir, with_access):
    area = Area(spark, sf_dir)
    pixels = area.banded().withColumnRenamed("h3_index", "cell")
    layer = layers.layer_pixels(pixels, area.covered(), with_access, polyfill.max_cells(area.regions, GRID))
    return layer.select("region", "distance_m", "ID", "xcoord", "ycoord", "opacity")


def layer_with_access(spark, sf_dir):
    return _layer(spark, sf_dir, True)


def layer_without_access(spark, sf_dir):
    return _layer(spark, sf_dir, False)


def _by_pairs(spark, sf_dir, choose):
    area = Area(spark, sf_dir)
    return choose(area.aoi().withColumnRenamed("h3_index", "cell"), area.reached_cells()).select("region", "distance_m", "ID")


def pixels_with_access(spark, sf_dir):
    return _by_pairs(spark, sf_dir, layers.pixels_with_access)


def pixels_without_access(spark, sf_dir):
    return _by_pairs(spark, sf_dir, lambda pixels, pairs: layers.pixels_without_access(pixels, pairs, DISTANCES))


def layer_sample(spark, sf_dir):
    area = Area(spark, sf_dir)
    pixels = area.aoi().withColumnRenamed("h3_index", "cell")
    covered, bound = area.covered(), polyfill.max_cells(area.regions, GRID)
    both = [layers.layer_pixels(pixels, covered, flag, bound).withColumn("now", F.lit(flag)) for flag in (True, False)]
    sample = layers.sample_exact(both[0].unionByName(both[1]), ["region", "distance_m", "now"], "ID", 500)
    return sample.select("region", "distance_m", "now", "ID")


def facility_layer(spark, sf_dir):
    return layers.facility_layer(Area(spark, sf_dir).existing())


def dashboard_metadata(spark, sf_dir):
    area = Area(spark, sf_dir)
    rows = layers.dashboard_metadata(area.steps(), area.summary(), area.regions, area.districts, "Area", 2025, COUNTRY)

    def rounded(c):
        return F.floor(F.col(c) * 1e6 + 0.5) / 1e6

    return rows.withColumn("central_lat", rounded("central_lat")).withColumn("central_long", rounded("central_long"))


def country_outline(spark, sf_dir):
    """The districts' union: all inner borders cancel."""
    return dissolve.outline(fx.districts(spark, sf_dir), ["iso3"])


def strip_outlines(spark, sf_dir):
    """The union of each row of districts."""
    strips = fx.districts(spark, sf_dir).withColumn("strip", F.floor((100 - F.col("position")) / 5).cast("int"))
    return dissolve.outline(strips, ["strip"])


def parcel_outlines(spark, sf_dir):
    """Outlines of single parcels, holes and second parts included, as text."""
    return dissolve.outline_wkt(dissolve.outline(fx.parcels(spark, sf_dir), ["key"]), ["key"])


def _fresh(spark, sf_dir, since_last):
    """A run log from events: six regions, one distance per event type length."""
    user = F.col("user_id") % 6
    log = fx.table(spark, sf_dir, "events").select(
        F.when(user == 0, COUNTRY).otherwise(F.concat(F.lit("R"), user.cast("string"))).alias("region"),
        (F.length("event_type") * 1000).alias("distance_m"),
        F.col("ts").alias("written_at"),
    )
    since = log.agg((F.max("written_at") + F.expr(since_last)).alias("since")).first()["since"]
    return tables.fresh_combinations(log, since, COUNTRY).select("region", "distance_m", "tier")


def fresh_combinations(spark, sf_dir):
    return _fresh(spark, sf_dir, "INTERVAL -2 HOURS")


def fresh_combinations_none(spark, sf_dir):
    """Nothing is fresh: the country's combinations are shown."""
    return _fresh(spark, sf_dir, "INTERVAL 1 HOURS")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        hex_cell, hex_disk, k_rings, population_totals, population_by_cell, population_by_region, population_aoi,
        raster_pixels, opacity_bands, polygon_edges, polygon_bounds, polyfill_parcels, grid_candidates_parcels, pixels_in_parcels, boundary_centroid, boundary_select, lgu_normalize,
        name_corrections, sanitize_names, province_names, combinations, wkt_roundtrip, boundaries_geojson, osm_elements,
        facility_ids, facilities_within, facilities_in_districts, grid_candidates, grid_candidates_districts,
        kmeans_candidates, coverage_cells, coverage_pairs, pairs_to_cells, facility_access, candidate_access,
        cell_facilities, facility_cells, access_summary, district_population, mclp_steps, mclp_relation_steps,
        mclp_selected, lgu_access_long, lgu_access_wide, lgu_accessibility, target_reached, districts_below_target,
        site_district, pareto_frontier, layer_with_access, layer_without_access, pixels_with_access,
        pixels_without_access, layer_sample, facility_layer, dashboard_metadata, boundaries_collection, facilities_file, facilities_projected, projected_points, csv_append, unmatched_sites, reused_access, country_outline, strip_outlines, parcel_outlines, fresh_combinations,
        fresh_combinations_none,
    )
} | {"polyfill": polyfill_cells}
