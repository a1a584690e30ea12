"""The two pipelines end to end: files to tables, tables to answers.

Every region and distance is handled in the same plans; ``region`` and ``distance_m`` are columns, and
result tables are partitioned by them. A stage is reused while its own settings, its inputs and the
stages before it are unchanged, and it is reused by part: another distance or region is computed and
written alone, and a change of facilities runs again only the regions whose facilities it changed.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.functions import names
from isoreach.functions.hexgrid import HexGrid
from isoreach.operators import coverage, equity, layers, mclp, population, sites, spatial_join
from isoreach.operators.coverage import COMBO
from isoreach.operators.joins import Workspace, lookup_join
from isoreach.sources import features, raster, tables


@dataclass(frozen=True)
class Settings:
    database: str
    country: str
    iso3: str
    year: int = 2025
    resolution: int = 8
    # The latitude at which cells have their nominal width, see ``features.reference_latitude``; it has no default.
    ref_lat: float = field(kw_only=True)
    # Distances, lattice step, cluster count, number of new sites and target rate.
    distances_m: tuple[int, ...] = (2000, 4000, 5000, 10000)
    spacing: float = 0.03
    n_clusters: int = 100
    max_new: int = 55
    target_pct: float = 90.0
    potential_type: str = "grid"
    provinces: tuple[str, ...] = ()
    include_country: bool = True
    with_pairs: bool = False
    force: bool = False

    @property
    def grid(self) -> HexGrid:
        return HexGrid(self.resolution, self.ref_lat)

    @property
    def country_region(self) -> str:
        return "Country"

    def table(self, key: str) -> str:
        return f"{self.database}.{key}_{self.iso3.lower()}"


GRID_SETTINGS = ("resolution", "ref_lat")
#: What each stage reads from the settings; anything else may change without a new run of the stage. Regions and
#: distances are parts, not settings.
SETTINGS_OF = {
    "population": GRID_SETTINGS,
    "boundaries": ("iso3", "provinces", "include_country"),
    "boundaries_lgu": ("iso3",),
    "health_facilities": GRID_SETTINGS,
    "population_cells": GRID_SETTINGS,
    "population_aoi": GRID_SETTINGS,
    "candidates": (*GRID_SETTINGS, "potential_type", "spacing", "n_clusters"),
    "facilities_h3": GRID_SETTINGS,
    "potential_locations": GRID_SETTINGS,
    "covered_cells": GRID_SETTINGS,
    "access_summary": (),
    "facilities_coverage": GRID_SETTINGS,
    "potential_coverage": GRID_SETTINGS,
    "mclp_steps": (*GRID_SETTINGS, "max_new"),
    "lgu_access": GRID_SETTINGS,
    "lgu_accessibility_results": (),
    "base_dashboard_data": ("country", "year"),
}
#: Small tables whose parts are told apart by their rows: equal rows made anew change nothing after them.
BY_CONTENT = ("boundaries", "health_facilities", "candidates")


#: For each published name the stored table and the columns that pick its rows.
PUBLISHED = {
    "boundaries": ("boundaries", ("region",)),
    "facilities": ("health_facilities", ("region",)),
    "population": ("population", ()),
    "population_aoi": ("population_aoi", ("region",)),
    "facilities_h3": ("facilities_h3", COMBO),
    "facilities_coverage": ("facilities_coverage", COMBO),
    "potential_locations": ("potential_locations", COMBO),
    "potential_coverage": ("potential_coverage", COMBO),
    "lgu": ("boundaries_lgu", ()),
    "lgu_accessibility": ("lgu_accessibility_results", COMBO),
}
# Columns under which published tables are read; each is taken from the first stored column there is.
CUSTOMARY = {"h3_index": ("h3_index", "cell"), "longitude": ("longitude", "lon"), "latitude": ("latitude", "lat"), "geometry_wkt": ("geometry_wkt", "geom_wkt"), "row_id": ("row_id", "key")}
CUSTOMARY_OF = {
    "population_aoi": ("row_id",),
    "facilities": ("geometry_wkt",),
    "facilities_h3": ("h3_index", "geometry_wkt"),
    "potential_locations": ("h3_index", "longitude", "latitude"),
    "lgu_accessibility": ("h3_index",),
}


def customary_columns(key: str, held: list[str]) -> list[str]:
    """Select list of a published view: the stored columns, those with a customary name under it, and the boundary's
    own names beside its other attributes."""
    made = {name: next((c for c in CUSTOMARY[name] if c in held), None) for name in CUSTOMARY_OF.get(key, ())}
    extra = {name: f"`{c}`" for name, c in made.items() if c and c != name}
    if "attributes" in held:
        extra |= {c: f"attributes['{c}']" for c in features.BOUNDARY_COLUMNS[1] if c not in held}
    moved = {c for name, c in made.items() if name == "h3_index" and c != name}
    return [*(f"`{c}`" for c in held if c not in moved), *(f"{text} AS `{name}`" for name, text in extra.items())]


class Pipeline:
    def __init__(self, spark: SparkSession, settings: Settings):
        self.spark, self.settings = spark, settings
        #: The parts that each stage wrote in this run.
        self.written: dict[str, list[tuple]] = {}

    def _params(self, key: str, inputs: tuple, after: list) -> dict:
        settings = asdict(self.settings)
        return {"settings": {name: settings[name] for name in SETTINGS_OF[key]}, "inputs": inputs, "after": after}

    def _store(self, key: str, make, after: tuple[str, ...] = (), inputs: tuple = ()) -> DataFrame:
        """Compute or reuse a whole table: its own settings, its inputs, and the fingerprints of the stages before it."""
        before = [tables.stored_fingerprint(self.spark, self.settings.table(name)) for name in after]
        return tables.materialize(self.spark, make, self.settings.table(key), self._params(key, inputs, before), self.settings.force)

    def _marks(self, key: str) -> dict[tuple, str]:
        """Marks of a table's regions, or regions and distances."""
        if key in BY_CONTENT:
            return tables.content_marks(self.table(key), ["region"])
        return tables.part_marks(self.spark, self.settings.table(key))

    def _store_parts(self, key: str, make, after: tuple[str, ...], whole: tuple[str, ...] = (), inputs: tuple = (), by_distance: bool = True) -> DataFrame:
        """Compute or reuse a table by region, or by region and distance.

        ``make(regions, distances)`` gives the rows of a rectangle of parts. A part depends on the parts of the same
        region (and distance) in the tables ``after`` and on all of the tables ``whole``.
        """
        s, keys = self.settings, COMBO if by_distance else ["region"]
        common = [tables.stored_fingerprint(self.spark, s.table(name)) for name in whole]
        marks = [self._marks(name) for name in after]
        wanted = {}
        for (region,) in self._marks("boundaries"):
            for d in s.distances_m if by_distance else (0,):
                mine = [m.get((region, d), m.get((region,))) for m in marks]
                reach = (int(d), s.grid.rings(d)) if by_distance else ()
                wanted[(region, int(d)) if by_distance else (region,)] = tables.fingerprint(self._params(key, (*inputs, *reach), [common, mine]))

        def rows(parts: list[tuple]) -> DataFrame:
            found = tables.rectangles(parts if by_distance else [(*p, 0) for p in parts])
            plans = [make(regions, tuple(distances)) for regions, distances in found] or [make([], s.distances_m)]
            return reduce(DataFrame.unionByName, plans)

        self.written[key] = tables.materialize_parts(self.spark, rows, s.table(key), wanted, tuple(keys), s.force)
        return self.table(key)

    def _of(self, key: str, regions: list[str], distances: tuple[int, ...] | None = None) -> DataFrame:
        """The rows of some regions (and distances) of a stored table; the filter prunes partitions."""
        found = self.table(key).filter(F.col("region").isin(*regions) if regions else F.lit(False))
        return found if distances is None else found.filter(F.col("distance_m").isin(*distances))

    def table(self, key: str) -> DataFrame:
        return tables.load_table(self.spark, self.settings.table(key))

    # Extract

    def extract_population(self, tiles: DataFrame, x0: float, y0: float, dx: float, dy: float) -> DataFrame:
        inputs = (tables.input_identity(self.spark, tiles), x0, y0, dx, dy)
        return self._store("population", lambda: raster.raster_pixels(tiles, x0, y0, dx, dy, self.settings.grid), inputs=inputs)

    def extract_boundaries(self, folder: str, layout: str = "auto", epsg: int = 4326) -> tuple[DataFrame, DataFrame]:
        """Regions (country and provinces) and districts."""
        s = self.settings

        def regions():
            adm0, adm1 = (features.load_boundaries(self.spark, folder, level, layout, epsg) for level in (0, 1))
            for province in s.provinces:
                features.select_boundaries(adm1, s.iso3, province)
            every = features.region_table(adm0, adm1, s.iso3, s.country_region)
            wanted = F.col("region") != s.country_region
            if s.provinces:
                wanted = F.col("region").isin(*s.provinces)
            return every.filter(wanted | (F.lit(s.include_country) & (F.col("region") == s.country_region)))

        def districts():
            found = features.select_districts(features.load_boundaries(self.spark, folder, 2, layout, epsg), s.iso3)
            return found.withColumn("position", F.monotonically_increasing_id())  # of the feature, as the file is read

        inputs = (tables.input_identity(self.spark, f"{folder}/*.geojson"), layout, epsg)
        return self._store("boundaries", regions, inputs=inputs), self._store("boundaries_lgu", districts, inputs=inputs)

    def extract_facilities(self, source: str, path, use_center: bool = False, layout: str = "auto", epsg: int = 4326) -> DataFrame:
        """Facilities of every region, with the boundary's columns."""

        def make(regions: list[str], _) -> DataFrame:
            found = features.load_facilities(self.spark, source, path, use_center, layout, epsg)
            with_id = found if source == "file" else sites.facility_ids(found, F.col("osm_id"))
            bounds = self._of("boundaries", regions)
            placed = sites.facilities_within(with_id, bounds, ["iso3", "region"])
            described = lookup_join(placed, bounds.groupBy("region").agg(F.first("attributes").alias("attributes")), ["region"], "left")
            return sites.place_sites(described, self.settings.grid)

        inputs = (source, tables.input_identity(self.spark, path), use_center, layout, epsg)
        return self._store_parts("health_facilities", make, ("boundaries",), inputs=inputs, by_distance=False)

    # Transform

    def prepare(self) -> None:
        s, grid, pixels = self.settings, self.settings.grid, self.table("population")

        def cells(regions: list[str], _) -> DataFrame:
            return population.population_by_region_cell(pixels, self._of("boundaries", regions), grid)

        def aoi(regions: list[str], _) -> DataFrame:
            clipped = population.clip_population(pixels, self._of("boundaries", regions), grid)
            stored = Workspace(self.spark).save(clipped, "clipped")  # the bands read it more than once
            return population.pixel_ids(population.density_bands(stored), F.col("key"))

        def candidates(regions: list[str], _) -> DataFrame:
            if s.potential_type == "grid":
                return sites.grid_candidates(self._of("boundaries", regions), s.spacing, ["region"], grid)
            return sites.kmeans_candidates(self._of("population_aoi", regions), s.n_clusters, ["region"], grid)

        self._store_parts("population_cells", cells, ("boundaries",), whole=("population",), by_distance=False)
        self._store_parts("population_aoi", aoi, ("boundaries",), whole=("population",), by_distance=False)
        self._store_parts("candidates", candidates, ("boundaries",) if s.potential_type == "grid" else ("population_aoi",), by_distance=False)

    def cover(self) -> None:
        """Catchment totals, access summary and, if asked for, the pixel-level relations."""
        s, grid = self.settings, self.settings.grid
        weights, existing, candidates = "population_cells", "health_facilities", "candidates"

        def access(places: str):
            return lambda regions, distances: coverage.facility_access(self._of(places, regions), self._of(weights, regions), distances, grid)

        def covered(regions: list[str], distances: tuple[int, ...]) -> DataFrame:
            return coverage.covered_cells(*(self._of(k, regions) for k in (existing, candidates, weights)), distances, grid)

        def pairs(places: str):
            def make(regions: list[str], distances: tuple[int, ...]) -> DataFrame:
                pixels = self._of("population_aoi", regions).withColumnRenamed("h3_index", "cell")
                return coverage.coverage_pairs(self._of(places, regions), pixels, distances, grid)

            return make

        self._store_parts("facilities_h3", access(existing), (existing, weights))
        self._store_parts("potential_locations", access(candidates), (candidates, weights))
        self._store_parts("covered_cells", covered, (existing, candidates, weights))
        self._store_parts("access_summary", lambda r, d: coverage.access_summary(self._of("covered_cells", r, d)), ("covered_cells",))
        if s.with_pairs:
            self._store_parts("facilities_coverage", pairs(existing), (existing, "population_aoi"))
            self._store_parts("potential_coverage", pairs(candidates), (candidates, "population_aoi"))

    def optimize(self) -> None:
        s, grid = self.settings, self.settings.grid
        weights, existing, candidates = "population_cells", "health_facilities", "candidates"
        regions_table, districts = self.table("boundaries"), self.table("boundaries_lgu")

        def greedy(regions: list[str], distances: tuple[int, ...]) -> DataFrame:
            return mclp.site_steps(*(self._of(k, regions) for k in (weights, existing, candidates)), distances, grid, s.max_new)

        def curves(regions: list[str], distances: tuple[int, ...]) -> DataFrame:
            cells, steps = self._of(weights, regions).select("region", "cell", "w"), self._of("mclp_steps", regions, distances)
            first = mclp.first_covering_step(steps, cells, self._of(existing, regions), distances, grid)
            return equity.access_curves(first, steps, districts, self._of("boundaries", regions), grid)

        def accessibility(regions: list[str], distances: tuple[int, ...]) -> DataFrame:
            steps = self._of("mclp_steps", regions, distances)
            placed = mclp.new_sites(steps, self._of(candidates, regions)).withColumn("_site", F.concat_ws("|", "region", "distance_m", "p"))
            located = spatial_join.first_polygon(placed, districts, "_site", "LGU", "position", keys=("province",)).drop("_site")
            columns = equity.district_columns(equity.listed_districts(districts, self._of("boundaries", regions), grid))
            wide = equity.wide_access(self._of("lgu_access", regions, distances), columns)
            return equity.accessibility_table(wide, located, self._of(existing, regions), self._of(weights, regions))

        self._store_parts("mclp_steps", greedy, (weights, existing, candidates))
        self._store_parts("lgu_access", curves, ("mclp_steps", "boundaries", weights, existing), whole=("boundaries_lgu",))
        self._store_parts("lgu_accessibility_results", accessibility, ("lgu_access", candidates))
        steps = self.table("mclp_steps")
        self._store(
            "base_dashboard_data",
            lambda: layers.dashboard_metadata(steps, self.table("access_summary"), regions_table, districts, s.country, s.year, s.country_region),
            after=("mclp_steps", "access_summary", "boundaries", "boundaries_lgu"),
        )
        made = self.written["lgu_accessibility_results"]
        if made:
            new = self.spark.createDataFrame(made, "region string, distance_m int")
            for key in ("lgu_accessibility_results", "base_dashboard_data"):
                tables.log_run(self.spark, s.table("run_log"), key, new)

    def targets(self) -> tuple[DataFrame, DataFrame]:
        """When all districts reach the target, and those that do not."""
        curves = self.table("lgu_access")
        return equity.target_reached(curves, self.settings.target_pct), equity.districts_below(curves, self.settings.target_pct)

    # Visualize

    def frontier(self) -> DataFrame:
        return layers.pareto_frontier(*(self.table(k) for k in ("access_summary", "mclp_steps", "health_facilities", "candidates")))

    def map_layers(self, samples: int | None = None) -> dict[str, DataFrame]:
        """Covered and uncovered pixels, facilities, boundary centres. ``samples`` asks for at most that many
        pixels per region and distance, fewer where the region has many facilities."""
        pixels = self.table("population_aoi").withColumnRenamed("h3_index", "cell")
        covered = self.table("covered_cells")
        bound = covered.count()
        existing = self.table("health_facilities")
        out = {"facilities": layers.facility_layer(existing), "centers": layers.boundary_centers(self.table("boundaries"), ["region"])}
        for name, flag in (("with_access", True), ("without_access", False)):
            layer = layers.layer_pixels(pixels, covered, flag, bound)
            if samples is not None:
                layer = layers.sample_by_region(layer, existing, samples)
            out[name] = layer.select("region", "distance_m", "xcoord", "ycoord", "opacity")
        return out

    def fresh(self, since) -> DataFrame:
        log = self.table("run_log").filter("table_name = 'lgu_accessibility_results'")
        return tables.fresh_combinations(log, since, self.settings.country_region)

    def publish_views(self, catalog: str = "spark_catalog") -> list[str]:
        """Views under the customary table names and columns, over the shared tables: one per province and distance where
        the name tells them. Only the names of tables that exist are published; the views' names."""
        s, made = self.settings, {}
        for row in self.table("boundaries").select("region").distinct().collect():
            province = None if row["region"] == s.country_region else row["region"]
            for d in s.distances_m:
                for key, view in names.table_names(catalog, s.database, s.country, s.iso3, province, s.year, d).items():
                    source, by = PUBLISHED[key]
                    if view in made or not tables.table_exists(self.spark, s.table(source)):
                        continue
                    value = {"region": "'" + row["region"].replace("\\", "\\\\").replace("'", "\\'") + "'", "distance_m": str(d)}
                    rule = " AND ".join(["TRUE", *(f"{c} = {value[c]}" for c in by)])
                    columns = ", ".join(customary_columns(key, self.table(source).columns))
                    name = view.split(".", 1)[1].replace(" ", "_")
                    self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM {s.table(source)} WHERE {rule}")
                    made[view] = name
        return list(made)

    def run(self) -> None:
        self.prepare()
        self.cover()
        self.optimize()
