"""Tables behind the frontier chart, the coverage map and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.geometry import area_moments, has_geometry
from isoreach.functions.names import pct
from isoreach.operators.coverage import COMBO
from isoreach.operators.dissolve import outline, outline_wkt
from isoreach.operators.joins import lookup_join


def pareto_frontier(summary: DataFrame, steps: DataFrame, existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Access rate against number of facilities: the existing ones first, then one row per step."""
    n_existing = existing.groupBy("region").agg(F.count(F.lit(1)).alias("n_existing"))
    n_potential = candidates.groupBy("region").agg(F.count(F.lit(1)).alias("n_potential"))
    base = (
        summary.join(n_existing, "region", "left")
        .join(n_potential, "region", "left")
        .fillna(0, ["n_existing", "n_potential"])
    )
    start = base.select(
        *COMBO, F.col("n_existing").alias("total_facilities"), F.col("current_access").alias("access_pct"), "n_existing", "n_potential", "max_access"
    )
    later = steps.select(*COMBO, "p", "objective").join(base, COMBO).select(
        *COMBO,
        (F.col("n_existing") + F.col("p")).alias("total_facilities"),
        pct(F.col("objective"), F.col("total_population")).alias("access_pct"),
        "n_existing",
        "n_potential",
        "max_access",
    )
    return start.unionByName(later).orderBy(*COMBO, "total_facilities")


def layer_pixels(pixels: DataFrame, covered: DataFrame, with_access: bool, bound: int | None = None) -> DataFrame:
    """Pixels (region, cell, ...) per distance that existing facilities reach, or do not.

    ``covered`` is (region, distance_m, cell, now) over populated cells; ``bound`` caps its rows. Flags are
    folded to one row per (region, cell) with the distances as an array, so pixels meet one row each.
    """
    wanted = covered.filter(F.col("now") if with_access else ~F.col("now"))
    folded = wanted.groupBy("region", "cell").agg(F.array_sort(F.collect_set("distance_m")).alias("_distances"))
    found = lookup_join(pixels, folded, ["region", "cell"], max_rows=bound)
    return found.withColumn("distance_m", F.explode("_distances")).drop("_distances")


def _reached(pairs: DataFrame) -> tuple[str, DataFrame]:
    """What tells reached pixels, and its values: their ID or, from a relation of cells, their cell."""
    if "pop_ID" in pairs.columns:
        return "ID", pairs.select("region", "distance_m", F.col("pop_ID").alias("ID")).distinct()
    return "cell", pairs.select("region", "distance_m", "cell").distinct()


def pixels_with_access(pixels: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same from stored pairs: for each distance, pixels whose ID occurs in them.

    ``pairs`` may also be the relation (region, distance_m, cell) that the pairs make (``coverage.pairs_to_cells``): it
    is bounded by the grid, and the pixels then stay in place.
    """
    key, reached = _reached(pairs)
    return pixels.join(reached, ["region", key]) if key == "ID" else lookup_join(pixels, reached, ["region", key])


def pixels_without_access(pixels: DataFrame, pairs: DataFrame, distances_m: list[int]) -> DataFrame:
    every = pixels.withColumn("distance_m", F.explode(F.array(*map(F.lit, distances_m))))
    key, reached = _reached(pairs)
    on = ["region", "distance_m", key]
    return every.join(reached, on, "left_anti") if key == "ID" else lookup_join(every, reached, on, "left_anti")


def sample_size(n_facilities: int, limit: int = 5_000) -> int:
    """Points per map layer: fewer when there are many facilities to draw."""
    return min(limit, max(1_000, 10_000 - 3 * n_facilities))


def sample_by_region(layer: DataFrame, facilities: DataFrame, limit: int = 5_000, seed: int = 1) -> DataFrame:
    """``sample_exact`` per region and distance with the ``sample_size`` of the region's own facilities."""
    most = sample_exact(layer, COMBO, "ID", limit, seed)
    counts = facilities.groupBy("region").agg(F.count(F.lit(1)).alias("_n"))
    allowed = F.least(F.lit(limit), F.greatest(F.lit(1_000), 10_000 - 3 * F.coalesce(F.col("_n"), F.lit(0))))
    rank = Window.partitionBy(*COMBO).orderBy(F.md5(F.concat(F.col("ID").cast("string"), F.lit(f"|{seed}"))), "ID")
    ranked = most.join(counts, "region", "left").withColumn("_rank", F.row_number().over(rank))
    return ranked.filter(F.col("_rank") <= allowed).select(*layer.columns)


def sample_rows(df: DataFrame, max_samples: int, seed: int = 1) -> DataFrame:
    """About ``max_samples`` random rows; everything when there are fewer, nothing when there is nothing."""
    count = df.count()
    return df.sample(fraction=min(1.0, max_samples / count), seed=seed) if count else df


def sample_exact(df: DataFrame, groups: list[str], key: str, n: int, seed: int = 1, slices: int = 256) -> DataFrame:
    """Exactly ``min(n, size)`` rows of every group, those of the least hashes of ``key``: reproducible anywhere.

    One scan, and no counting before it: every task keeps the n least of each group (Spark limits ranks before it
    shuffles), those of the tasks that share a slice are cut to n again, and the slices meet last. A large group is
    never one task's work: a slice sees n rows for each task in it, the last step n rows for each slice.
    """
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))))
    hashed = hashed.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    for keys in ([*groups, "_slice"], groups):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_h", key))
        hashed = hashed.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")
    return hashed.drop("_h", "_slice")


def boundary_centers(boundaries: DataFrame, keys: list[str], wkt: str = "geometry_wkt") -> DataFrame:
    """Centroid of the union of each key's polygons, which must not overlap."""
    m = area_moments(wkt)
    sums = boundaries.filter(has_geometry(F.col(wkt))).select(*keys, m.alias("_m")).groupBy(*keys).agg(
        F.sum("_m.area").alias("_a"), F.sum("_m.mx").alias("_x"), F.sum("_m.my").alias("_y")
    )
    return sums.select(
        *keys,
        (F.col("_x") / F.nullif(F.col("_a"), F.lit(0.0))).alias("center_lon"),
        (F.col("_y") / F.nullif(F.col("_a"), F.lit(0.0))).alias("center_lat"),
        F.col("_a").alias("area"),
    )


def dashboard_metadata(
    steps: DataFrame, summary: DataFrame, regions: DataFrame, districts: DataFrame, country: str, year: int, country_region: str = "Country"
) -> DataFrame:
    """One row per combination that has steps.

    ``current_access`` is the rate after the first new site and ``total_new_facilities`` the steps less
    one, as existing dashboards expect; ``baseline_access`` and ``steps`` are the plain numbers. Centre and
    geometry are those of the whole country; the geometry is the outline of its districts.
    """
    geometry = boundary_centers(districts, ["iso3"]).join(outline_wkt(outline(districts, ["iso3"]), ["iso3"]), "iso3")
    run = steps.groupBy(*COMBO).agg(F.max("p").cast("int").alias("steps"), F.min_by("objective", "p").alias("_first"))
    return (
        run.join(summary, COMBO)
        .join(regions.select("region", "iso3"), "region")
        .join(geometry, "iso3")
        .select(
            F.lit(country).alias("country"),
            F.when(F.col("region") != country_region, F.col("region")).alias("province"),
            F.lit(int(year)).alias("year"),
            F.col("center_lat").alias("central_lat"),
            F.col("center_lon").alias("central_long"),
            F.floor(F.col("distance_m") / 1000).cast("int").alias("distance_km"),
            (F.col("steps") - 1).alias("total_new_facilities"),
            pct(F.col("_first"), F.col("total_population")).alias("current_access"),
            F.col("current_access").alias("baseline_access"),
            "steps",
            "geometry_wkt",
        )
    )


def facility_layer(facilities: DataFrame) -> DataFrame:
    return facilities.select("region", "ID", "lat", "lon")
