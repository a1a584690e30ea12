"""District access rates per added site, and targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoreach.functions.hexgrid import HexGrid
from isoreach.functions.names import dedupe_columns, pct, sanitize_name
from isoreach.operators.coverage import COMBO
from isoreach.operators.polyfill import polyfill, with_polygon
from isoreach.operators.population import from_micro

DISTRICT = ["province", "LGU"]


def district_cells(districts: DataFrame, grid: HexGrid) -> DataFrame:
    """(province, LGU, cell) by polyfill."""
    return polyfill(districts, DISTRICT, grid)


def district_population(weights: DataFrame, districts: DataFrame, grid: HexGrid) -> DataFrame:
    """(region, cell, province, LGU, w): populated cells with the district whose polyfill holds them."""
    return with_polygon(weights, districts, DISTRICT, grid)


def district_totals(district_pop: DataFrame) -> DataFrame:
    return district_pop.groupBy("region", *DISTRICT).agg(
        from_micro(F.sum("w")).alias("population"), F.count(F.lit(1)).alias("cells")
    )


def listed_districts(districts: DataFrame, regions: DataFrame, grid: HexGrid) -> DataFrame:
    """(iso3, province, LGU) of the districts that the regions' curves list: those of their country that own a cell centre."""
    owned = district_cells(districts, grid).select(*DISTRICT).distinct()
    return districts.select("iso3", *DISTRICT).join(owned, DISTRICT, "left_semi").join(regions.select("iso3"), "iso3", "left_semi").distinct()


def access_curves(
    first_steps: DataFrame, steps: DataFrame, districts: DataFrame, regions: DataFrame, grid: HexGrid, with_baseline: bool = False
) -> DataFrame:
    """(region, distance_m, p, province, LGU, covered, total, access_pct) for every step and district.

    ``first_steps`` carries region, distance_m, cell, w, step. People are summed once per district and
    first covering step; a running sum over steps gives the curve. Every region lists all districts of
    its country that own a cell centre, those without people at 0 %. ``regions`` and ``districts``
    share ``iso3``.
    """
    per_step = (
        with_polygon(first_steps, districts, DISTRICT, grid)
        .groupBy(*COMBO, *DISTRICT, "step")
        .agg(F.sum("w").alias("w"))
    )
    last = steps.groupBy(*COMBO).agg(F.max("p").alias("_last"))
    listed = listed_districts(districts, regions, grid)
    first = 0 if with_baseline else 1
    spine = (
        regions.select("iso3", "region")
        .join(last, "region")
        .join(listed, "iso3")
        .withColumn("p", F.explode(F.sequence(F.lit(0), "_last")))
        .select(*COMBO, *DISTRICT, "p")
    )
    totals = per_step.groupBy(*COMBO, *DISTRICT).agg(F.sum("w").alias("_total"))
    running = Window.partitionBy(*COMBO, *DISTRICT).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    return (
        spine.join(per_step.filter("step IS NOT NULL").withColumnRenamed("step", "p"), [*COMBO, *DISTRICT, "p"], "left")
        .withColumn("_covered", F.coalesce(F.sum("w").over(running), F.lit(0)))
        .filter(F.col("p") >= first)
        .join(totals, [*COMBO, *DISTRICT], "left")
        .select(
            *COMBO,
            "p",
            *DISTRICT,
            from_micro(F.col("_covered")).alias("covered"),
            F.coalesce(from_micro(F.col("_total")), F.lit(0.0)).alias("total"),
            pct(F.col("_covered"), F.coalesce(F.col("_total"), F.lit(0))).alias("access_pct"),
        )
    )


def merge_by_name(curves: DataFrame) -> DataFrame:
    """Curves keyed by district name alone: equal names of two provinces become one."""
    return curves.groupBy(*COMBO, "p", "LGU").agg(F.sum("covered").alias("covered"), F.sum("total").alias("total")).withColumn(
        "access_pct", pct(F.col("covered"), F.col("total"))
    )


def district_columns(curves: DataFrame) -> dict[str, str]:
    """From curves or districts: district name to column name, unique ignoring case. One name per output column reaches the driver."""
    rows = curves.select("LGU", sanitize_name(F.col("LGU")).alias("c")).distinct().orderBy("LGU").collect()
    return dict(zip([r["LGU"] for r in rows], dedupe_columns([r["c"] for r in rows]), strict=True))


def wide_access(curves: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """One row per (region, distance_m, p), one ``lgu_*`` column per district name.

    ``columns`` are those of ``district_columns``, from the districts: curves without steps name none.
    """
    names = district_columns(curves) if columns is None else columns
    wide = merge_by_name(curves).groupBy(*COMBO, "p").pivot("LGU", list(names)).agg(F.first("access_pct"))
    return wide.select(*COMBO, "p", *[F.coalesce(F.col(f"`{lgu}`"), F.lit(0.0)).alias(c) for lgu, c in names.items()])


def accessibility_table(wide: DataFrame, located_steps: DataFrame, existing: DataFrame, weights: DataFrame) -> DataFrame:
    """The result table: fixed front columns, then the district columns.

    ``located_steps`` has district, lat, lon; counts and people per region give the running number of
    facilities and the national rate.
    """
    counts = existing.groupBy("region").agg(F.count(F.lit(1)).alias("_n"))
    people = weights.groupBy("region").agg(from_micro(F.sum("w")).alias("_people"))
    lgu = [c for c in wide.columns if c not in (*COMBO, "p")]
    front = (
        located_steps.join(counts, "region", "left")
        .join(people, "region", "left")
        .select(
            *COMBO,
            "p",
            (F.coalesce(F.col("_n"), F.lit(0)) + F.col("p")).alias("total_facilities"),
            F.col("facility_id").alias("new_facility"),
            "district",
            F.col("lat").cast("double"),
            F.col("lon").cast("double"),
            F.col("cell").alias("h3_index"),
            pct(F.col("objective"), F.coalesce(F.col("_people"), F.lit(0.0))).alias("total_population_access_pct"),
        )
    )
    return front.join(wide, [*COMBO, "p"], "left").select(*front.columns, *[F.col(c).cast("double") for c in lgu])


def target_reached(curves: DataFrame, target: float = 90.0, populated_only: bool = False) -> DataFrame:
    """Per combination the first step at which every district has the target rate; NULL if none has."""
    kept = curves.filter("total > 0") if populated_only else curves
    per_step = kept.groupBy(*COMBO, "p").agg(F.bool_and(F.col("access_pct") >= target).alias("_ok"))
    return per_step.groupBy(*COMBO).agg(F.min(F.when(F.col("_ok"), F.col("p"))).alias("steps_needed"), F.max("p").alias("steps"))


def districts_below(curves: DataFrame, target: float = 90.0) -> DataFrame:
    """Districts under the target at the last step of each combination, where no step reached it for all."""
    reached = target_reached(curves, target)
    last = curves.join(reached.filter("steps_needed IS NULL"), COMBO).filter(F.col("p") == F.col("steps"))
    return last.filter(F.col("access_pct") < target).select(*COMBO, *DISTRICT, "access_pct")


def province_names(boundaries: DataFrame, column: str = "province") -> DataFrame:
    return boundaries.select(column).distinct().orderBy(column)
