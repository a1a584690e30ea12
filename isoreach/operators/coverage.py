"""Who is within k rings of which site.

A site table has (region, ID, cell); weights are (region, cell, w). Distances are a column: every
operator answers all (region, distance_m) combinations in one plan.

Totals never materialise the site x cell relation. A disk is 2k+1 horizontal runs, so

* people per site are differences of running sums along each row of cells, and
* the number of sites over a cell is a running count of run starts minus run ends,

which shuffles O(sites x k + cells) rows instead of O(sites x k^2), whatever the number of sites that
share a cell: sites are reduced to distinct cells first. The groups of the windows are single grid
rows of one combination; their length is bounded by the grid, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.functions.hexgrid import HexGrid, disk_size, explode_disk, explode_disk_rows, per_distance, q_sql, row_sql
from isoreach.functions.names import pct
from isoreach.operators.joins import Workspace, deal, hot_join, lookup_join
from isoreach.operators.population import from_micro

COMBO = ["region", "distance_m"]


def site_cells(sites: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """Distinct (region, distance_m, cell, k): co-located sites have one and the same disk."""
    return per_distance(sites.select("region", "cell").distinct(), distances_m, grid)


def disk_sums(disks: DataFrame, weights: DataFrame) -> DataFrame:
    """(region, distance_m, cell, w): weight inside each disk.

    ``disks`` is (combo, cell, k) with distinct rows, ``weights`` is (combo, cell, w).
    """
    probes = explode_disk_rows(disks, "k").selectExpr(
        *COMBO, "row", "inline(array(struct(q_hi AS q, 1 AS sign), struct(q_lo - 1 AS q, -1 AS sign)))", "cell AS site", "NULL AS w"
    )
    cells = weights.selectExpr(*COMBO, f"{row_sql('cell')} AS row", f"{q_sql('cell')} AS q", "0 AS sign", "NULL AS site", "w")
    # A range frame includes peers, so a cell counts for a probe at the same q.
    below = "coalesce(sum(w) OVER (PARTITION BY region, distance_m, row ORDER BY q RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)"
    return (
        cells.unionByName(probes)
        .selectExpr("region", "distance_m", "site AS cell", "sign", f"{below} AS below")
        .filter("sign != 0")
        .groupBy(*COMBO, "cell")
        .agg(F.expr("sum(below * sign) AS w"))
    )


def cover_counts(cells: DataFrame, **disks: DataFrame) -> DataFrame:
    """``cells`` (combo, cell, ...) plus one column per set of disks: how many of them hold the cell.

    All sets share one shuffle and one sort.
    """
    extra = [c for c in cells.columns if c not in (*COMBO, "cell")]
    blank = [f"CAST(NULL AS {kind}) AS {c}" for c, kind in cells.dtypes if c in ("cell", *extra)]
    swept = cells.selectExpr(
        *COMBO, f"{row_sql('cell')} AS row", f"{q_sql('cell')} AS q", "cell", *extra, *[f"0L AS _{name}" for name in disks]
    )
    for name, places in disks.items():
        # Many disks start or end at one place: combine before the sweep.
        ends = (
            explode_disk_rows(places, "k")
            .selectExpr(*COMBO, "row", "inline(array(struct(q_lo AS q, 1 AS step), struct(q_hi + 1 AS q, -1 AS step)))")
            .groupBy(*COMBO, "row", "q")
            .agg(F.expr("sum(step) AS step"))
            .filter("step != 0")
        )
        steps = [f"step AS _{name}" if other == name else f"0L AS _{other}" for other in disks]
        swept = swept.unionByName(ends.selectExpr(*COMBO, "row", "q", *blank, *steps))
    window = "OVER (PARTITION BY region, distance_m, row ORDER BY q RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    counted = swept.selectExpr(*COMBO, "cell", *extra, *[f"sum(_{name}) {window} AS {name}" for name in disks])
    return counted.filter("cell IS NOT NULL")


def weights_per_distance(weights: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    return per_distance(weights, distances_m, grid).drop("k")


def facility_access(facilities: DataFrame, weights: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """Facilities with ``distance_m`` and ``pop_with_access``; 0.0 where nobody lives in reach."""
    sums = disk_sums(
        site_cells(facilities, distances_m, grid),
        weights_per_distance(weights.select("region", "cell", "w"), distances_m, grid),
    )
    every = per_distance(facilities, distances_m, grid).drop("k")
    # Facilities may crowd one cell while the sums have one row per cell and distance.
    bound = facilities.select("region", "cell").distinct().count() * len(distances_m)
    joined = lookup_join(every, sums, [*COMBO, "cell"], "left", max_rows=bound)
    return joined.withColumn("pop_with_access", F.coalesce(from_micro(F.col("w")), F.lit(0.0))).drop("w")


def coverage_cells(sites: DataFrame, weights: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """The relation (region, distance_m, facility_ID, cell, ring) over populated cells.

    Expanded once with the largest k; each distance is a ring limit. Sites are dealt over tasks by the rows of
    their disks, and the populated cells come to them: a join by the site's cell would leave the many rows that
    follow to the few tasks that suffice for the sites.
    """
    rings = {int(d): grid.rings(d) for d in distances_m}
    members = sites.select("region", "cell", F.col("ID").alias("facility_ID"))
    disks = explode_disk(deal(members, relation_rows(members, distances_m, grid)), str(max(rings.values())))
    found = lookup_join(disks, weights.select("region", F.col("cell").alias("disk_cell")), ["region", "disk_cell"])
    reach = F.filter(
        F.array(*[F.struct(F.lit(d).alias("distance_m"), F.lit(k).alias("k")) for d, k in rings.items()]),
        lambda o: o["k"] >= F.col("ring"),
    )
    return found.withColumn("_d", F.explode(reach)).select(
        "region", F.col("_d.distance_m").alias("distance_m"), "facility_ID", F.col("disk_cell").alias("cell"), "ring"
    )


def relation_rows(sites: DataFrame, distances_m, grid: HexGrid) -> int:
    """Upper bound of the rows of ``coverage_cells``."""
    return sites.count() * sum(disk_size(grid.rings(d)) for d in distances_m)


def coverage_pairs(sites: DataFrame, pixels: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """The pixel-level relation (region, distance_m, facility_ID, pop_ID), without duplicates.

    ``pixels`` has region, ID, cell. This is an output in its own right, as large as it sounds;
    nothing else here is computed from it. Cells are dealt over tasks, and pixels of a cell in pieces, by the pairs
    they become: adaptive execution would deal them by what is read, a small part of what is made.
    """
    work = Workspace(pixels.sparkSession)
    populated = work.save(pixels.groupBy("region", "cell").agg(F.count(F.lit(1)).alias("n")), "populated")
    cells = coverage_cells(sites.select("region", "ID", "cell").distinct(), populated, distances_m, grid)
    cells = work.save(cells.select("region", "cell", "distance_m", "facility_ID"), "cells")
    met = cells.groupBy("region", "cell").agg(F.count(F.lit(1)).alias("_sites"))
    counts = work.save(populated.join(met, ["region", "cell"]).select("region", "cell", (F.col("n") * F.col("_sites")).alias("n")), "counts")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    on = ["region", "cell"]
    # What a task makes is passed on row by row, so a task may make many.
    return hot_join(pixels.select(*on, F.col("ID").alias("pop_ID")), cells, on, counts=counts, rows=rows // 16).select(*COMBO, "facility_ID", "pop_ID")


def pairs_to_cells(pairs: DataFrame, pixels: DataFrame) -> DataFrame:
    """Distinct (region, distance_m, facility_ID, cell) from stored pixel pairs. A pixel reached by very
    many facilities is a hot key of the pairs; Spark's skew join splits it, the pixel side being unique.

    All pixels of a cell have the same facilities, so pairs of ``one_per_cell`` give the same cells."""
    located = pixels.select("region", F.col("ID").alias("pop_ID"), "cell")
    return pairs.join(located, ["region", "pop_ID"]).select(*COMBO, "facility_ID", "cell").distinct()


def one_per_cell(pixels: DataFrame) -> DataFrame:
    """(region, cell, ID): of each populated cell the pixel of least ID stands for all. Pairs of these are the
    relation of pixels without its copies: a pixel's facilities are those of the one that stands for its cell."""
    return pixels.groupBy("region", "cell").agg(F.min("ID").alias("ID"))


def id_sets(relation: DataFrame, keys: list[str], member: str, out: str, digits: int = 1, max_rows: int | None = None) -> DataFrame:
    """``keys`` + ``part`` + sorted array of the distinct members of that part.

    A member's part is the first ``digits`` hexadecimal digits of its md5, whatever the size of its group, so
    groups come in up to 16 ** digits rows of which none holds more than its share. Rows are shuffled once, by group
    and part, to as many tasks as ``max_rows`` (a bound of the relation, counted if absent) asks for.
    """
    part = F.conv(F.substring(F.md5(F.col(member).cast("string")), 1, digits), 16, 10).cast("int")
    rows = relation.count() if max_rows is None else max_rows
    grouped = deal(relation.select(*keys, part.alias("part"), member), rows, *keys, "part").distinct().groupBy(*keys, "part")
    return grouped.agg(F.array_sort(F.collect_list(member)).alias(out))


def cell_facilities(coverage: DataFrame, digits: int = 1, max_rows: int | None = None) -> DataFrame:
    return id_sets(coverage, [*COMBO, "cell"], "facility_ID", "fac_ids", digits, max_rows)


def facility_cells(coverage: DataFrame, digits: int = 1, max_rows: int | None = None) -> DataFrame:
    return id_sets(coverage, [*COMBO, "facility_ID"], "cell", "cells", digits, max_rows)


def covered_cells(existing: DataFrame, candidates: DataFrame, weights: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """Populated cells per combination with flags ``now`` (an existing site reaches them) and ``ever``."""
    cells = weights_per_distance(weights, distances_m, grid)
    counts = cover_counts(
        cells, _existing=site_cells(existing, distances_m, grid), _candidates=site_cells(candidates, distances_m, grid)
    )
    return counts.selectExpr(
        *COMBO, "cell", *[c for c in weights.columns if c not in ("region", "cell")],
        "_existing > 0 AS now", "_existing > 0 OR _candidates > 0 AS ever",
    )


def access_summary(covered: DataFrame) -> DataFrame:
    """Per combination: total, covered and coverable people, current and maximum access %."""
    sums = covered.groupBy(*COMBO).agg(
        F.sum("w").alias("_all"),
        F.sum(F.when(F.col("now"), F.col("w")).otherwise(0)).alias("_now"),
        F.sum(F.when(F.col("ever"), F.col("w")).otherwise(0)).alias("_ever"),
    )
    return sums.select(
        *COMBO,
        from_micro(F.col("_all")).alias("total_population"),
        from_micro(F.col("_now")).alias("covered_population"),
        from_micro(F.col("_ever")).alias("coverable_population"),
        pct(F.col("_now"), F.col("_all")).alias("current_access"),
        pct(F.col("_ever"), F.col("_all")).alias("max_access"),
    )
