"""Greedy maximum coverage: where should the next p sites go, for every region and distance at once.

Each step picks, per combination, the candidate that reaches most people not reached so far; ties go to
the smallest id. Gains only ever fall, so the gain a candidate had is a bound for what it has now. The state is the
table of gains, and a round

1. takes the best candidates of every combination, at most LEADERS and as many as ENTRIES cells allow, with the first
   one left out as the bound for all others,
2. picks among them one after another, in one task per combination, for as long as the best beats that bound: then no
   other candidate can, whatever it has lost since (lazy greedy). The first is always certain,
3. subtracts the people in the newly covered cells from the candidates within reach of those cells, by the same row
   sweep that made the gains.

So a round costs one pass over the gains for many picks, and a task holds a number of rows that is fixed beforehand.
The site x cell relation is never stored for hexagon catchments: which cells a pick covers is a disk,
generated by arithmetic, and the candidates within 2k rings of a pick sum up the newly covered cells as
differences of running sums: O(k^2) cells and 2k+1 rows for each of those candidates. Step 3 involves
a number of rows fixed by k and the number of picks, known before the step, and these are broadcast only
while that bound is small; the gains table itself is never shuffled. Two candidates in one cell cover the same
cells, so gains are kept per cell and the smallest id stands for it.

Weights are whole millionths of a person: sums are exact, so equal gains are equal on any cluster.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoreach.functions.hexgrid import Q_SHIFT, HexGrid, disk_size, distance_sql, explode_disk, hex_distance_int, per_distance, q_sql, row_sql
from isoreach.operators.coverage import COMBO, cover_counts, disk_sums, site_cells, weights_per_distance
from isoreach.operators.joins import Workspace, broadcast_if, deal, local_rows, lookup_join
from isoreach.operators.population import from_micro

PICK_SCHEMA = pa.schema(
    [("region", pa.string()), ("distance_m", pa.int32()), ("p", pa.int32()), ("facility_id", pa.string()), ("cell", pa.int64()), ("gain_w", pa.int64())]
)
PICKED_SCHEMA = pa.schema(
    [("region", pa.string()), ("distance_m", pa.int32()), ("cell", pa.int64()), ("k", pa.int32()), ("near", pa.list_(pa.int64()))]
)
AROUND_SCHEMA = pa.schema([("region", pa.string()), ("distance_m", pa.int32()), ("k", pa.int32()), ("centers", pa.list_(pa.int64()))])
# Candidates looked at per combination and round, and the cells they may reach together in one task.
LEADERS = 1024
ENTRIES = 1 << 22
BATCH_SCHEMA = "region string, distance_m int, turn int, ID string, cell long, gain long, whole boolean"
BASE_SCHEMA = pa.schema([("region", pa.string()), ("distance_m", pa.int32()), ("base_w", pa.int64())])
ID_SCHEMA = pa.schema([("region", pa.string()), ("distance_m", pa.int32()), ("ID", pa.string())])


def _front(gains: DataFrame, n: str) -> DataFrame:
    """The leading candidates of every combination, and the first after them (``led`` is false).

    ``n`` (SQL text) is how many cells a candidate adds to its task. Spark limits ranks before the shuffle, so every
    task sends at most LEADERS + 1 rows per combination. The best is a leader even if its cells exceed the bound.
    """
    rank = "row_number() OVER (PARTITION BY region, distance_m ORDER BY gain DESC, ID) AS _rank"
    total = f"sum({n}) OVER (PARTITION BY region, distance_m ORDER BY _rank) AS _total"
    best = gains.selectExpr("*", rank).filter(f"_rank <= {LEADERS + 1}").selectExpr("*", total)
    led = best.selectExpr("*", f"_total <= {ENTRIES} AND _rank <= {LEADERS} AS _fits").selectExpr("*", "_fits OR _rank = 1 AS led")
    before = "lag(led, 1, true) OVER (PARTITION BY region, distance_m ORDER BY _rank) AS _before"
    return led.selectExpr("*", before).filter("_before").drop("_before", "_total", "_rank")


def lazy_picks(leaders: list[tuple], reach: Callable[[int], np.ndarray], weights: np.ndarray, room: int, bound: tuple | None) -> list[tuple]:
    """(leader, gain) in the order of the greedy, for as long as the order is certain.

    ``leaders`` are (gain, id) with exact gains, ``reach(i)`` the places in ``weights`` that leader i covers, ``bound``
    the (gain, id) that no other candidate exceeds. A gain counted before the last pick is a bound; only a candidate at
    the top of the heap is counted anew. Weights of covered places become 0.
    """
    heap = [(-gain, name, i) for i, (gain, name) in enumerate(leaders)]
    heapq.heapify(heap)
    counted, picks = [0] * len(leaders), []
    while heap and len(picks) < room:
        lost, name, i = heapq.heappop(heap)
        if bound is not None and (lost, name) > (-bound[0], bound[1]):
            break
        if counted[i] == len(picks):
            picks.append((i, -lost))
            weights[reach(i)] = 0
            continue
        gain, counted[i] = int(weights[reach(i)].sum()), len(picks)
        if gain > 0:
            heapq.heappush(heap, (-gain, name, i))
    return picks


def _disk_offsets(k: int) -> np.ndarray:
    q, r = (x.ravel() for x in np.mgrid[-k : k + 1, -k : k + 1])
    near = np.abs(q + r) <= k
    return (q[near].astype(np.int64) << Q_SHIFT) + r[near]


def _batch(front: DataFrame, cells: DataFrame, reach_of: Callable, taken: dict[tuple, int], max_new: int) -> list[tuple]:
    """The picks of one round: rows of BATCH_SCHEMA on the driver, at most ``max_new`` per combination over all rounds.

    ``reach_of(leaders, cells)`` gives, within a task, the weights and the function that ``lazy_picks`` asks.
    """

    def pick(key: tuple, front: pa.Table, cells: pa.Table) -> pa.Table:
        combo = tuple(part.as_py() for part in key)
        rows = sorted(front.select(["led", "gain", "ID", "cell"]).to_pylist(), key=lambda r: (-r["gain"], r["ID"]))
        led, others = [r for r in rows if r["led"]], [(r["gain"], r["ID"]) for r in rows if not r["led"]]
        weights, reach = reach_of(combo, led, cells)
        bound = others[0] if others else None
        found = lazy_picks([(r["gain"], r["ID"]) for r in led], reach, weights, max_new - taken.get(combo, 0), bound) if led else []
        out = [(*combo, taken.get(combo, 0) + n, led[i]["ID"], led[i]["cell"], gain, bound is None) for n, (i, gain) in enumerate(found, 1)]
        columns = list(zip(*out, strict=True)) or [()] * 7
        types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["region", "distance_m", "turn", "ID", "cell", "gain", "whole"]
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, columns, types, strict=True)})

    return front.groupBy(*COMBO).cogroup(cells.groupBy(*COMBO)).applyInArrow(pick, BATCH_SCHEMA).collect()


def _greedy(gains: DataFrame, ahead: Callable, shrink: Callable, max_new: int, work: Workspace) -> list[tuple]:
    """Pick, shrink the gains, repeat. ``ahead(gains, picks, taken)`` gives the picks that are certain (one at least for
    every combination that has gains), ``shrink(gains, step, earlier_picks)`` the new gains.

    A combination ends with its last pick, or when all its candidates were looked at. Every version of the gains is
    written and read back: a round then plans and runs in constant time however many came before, and losing an
    executor costs at most one round.
    """
    picks: list[tuple] = []
    taken: dict[tuple, int] = {}
    if max_new < 1:
        return picks
    stored, gains = "gains-0", work.save(gains.filter("gain > 0"), "gains-0")
    for turn in range(1, max_new + 1):
        found = sorted(ahead(gains, picks, taken), key=lambda r: (r["region"], r["distance_m"], r["turn"]))
        step = [(r["region"], r["distance_m"], r["turn"], r["ID"], r["cell"], r["gain"]) for r in found]
        taken.update({s[:2]: s[2] for s in step})
        ended = {(r["region"], r["distance_m"]) for r in found if r["whole"] or r["turn"] == max_new}
        earlier, picks = picks, picks + step
        if len(ended) == len({s[:2] for s in step}):
            break
        left = shrink(gains, [s for s in step if s[:2] not in ended], earlier).filter("gain > 0")
        if ended:
            finished = local_rows(gains.sparkSession, [(*combo, None) for combo in ended], ID_SCHEMA)
            left = left.join(broadcast_if(finished, len(ended)), COMBO, "left_anti")
        gains, replaced = work.save(left, f"gains-{turn}"), stored
        work.drop(replaced)
        stored = f"gains-{turn}"
    return picks


def _steps(spark: SparkSession, picks: list[tuple], base: list) -> DataFrame:
    """Pick rows with the running objective; ``base`` holds what existing sites cover per combination."""
    rows = local_rows(spark, picks, PICK_SCHEMA)
    base = local_rows(spark, base, BASE_SCHEMA)
    running = Window.partitionBy(*COMBO).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_sum", F.sum("gain_w").over(running))
        .join(base, COMBO, "left")
        .select(
            *COMBO,
            "p",
            "facility_id",
            "cell",
            from_micro(F.col("gain_w")).alias("gain"),
            from_micro(F.col("_sum") + F.coalesce(F.col("base_w"), F.lit(0))).alias("objective"),
        )
    )


def site_steps(
    weights: DataFrame, existing: DataFrame, candidates: DataFrame, distances_m, grid: HexGrid, max_new: int
) -> DataFrame:
    """Greedy steps for hexagon catchments: (region, distance_m, p, facility_id, cell, gain, objective).

    ``weights`` is (region, cell, w); ``existing`` and ``candidates`` are (region, ID, cell). A
    combination ends early when no candidate gains; ``objective`` includes what existing sites cover.
    """
    spark = weights.sparkSession
    work = Workspace(spark)
    rings = {int(d): grid.rings(d) for d in distances_m}

    cells = weights_per_distance(weights.select("region", "cell", "w"), distances_m, grid)
    state = work.save(cover_counts(cells, sites=site_cells(existing, distances_m, grid)), "cells")
    base = state.filter("sites > 0").groupBy(*COMBO).agg(F.sum("w").alias("base_w")).collect()
    open_cells = state.filter("sites = 0").select(*COMBO, "cell", "w")
    new_sites = candidates.join(existing.select("region", "ID"), ["region", "ID"], "left_anti")
    named = per_distance(new_sites.groupBy("region", "cell").agg(F.min("ID").alias("ID")), distances_m, grid)
    gains = named.join(
        disk_sums(named.select(*COMBO, "cell", "k"), open_cells).withColumnRenamed("w", "gain"), [*COMBO, "cell"]
    ).select(*COMBO, "cell", "ID", "gain")
    # Tiles as wide as a disk's radius: a disk lies within its centre's tile and the eight around it.
    size = "map({})[distance_m]".format(", ".join(f"{d}, {max(k, 1)}" for d, k in rings.items()))
    tile = lambda part: f"CAST(floor({part('cell')} / {size}) AS LONG)"
    open_cells = open_cells.selectExpr("*", f"{tile(q_sql)} AS _tq", f"{tile(row_sql)} AS _tr").persist(StorageLevel.MEMORY_AND_DISK)
    weight_of_disk = " ".join(f"WHEN {d} THEN {9 * max(k, 1) ** 2}" for d, k in rings.items())

    def ahead(gains: DataFrame, picks: list[tuple], taken: dict[tuple, int]) -> list:
        done: dict[tuple, list[int]] = {}
        for region, distance, _, _, cell, _ in picks:
            done.setdefault((region, distance), []).append(cell)

        def reach_of(combo: tuple, leaders: list[dict], cells: pa.Table) -> tuple[np.ndarray, Callable]:
            known, weights = cells.column("cell").to_numpy(), cells.column("w").to_numpy().copy()
            order = np.argsort(known)
            known, weights, offsets = known[order], weights[order], _disk_offsets(rings[combo[1]])

            def within(center: int) -> np.ndarray:
                wanted = center + offsets
                at = np.searchsorted(known, wanted)
                return at[known[np.minimum(at, len(known) - 1)] == wanted] if len(known) else at[:0]

            for center in done.get(combo, []):
                weights[within(center)] = 0
            return weights, lambda i: within(leaders[i]["cell"])

        front = work.save(_front(gains, f"CASE distance_m {weight_of_disk} END"), f"front-{len(picks)}")
        around = front.filter("led AND _fits").selectExpr(*COMBO, f"{tile(q_sql)} AS _q", f"{tile(row_sql)} AS _r")
        tiles = around.distinct().selectExpr(*COMBO, "_r", "explode(sequence(_q - 1, _q + 1)) AS _tq")
        tiles = tiles.selectExpr(*COMBO, "_tq", "explode(sequence(_r - 1, _r + 1)) AS _tr").distinct()
        near = lookup_join(open_cells, tiles, [*COMBO, "_tq", "_tr"], "left_semi").select(*COMBO, "cell", "w")
        found = _batch(front, near, reach_of, taken, max_new)
        work.drop(f"front-{len(picks)}")
        return found

    def shrink(gains: DataFrame, step: list[tuple], done: list[tuple]) -> DataFrame:
        earlier: dict[tuple, list[int]] = {}
        for region, distance, _, _, cell, _ in done:
            earlier.setdefault((region, distance), []).append(cell)
        rows = []
        for region, distance, _, _, cell, _ in step:
            # A cell is new to the first pick that covers it, in this round or before.
            k, before = rings[distance], earlier.setdefault((region, distance), [])
            rows.append((region, distance, cell, k, [c for c in before if hex_distance_int(c, cell) <= 2 * k]))
            before.append(cell)
        picked = local_rows(spark, rows, PICKED_SCHEMA)
        fresh = (
            explode_disk(picked, "k")
            .filter(f"NOT exists(near, c -> {distance_sql('c', 'disk_cell')} <= k)")
            .selectExpr(*COMBO, "disk_cell AS cell", "k")
        )
        reached = open_cells.join(broadcast_if(fresh, sum(disk_size(r[3]) for r in rows)), [*COMBO, "cell"])
        centers: dict[tuple, list[int]] = {}
        for region, distance, cell, _, _ in rows:
            centers.setdefault((region, distance), []).append(cell)
        around = local_rows(spark, [(*combo, rings[combo[1]], cells) for combo, cells in centers.items()], AROUND_SCHEMA)
        near = (
            gains.join(broadcast_if(around, len(centers)), COMBO)
            .filter(f"exists(centers, c -> {distance_sql('c', 'cell')} <= 2 * k)")
            .select(*COMBO, "cell", "k")
        )
        lost = disk_sums(near, reached.select(*COMBO, "cell", "w")).withColumnRenamed("w", "lost")
        lost = broadcast_if(lost, sum(disk_size(2 * r[3]) for r in rows))
        return gains.join(lost, [*COMBO, "cell"], "left").selectExpr(*COMBO, "cell", "ID", "gain - coalesce(lost, 0) AS gain")

    picks = _greedy(gains, ahead, shrink, max_new, work)
    open_cells.unpersist()
    work.close()
    return _steps(spark, picks, base)


def relation_steps(
    weights: DataFrame, coverage: DataFrame, existing: DataFrame, candidates: DataFrame, max_new: int
) -> DataFrame:
    """The same greedy for any coverage relation (road networks, drive times, hand-made lists).

    ``weights`` is (region, distance_m, cell, w), ``coverage`` (region, distance_m, facility_ID, cell),
    ``existing`` and ``candidates`` (region, distance_m, ID). Cells are any comparable key; cells
    without a weight count nothing. Rows of covered cells leave the relation with every step, so what a
    step reads shrinks, and newly covered cells are broadcast while they are few: the relation stays in place.
    """
    spark = weights.sparkSession
    work = Workspace(spark)
    at_cell = [*COMBO, "cell"]
    listed = work.save(coverage.select(*COMBO, F.col("facility_ID").alias("ID"), "cell"), "listed")
    relation = work.save(deal(listed, listed.count(), *COMBO, "ID", "cell").distinct(), "relation")
    work.drop("listed")
    weighted = relation.join(weights.select(*at_cell, "w").filter("w > 0"), at_cell)
    ours = weighted.join(existing.select(*COMBO, "ID").distinct(), [*COMBO, "ID"], "left_semi")
    covered = work.save(ours.select(*at_cell, "w").distinct(), "covered")
    base = covered.groupBy(*COMBO).agg(F.sum("w").alias("base_w")).collect()
    chosen_from = candidates.select(*COMBO, "ID").distinct().join(existing.select(*COMBO, "ID"), [*COMBO, "ID"], "left_anti")
    remaining = work.save(
        weighted.join(chosen_from, [*COMBO, "ID"], "left_semi").join(covered.select(*at_cell), at_cell, "left_anti"), "remaining-0"
    )
    gains = remaining.groupBy(*COMBO, "ID").agg(F.sum("w").alias("gain"), F.count(F.lit(1)).alias("n")).withColumn("cell", F.lit(None).cast("long"))
    turn = 0

    def ahead(gains: DataFrame, picks: list[tuple], taken: dict[tuple, int]) -> list:
        def reach_of(combo: tuple, leaders: list[dict], cells: pa.Table) -> tuple[np.ndarray, Callable]:
            place = {r["ID"]: i for i, r in enumerate(leaders)}
            site = np.array([place[name] for name in cells.column("ID").to_pylist()], np.int64)
            keys = cells.column("cell").combine_chunks().dictionary_encode()
            at, order = keys.indices.to_numpy(), np.argsort(site, kind="stable")
            weights = np.zeros(len(keys.dictionary), np.int64)
            weights[at] = cells.column("w").to_numpy()
            ends = np.searchsorted(site[order], np.arange(len(leaders) + 1))
            return weights, lambda i: at[order[ends[i] : ends[i + 1]]]

        front = work.save(_front(gains, "n"), f"front-{len(picks)}")
        leaders = front.filter("led AND _fits").select(*COMBO, "ID")
        found = _batch(front, lookup_join(remaining, leaders, [*COMBO, "ID"], "left_semi"), reach_of, taken, max_new)
        work.drop(f"front-{len(picks)}")
        return found

    def shrink(gains: DataFrame, step: list[tuple], done: list[tuple]) -> DataFrame:
        nonlocal remaining, turn
        turn += 1
        if turn > 1:
            # The gains were written since, so nothing reads the version before the last any more.
            work.drop(f"remaining-{turn - 2}")
        now = local_rows(spark, [(s[0], s[1], s[3]) for s in step], ID_SCHEMA)
        fresh = work.save(remaining.join(broadcast_if(now, len(step)), [*COMBO, "ID"]).select(*at_cell), f"fresh-{turn}")
        lost = lookup_join(remaining, fresh, at_cell, "left_semi").groupBy(*COMBO, "ID").agg(F.sum("w").alias("lost"))
        remaining = work.save(lookup_join(remaining, fresh, at_cell, "left_anti"), f"remaining-{turn}")
        return gains.join(lost, [*COMBO, "ID"], "left").select(
            *COMBO, "cell", "ID", (F.col("gain") - F.coalesce(F.col("lost"), F.lit(0))).alias("gain"), "n"
        )

    picks = _greedy(gains, ahead, shrink, max_new, work)
    work.close()
    return _steps(spark, picks, base).drop("cell")


def selected_facilities(steps: DataFrame) -> DataFrame:
    """Per step the ids chosen up to it, as an array (steps per combination are bounded by ``max_new``)."""
    running = Window.partitionBy(*COMBO).orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("selected_facilities", F.collect_list("facility_id").over(running))


def first_covering_step(steps: DataFrame, cells: DataFrame, existing: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """``cells`` (region, cell, w) per distance with ``step``: 0 if an existing site reaches the cell, else
    the first step that does, else NULL. Every later question about steps reads this one column."""
    per = weights_per_distance(cells, distances_m, grid)
    known = cover_counts(per, sites=site_cells(existing, distances_m, grid))
    rings = ", ".join(f"{int(d)}, {grid.rings(d)}" for d in distances_m)
    reach = (
        explode_disk(steps.select(*COMBO, "p", "cell"), f"map({rings})[distance_m]")
        .groupBy(*COMBO, F.col("disk_cell").alias("cell"))
        .agg(F.min("p").alias("_p"))
    )
    return (
        known.join(reach, [*COMBO, "cell"], "left")
        .withColumn("step", F.when(F.col("sites") > 0, 0).otherwise(F.col("_p")))
        .drop("sites", "_p")
    )


def new_sites(steps: DataFrame, candidates: DataFrame) -> DataFrame:
    """Steps with the attributes of the chosen candidate."""
    where = candidates.select("region", F.col("ID").alias("facility_id"), "lat", "lon")
    return steps.join(where, ["region", "facility_id"], "left")
