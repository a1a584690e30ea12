"""Hexagonal grid as plain Column arithmetic.

A grid is an equirectangular projection (scaled at one reference latitude) tiled with pointy-top
hexagons. A cell id packs the axial coordinates (q, r) into one BIGINT, so a neighbour is an integer
addition, a distance needs no lookup, and joins are plain equi-joins on a long. Only + - * / floor
and abs are used: every expression stays inside whole-stage codegen and gives the same bits in any
IEEE engine.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Average hexagon edge length in metres per resolution.
EDGE_M = {4: 22606, 5: 8544, 6: 3229, 7: 1220, 8: 461, 9: 174, 10: 66}

METRES_PER_DEGREE = 111_320.0
Q_SHIFT = 28
OFFSET = 1 << 27
R_MASK = (1 << Q_SHIFT) - 1


def _edge(resolution: int) -> int:
    if resolution not in EDGE_M:
        raise ValueError(f"H3 resolution must be 4-10, got {resolution}")
    return EDGE_M[resolution]


def k_rings(distance_m: float, resolution: int) -> int:
    """Number of rings whose edge lengths add up to at least ``distance_m``."""
    return math.ceil(distance_m / _edge(resolution))


def k_rings_col(distance_m: Column, resolution: Column) -> Column:
    """``k_rings`` per row; an unsupported resolution fails the query."""
    edge = F.raise_error(F.concat(F.lit("H3 resolution must be 4-10, got "), resolution.cast("string"))).cast("int")
    for res, metres in sorted(EDGE_M.items()):
        edge = F.when(resolution == res, F.lit(metres)).otherwise(edge)
    return F.ceil(distance_m / edge).cast("int")


def disk_size(k: int) -> int:
    """Cells within ``k`` rings of a cell, the cell included."""
    return 1 + 3 * k * (k + 1)


@dataclass(frozen=True)
class HexGrid:
    """One resolution of the grid; joins never mix grids, so the resolution is not part of the id."""

    resolution: int = 8
    ref_lat: float = 0.0

    @property
    def edge_m(self) -> int:
        return _edge(self.resolution)

    @property
    def dx(self) -> float:
        """Degrees of longitude between neighbouring centres of one row."""
        return math.sqrt(3.0) * self.edge_m / (METRES_PER_DEGREE * math.cos(math.radians(self.ref_lat)))

    @property
    def dy(self) -> float:
        """Degrees of latitude between rows."""
        return 1.5 * self.edge_m / METRES_PER_DEGREE

    def rings(self, distance_m: float) -> int:
        return k_rings(distance_m, self.resolution)

    def cell(self, lon: str, lat: str) -> Column:
        """lon/lat (SQL text) to cell id; NULL in, NULL out.

        The nearest centre follows from which strip the point is in along the three edge directions, so
        there is no comparison of rounding errors and the generated code stays small enough for the JIT.
        """
        x, y = f"({lon}) / {self.dx!r}D", f"({lat}) / {self.dy / 1.5!r}D"
        a, b, c = f"floor({x} + {x} + 1D)", f"floor({x} + {y} + 1D)", f"floor({y} - {x} + 1D)"
        q_plus_r, r = f"floor(({a} + {b}) / 3D)", f"floor(({b} + {c}) / 3D)"
        origin = OFFSET * (1 << Q_SHIFT) + OFFSET
        return F.expr(f"{q_plus_r} * {1 << Q_SHIFT}L - {r} * {R_MASK}L + {origin}L")

    def center_lon(self, cell: Column) -> Column:
        return (q_of(cell) + r_of(cell) / F.lit(2.0)) * F.lit(self.dx)

    def center_lat(self, cell: Column) -> Column:
        return r_of(cell) * F.lit(self.dy)


def pack(q: Column, r: Column) -> Column:
    return ((q.cast("long") + OFFSET) * (1 << Q_SHIFT) + (r.cast("long") + OFFSET)).cast("long")


def q_of(cell: Column) -> Column:
    return F.shiftright(cell, Q_SHIFT) - OFFSET


def r_of(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit(R_MASK)) - OFFSET


def distance_sql(a: str, b: str) -> str:
    """Rings between two cells, as SQL text over column names."""
    dq = f"(shiftright({a}, {Q_SHIFT}) - shiftright({b}, {Q_SHIFT}))"
    dr = f"(({a} & {R_MASK}L) - ({b} & {R_MASK}L))"
    return f"CAST((abs({dq}) + abs({dr}) + abs({dq} + {dr})) / 2 AS INT)"


def hex_distance(a: str, b: str) -> Column:
    return F.expr(distance_sql(a, b))


def hex_distance_int(a: int, b: int) -> int:
    """``hex_distance`` for two ids already on the driver."""
    dq = (a >> Q_SHIFT) - (b >> Q_SHIFT)
    dr = (a & R_MASK) - (b & R_MASK)
    return (abs(dq) + abs(dr) + abs(dq + dr)) // 2


def row_sql(cell: str) -> str:
    return f"(({cell} & {R_MASK}L) - {OFFSET}L)"


def q_sql(cell: str) -> str:
    return f"(shiftright({cell}, {Q_SHIFT}) - {OFFSET}L)"


def explode_disk(df: DataFrame, k: str, center: str = "cell", out: str = "disk_cell", ring: str = "ring") -> DataFrame:
    """One row per cell within ``k`` (SQL text) rings of ``center``; adds ``out`` and ``ring``.

    Neighbour ids are the centre id plus a packed offset: no offset table, no join.
    """
    return (
        df.selectExpr("*", f"CAST({k} AS INT) AS _k")
        .selectExpr("*", "explode(sequence(-_k, _k)) AS _dq")
        .selectExpr("*", "explode(sequence(greatest(-_k, -_dq - _k), least(_k, _k - _dq))) AS _dr")
        .selectExpr(
            *df.columns,
            f"{center} + _dq * {1 << Q_SHIFT}L + _dr AS {out}",
            f"CAST((abs(_dq) + abs(_dr) + abs(_dq + _dr)) / 2 AS INT) AS {ring}",
        )
    )


def explode_disk_rows(df: DataFrame, k: str, center: str = "cell") -> DataFrame:
    """The same disk as 2k+1 horizontal runs: adds ``row``, ``q_lo`` and ``q_hi`` (both inclusive).

    A disk of 3k(k+1)+1 cells needs only 2k+1 rows this way, which is what the sweep operators shuffle.
    """
    return (
        df.selectExpr("*", f"CAST({k} AS INT) AS _k")
        .selectExpr("*", "explode(sequence(-_k, _k)) AS _dr")
        .selectExpr(
            *df.columns,
            f"{row_sql(center)} + _dr AS row",
            f"{q_sql(center)} + greatest(-_k, -_dr - _k) AS q_lo",
            f"{q_sql(center)} + least(_k, _k - _dr) AS q_hi",
        )
    )


def per_distance(df: DataFrame, distances_m, grid: HexGrid) -> DataFrame:
    """Add ``distance_m`` and ``k``: one copy of every row per distance, all distances in one plan."""
    pairs = ", ".join(f"struct({int(d)} AS distance_m, {grid.rings(d)} AS k)" for d in distances_m)
    return df.selectExpr("*", f"inline(array({pairs}))")
