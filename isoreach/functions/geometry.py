"""WKT geometry with built-in expressions only.

Tables keep geometry as WKT text. Parsing yields rings, and rings yield edges with the lower end
first, so an edge shared by two polygons evaluates to the same double from both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER_PAIR = r"\[([-+0-9.eE]+),([-+0-9.eE]+)[^\[\]]*\]"


def number_text(v: Column) -> Column:
    """Coordinate as WKT text: no trailing zeros and no exponent (28, 28.1, 0.0001)."""
    fixed = F.regexp_replace(v.cast("decimal(38,16)").cast("string"), r"\.?0+$", "")
    small_or_large = (F.abs(v) < 1e-3) | (F.abs(v) >= 1e7)
    return (
        F.when(v == F.floor(v), F.floor(v).cast("long").cast("string")).when(small_or_large, fixed).otherwise(v.cast("string"))
    )


def point_wkt(lon: Column, lat: Column) -> Column:
    """``POINT (lon lat)``; NULL when either coordinate is."""
    return F.when(
        lon.isNotNull() & lat.isNotNull(), F.concat(F.lit("POINT ("), number_text(lon), F.lit(" "), number_text(lat), F.lit(")"))
    )


def point_x(wkt: Column) -> Column:
    return F.nullif(F.regexp_extract(wkt, r"POINT\s*\(\s*([-+0-9.eE]+)", 1), F.lit("")).cast("double")


def point_y(wkt: Column) -> Column:
    return F.nullif(F.regexp_extract(wkt, r"POINT\s*\(\s*[-+0-9.eE]+\s+([-+0-9.eE]+)", 1), F.lit("")).cast("double")


def has_geometry(wkt: Column) -> Column:
    """False for NULL and blank WKT."""
    return F.coalesce(F.length(F.trim(wkt)) > 0, F.lit(False))


def geojson_wkt(kind: Column, coordinates: Column) -> Column:
    """GeoJSON geometry (type name, coordinates as JSON text) to WKT, by rewriting the text."""
    body = F.regexp_replace(F.regexp_replace(coordinates, r"\s+", ""), _NUMBER_PAIR, "$1 $2")
    body = F.replace(F.translate(body, "[]", "()"), F.lit(","), F.lit(", "))
    body = F.regexp_replace(body, r"(\d)\.0+(?=[ ,)]|$)", "$1")
    body = F.when(kind == "Point", F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)
    return F.when(kind.isNotNull() & coordinates.isNotNull(), F.concat(F.upper(kind), F.lit(" "), body))


def wkt_geojson(wkt: Column) -> Column:
    """WKT (POINT, POLYGON, MULTIPOLYGON) to a GeoJSON geometry object as JSON text."""
    kind = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)", 1))
    name = F.when(kind == "POINT", "Point").when(kind == "POLYGON", "Polygon").when(kind == "MULTIPOLYGON", "MultiPolygon")
    body = F.regexp_replace(wkt, r"^\s*[A-Za-z]+\s*", "")
    body = F.regexp_replace(body, r"([-+0-9.eE]+)\s+([-+0-9.eE]+)", "[$1, $2]")
    body = F.when(kind == "POINT", F.regexp_replace(body, r"[()]", "")).otherwise(F.translate(body, "()", "[]"))
    return F.when(
        name.isNotNull(), F.concat(F.lit('{"type": "'), name, F.lit('", "coordinates": '), body, F.lit("}"))
    )


def _points(ring_text: str) -> str:
    return (
        f"transform(split(trim({ring_text}), '\\\\s*,\\\\s*'), p -> struct("
        "CAST(split(p, '\\\\s+')[0] AS DOUBLE) AS x, CAST(split(p, '\\\\s+')[1] AS DOUBLE) AS y))"
    )


def rings_sql(wkt: str) -> str:
    texts = f"regexp_extract_all(coalesce({wkt}, ''), '(\\\\(+[^()]+)\\\\)', 1)"
    points = _points("translate(t, '(', '')")
    return f"transform({texts}, t -> struct(NOT startswith(t, '((') AS hole, {points} AS pts))"


def wkt_rings(wkt: str = "geometry_wkt") -> Column:
    """POLYGON/MULTIPOLYGON text to ARRAY<STRUCT<hole, pts ARRAY<STRUCT<x, y>>>>.

    A ring opened by a single parenthesis follows another ring of the same polygon, so it is a hole.
    """
    return F.expr(rings_sql(wkt))


def _ring_edges(pts: str) -> str:
    n = f"size({pts}) - 1"
    low_first = ", ".join(
        f"IF(a.y <= b.y, {low}, {high}) AS {name}"
        for name, low, high in (("x1", "a.x", "b.x"), ("y1", "a.y", "b.y"), ("x2", "b.x", "a.x"), ("y2", "b.y", "a.y"))
    )
    return f"zip_with(slice({pts}, 1, {n}), slice({pts}, 2, {n}), (a, b) -> struct({low_first}))"


def wkt_edges(wkt: str = "geometry_wkt") -> Column:
    """All edges of a polygon, lower end first; empty for NULL or blank text."""
    return F.expr(f"flatten(transform({rings_sql(wkt)}, ring -> {_ring_edges('ring.pts')}))")


def polygon_edges(polygons: DataFrame, keys: list[str], wkt: str = "geometry_wkt") -> DataFrame:
    """One row per edge: ``keys`` + x1, y1, x2, y2. Rings are exploded before their points are parsed.

    The text is bound to a name first: Spark would move a condition on it, and with it the text's making where that is
    an expression, below what deals the polygons over tasks. Null and blank texts have no rings.
    """
    return (
        polygons.selectExpr(*keys, f"explode(array({wkt})) AS _wkt")
        .selectExpr(*keys, "explode(regexp_extract_all(_wkt, '\\\\(([^()]+)\\\\)', 1)) AS _ring")
        .selectExpr(*keys, f"explode(array({_points('_ring')})) AS _pts")
        .selectExpr(*keys, f"inline({_ring_edges('_pts')})")
    )


def crossing_x(px_y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """x where the edge meets the horizontal line y = ``px_y``; NULL for a horizontal edge."""
    return x1 + (px_y - y1) * (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0))


def ray_crosses(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Does the ray to the right of the point cross the edge? Half-open in y, so vertices count once."""
    return (y1 <= py) & (py < y2) & (px < crossing_x(py, x1, y1, x2, y2))


def on_edge(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Does the point lie on the edge?"""
    flat = (y1 == y2) & (py == y1) & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
    steep = (y1 < y2) & (py >= y1) & (py <= y2) & (px == crossing_x(py, x1, y1, x2, y2))
    end = ((px == x1) & (py == y1)) | ((px == x2) & (py == y2))
    return flat | steep | end


def beside_edge(py: Column, y1: Column, y2: Column) -> Column:
    """Is the point at a height of the edge? Where it is not it cannot lie ``on_edge``, which is longer to tell."""
    return (py >= y1) & (py <= y2)


def edges_contain(edges: Column, px: Column, py: Column, boundary: str = "strict") -> Column:
    """Point in polygon on an edge array. ``boundary``: strict, half_open or inclusive."""
    odd = F.size(F.filter(edges, lambda e: ray_crosses(px, py, e["x1"], e["y1"], e["x2"], e["y2"]))) % 2 == 1
    touches = F.exists(edges, lambda e: on_edge(px, py, e["x1"], e["y1"], e["x2"], e["y2"]))
    return {"half_open": odd, "strict": odd & ~touches, "inclusive": odd | touches}[boundary]


def polygon_bounds(wkt: str = "geometry_wkt") -> Column:
    """STRUCT<minx, miny, maxx, maxy>."""
    low_high = {"minx": "min(x)", "miny": "min(y)", "maxx": "max(x)", "maxy": "max(y)"}
    parts = ", ".join(
        f"array_{call[:3]}(transform(pts, p -> p.{call[4]})) AS {name}" for name, call in low_high.items()
    )
    # transform over a one-element array binds the parsed points to a name, so they are parsed once.
    return F.expr(f"transform(array(flatten(transform({rings_sql(wkt)}, ring -> ring.pts))), pts -> struct({parts}))[0]")


def area_moments(wkt: str = "geometry_wkt") -> Column:
    """STRUCT<area, mx, my>: area and first moments; holes subtract whatever way they turn.

    Each ring is measured from its own first vertex, which keeps small polygons accurate. Moments add
    up across polygons, so a union centroid is sum(mx)/sum(area).
    """
    o = "element_at(ring.pts, 1)"
    n = "size(ring.pts) - 1"
    cross = f"(a.x - {o}.x) * (b.y - {o}.y) - (b.x - {o}.x) * (a.y - {o}.y)"
    triangles = (
        f"zip_with(slice(ring.pts, 1, {n}), slice(ring.pts, 2, {n}), (a, b) -> "
        f"struct({cross} AS c, a.x + b.x - 2 * {o}.x AS sx, a.y + b.y - 2 * {o}.y AS sy))"
    )
    zero = "named_struct('area', 0D, 'mx', 0D, 'my', 0D)"
    ring_sum = (
        f"aggregate({triangles}, {zero}, (s, e) -> named_struct("
        "'area', s.area + e.c / 2, 'mx', s.mx + e.c * e.sx / 6, 'my', s.my + e.c * e.sy / 6), "
        "s -> named_struct("
        f"'area', abs(s.area), 'mx', signum(s.area) * (s.mx + s.area * {o}.x), 'my', signum(s.area) * (s.my + s.area * {o}.y)))"
    )
    signed = f"transform({rings_sql(wkt)}, ring -> struct(IF(ring.hole, -1D, 1D) AS sign, {ring_sum} AS m))"
    return F.expr(
        f"aggregate({signed}, {zero}, (t, r) -> named_struct("
        "'area', t.area + r.sign * r.m.area, 'mx', t.mx + r.sign * r.m.mx, 'my', t.my + r.sign * r.m.my))"
    )


def mercator_to_lonlat(x: Column, y: Column) -> Column:
    """EPSG:3857 metres to EPSG:4326 degrees as STRUCT<lon, lat>."""
    radius = 6378137.0
    lon = F.degrees(x / radius)
    lat = F.degrees(F.atan(F.exp(y / radius)) * 2) - 90.0
    return F.struct(lon.alias("lon"), lat.alias("lat"))
