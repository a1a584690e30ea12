"""The query roster as plain SQL for another engine, from its own formulas.

Polygons enter as edge rows built from the lattice formula, never from WKT; catchments are pairwise
hexagon distances, never runs; polyfill is a ray cast per cell, never a scan line; the greedy loop is
a recursion over uncovered cells. Double literals carry an exponent so that they are not read as decimals.
"""

from __future__ import annotations

from isoreach.functions.hexgrid import EDGE_M, OFFSET, Q_SHIFT
from isoreach.plans.fixtures import COUNTRY, DISTANCES, FINE_GRID, FINE_SPACING, GRID, SPACING

DX, DY = f"{GRID.dx!r}e0", f"{GRID.dy!r}e0"
# UTM on WGS 84, scaled meridian radius in metres, eccentricity, and the terms of the series.
UTM_RADIUS, UTM_E = "6364902.166165087e0", "0.08181919084262149e0"
UTM_WAVES = [(1, 0.0008377318206303529), (2, 7.608527714248998e-07), (3, 1.1976380015605232e-09), (4, 2.4433761945220637e-12)]
STEPS = 55
TARGET = 90


def with_ctes(*names: str, select: str) -> str:
    """``select`` preceded by the named CTEs and everything they need, each once, in order."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        body = CTES[name]
        for other in CTES:
            if other != name and f"{{{other}}}" in body:
                need(other)
        order.append(name)

    for name in names:
        need(name)
    texts = []
    for name in order:
        body = CTES[name]
        for other in CTES:
            body = body.replace(f"{{{other}}}", other)
        texts.append(f"{name} AS ({body})")
    return "WITH RECURSIVE " + ",\n".join(texts) + "\n" + select


def lon(k: str) -> str:
    return f"(22e0 + (({k}) * 7919 % 100003) / 100003e0 * 11e0)"


def lat(k: str) -> str:
    return f"(-18e0 + (({k}) * 104729 % 99991) / 99991e0 * 10e0)"


def hexed(source: str, x: str, y: str, out: str = "cell") -> str:
    """``source`` rows plus q, r and the packed cell."""
    return f"""SELECT * EXCLUDE (rf, qf, q0, r0, s0, eq, er, es), ((q + {OFFSET}) * {1 << Q_SHIFT} + (r + {OFFSET}))::BIGINT AS {out}
      FROM (SELECT *, (CASE WHEN eq > er AND eq > es THEN -r0 - s0 ELSE q0 END)::BIGINT AS q,
                   (CASE WHEN NOT (eq > er AND eq > es) AND er > es THEN -q0 - s0 ELSE r0 END)::BIGINT AS r
      FROM (SELECT *, abs(q0 - qf) AS eq, abs(r0 - rf) AS er, abs(s0 + qf + rf) AS es
      FROM (SELECT *, floor(qf + 0.5e0) AS q0, floor(rf + 0.5e0) AS r0, floor(0.5e0 - qf - rf) AS s0
      FROM (SELECT *, {x} / {DX} - rf / 2e0 AS qf FROM (SELECT *, {y} / {DY} AS rf FROM {source})))))"""


def rings(d: int) -> int:
    return GRID.rings(d)


def dist(a: str, b: str) -> str:
    dq, dr = f"({a}.q - {b}.q)", f"({a}.r - {b}.r)"
    return f"((abs({dq}) + abs({dr}) + abs({dq} + {dr})) // 2)"


def pct(part: str, whole: str) -> str:
    return f"(CASE WHEN {whole} > 0 THEN floor(coalesce({part}, 0) * 100e0 / {whole} * 100e0 + 0.5e0) / 100e0 ELSE 0e0 END)"


def crosses(px: str, py: str) -> str:
    return f"(y1 <= {py} AND {py} < y2 AND {px} < x1 + ({py} - y1) * (x2 - x1) / (y2 - y1))"


def touches(px: str, py: str) -> str:
    return (
        f"((y1 = y2 AND {py} = y1 AND {px} BETWEEN least(x1, x2) AND greatest(x1, x2))"
        f" OR (y1 < y2 AND {py} BETWEEN y1 AND y2 AND {px} = x1 + ({py} - y1) * (x2 - x1) / (y2 - y1))"
        f" OR ({px} = x1 AND {py} = y1) OR ({px} = x2 AND {py} = y2))"
    )


def low_first(xa: str, ya: str, xb: str, yb: str) -> str:
    up = f"{ya} <= {yb}"
    return (
        f"CASE WHEN {up} THEN {xa} ELSE {xb} END AS x1, CASE WHEN {up} THEN {ya} ELSE {yb} END AS y1,"
        f" CASE WHEN {up} THEN {xb} ELSE {xa} END AS x2, CASE WHEN {up} THEN {yb} ELSE {ya} END AS y2"
    )


def num(v: str) -> str:
    return f"regexp_replace(({v})::VARCHAR, '\\.0$', '')"


def milli(v: str) -> str:
    return f"(floor(({v}) * 1000 + 0.5e0) / 1000e0)"


def vertex(i: str, j: str) -> tuple[str, str]:
    dx = f"(CASE WHEN ({i}) IN (0, 5) THEN 0e0 ELSE ((({i}) * 31 + ({j}) * 17) % 11 - 5) / 11e0 * 0.4e0 END)"
    dy = f"(CASE WHEN ({j}) IN (0, 5) THEN 0e0 ELSE ((({i}) * 13 + ({j}) * 29) % 11 - 5) / 11e0 * 0.4e0 END)"
    return f"(22e0 + ({i}) * 2.2e0 + {dx})", f"(-18e0 + ({j}) * 2e0 + {dy})"


def _district_edges() -> str:
    i, j = "(n_nationkey % 5)", "(n_nationkey // 5)"
    at = [vertex(i, j), vertex(f"{i} + 1", j), vertex(f"{i} + 1", f"{j} + 1"), vertex(i, f"{j} + 1")]
    sides = []
    for a, b in zip(at, [*at[1:], at[0]], strict=True):
        sides.append(f"SELECT n_nationkey AS n, r_name AS province, n_name AS LGU, {low_first(a[0], a[1], b[0], b[1])} FROM nation JOIN region ON n_regionkey = r_regionkey")
    return " UNION ALL ".join(sides)


def _parcel_boxes() -> str:
    x, y = "(22e0 + c_custkey * 7919 % 10007 / 1000e0)", "(-18e0 + c_custkey * 104729 % 9973 / 1000e0)"
    w, h = "(0.02e0 + c_custkey % 7 / 1000e0)", "(0.02e0 + c_custkey % 5 / 1000e0)"
    one = "SELECT c_custkey AS key, {part} AS part, {hole} AS hole, {x0} AS xlo, {y0} AS ylo, {x1} AS xhi, {y1} AS yhi FROM customer {where}"

    def box(part, hole, x0, y0, bw, bh, where):
        return one.format(part=part, hole=hole, x0=milli(x0), y0=milli(y0), x1=milli(f"{x0} + {bw}"), y1=milli(f"{y0} + {bh}"), where=where)

    return " UNION ALL ".join(
        [
            box(0, "false", x, y, w, h, ""),
            box(0, "true", f"{x} + 0.005e0", f"{y} + 0.005e0", "0.01e0", "0.01e0", "WHERE c_custkey % 3 = 0"),
            box(1, "false", f"{x} + 0.1e0", y, w, h, "WHERE c_custkey % 5 = 0"),
        ]
    )


def _box_edges() -> str:
    corners = [("xlo", "ylo"), ("xhi", "ylo"), ("xhi", "yhi"), ("xlo", "yhi")]
    return " UNION ALL ".join(
        f"SELECT key, {low_first(a[0], a[1], b[0], b[1])} FROM {{parcel_boxes}}"
        for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)
    )


def _ring_text(x0="xlo", y0="ylo", x1="xhi", y1="yhi") -> str:
    pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return "'(' || " + " || ', ' || ".join(f"{num(x)} || ' ' || {num(y)}" for x, y in pts) + " || ')'"


CTES: dict[str, str] = {
    "orders_at": f"SELECT o_orderkey AS key, {lon('o_orderkey')} AS xcoord, {lat('o_orderkey')} AS ycoord, floor(o_totalprice / 1000) - 20 AS population FROM orders",
    "pix": hexed("{orders_at}", "xcoord", "ycoord", "h3_index") + " WHERE population > 0",
    "fac": hexed(f"(SELECT s_suppkey AS osm_id, s_name AS name, {lon('s_suppkey + 500000')} AS lon, {lat('s_suppkey + 500000')} AS lat, s_suppkey || '_current' AS ID FROM supplier)", "lon", "lat"),
    "box": f"""SELECT r_name AS region, 22e0 + r_regionkey * 2.2e0 AS xlo, 22e0 + (r_regionkey + 1) * 2.2e0 AS xhi, -18e0 AS ylo, -8e0 AS yhi FROM region
      UNION ALL SELECT '{COUNTRY}', 22e0 + min(r_regionkey) * 2.2e0, 22e0 + (max(r_regionkey) + 1) * 2.2e0, -18e0, -8e0 FROM region""",
    "lattice": f"""SELECT q, r, (q + r / 2e0) * {DX} AS x, r * {DY} AS y, ((q + {OFFSET}) * {1 << Q_SHIFT} + (r + {OFFSET}))::BIGINT AS cell
      FROM (SELECT unnest(range((floor(-18e0 / {DY}) - 1)::BIGINT, (ceil(-8e0 / {DY}) + 2)::BIGINT)) AS r),
           LATERAL (SELECT unnest(range((floor(22e0 / {DX} - r / 2e0) - 2)::BIGINT, (ceil(33e0 / {DX} - r / 2e0) + 3)::BIGINT)) AS q)""",
    "rcell": "SELECT region, cell, q, r FROM {lattice} JOIN {box} ON xlo <= x AND x < xhi AND ylo <= y AND y < yhi",
    "dedge": _district_edges(),
    "dcell": f"SELECT province, LGU, cell FROM {{lattice}}, {{dedge}} WHERE {crosses('x', 'y')} GROUP BY province, LGU, cell HAVING count(*) % 2 = 1",
    "aoi": "SELECT region, p.* FROM {pix} p JOIN {rcell} c ON p.h3_index = c.cell",
    "rpop": "SELECT region, h3_index AS cell, any_value(q) AS q, any_value(r) AS r, sum(population) AS w, count(*) AS pixels FROM {aoi} GROUP BY region, h3_index",
    "ds": " UNION ALL ".join(f"SELECT {d} AS distance_m, {rings(d)} AS k" for d in DISTANCES),
    "ex": "SELECT region, f.* FROM {fac} f JOIN {box} ON xlo < lon AND lon < xhi AND ylo < lat AND lat < yhi",
    "gridpt": f"""SELECT region, ix, iy, x0 + ix * {SPACING}e0 AS longitude, y0 + iy * {SPACING}e0 AS latitude, ix || '_' || iy || '_potential' AS ID
      FROM (SELECT *, floor(xlo) AS x0, floor(ylo) AS y0 FROM {{box}}),
           LATERAL (SELECT unnest(range(ceil((ceil(xhi) - x0) / {SPACING}e0)::BIGINT)) AS ix),
           LATERAL (SELECT unnest(range(ceil((ceil(yhi) - y0) / {SPACING}e0)::BIGINT)) AS iy)
      WHERE x0 + ix * {SPACING}e0 BETWEEN xlo AND xhi AND y0 + iy * {SPACING}e0 BETWEEN ylo AND yhi""",
    "cand": hexed("{gridpt}", "longitude", "latitude"),
    "exc": f"SELECT e.region, d.distance_m, e.ID, e.q AS sq, e.r AS sr, w.cell, w.w, {dist('e', 'w')} AS ring FROM {{ex}} e JOIN {{rpop}} w ON e.region = w.region JOIN {{ds}} d ON {dist('e', 'w')} <= d.k",
    "cac": f"SELECT e.region, d.distance_m, e.ID, w.cell, w.w, {dist('e', 'w')} AS ring FROM {{cand}} e JOIN {{rpop}} w ON e.region = w.region JOIN {{ds}} d ON {dist('e', 'w')} <= d.k",
    "cov": """SELECT w.region, d.distance_m, w.cell, w.w,
        (w.region, d.distance_m, w.cell) IN (SELECT (region, distance_m, cell) FROM {exc}) AS now,
        (w.region, d.distance_m, w.cell) IN (SELECT (region, distance_m, cell) FROM {cac}) AS more
      FROM {rpop} w, {ds} d""",
    "summary": f"""SELECT region, distance_m, sum(w) AS total_population, sum(CASE WHEN now THEN w ELSE 0 END) AS covered_population,
        sum(CASE WHEN now OR more THEN w ELSE 0 END) AS coverable_population,
        {pct('sum(CASE WHEN now THEN w ELSE 0 END)', 'sum(w)')} AS current_access,
        {pct('sum(CASE WHEN now OR more THEN w ELSE 0 END)', 'sum(w)')} AS max_access FROM {{cov}} GROUP BY region, distance_m""",
    "bands": """SELECT region, min(population) FILTER (c >= ceil(0.25 * n)) AS t1, min(population) FILTER (c >= ceil(0.5 * n)) AS t2, min(population) FILTER (c >= ceil(0.75 * n)) AS t3
      FROM (SELECT region, population, count(*) OVER (PARTITION BY region ORDER BY population) AS c, count(*) OVER (PARTITION BY region) AS n FROM {aoi}) GROUP BY region""",
    "banded": "SELECT a.*, CASE WHEN population <= t1 THEN 0.1e0 WHEN population <= t2 THEN 0.3e0 WHEN population <= t3 THEN 0.6e0 ELSE 1e0 END AS opacity FROM {aoi} a JOIN {bands} b USING (region)",
    "r0": "SELECT c.* FROM {cac} c ANTI JOIN {exc} e USING (region, distance_m, cell)",
    "parcel_boxes": _parcel_boxes(),
    "parcel_edges": _box_edges(),
    "parcel_wkt": f"""SELECT key, CASE WHEN key % 5 = 0 THEN 'MULTIPOLYGON (' ELSE 'POLYGON ' END || string_agg(body, ', ' ORDER BY part) || CASE WHEN key % 5 = 0 THEN ')' ELSE '' END AS geometry_wkt
      FROM (SELECT key, part, '(' || string_agg({_ring_text()}, ', ' ORDER BY hole) || ')' AS body FROM {{parcel_boxes}} GROUP BY key, part) GROUP BY key""",
    "parcel": """SELECT c_custkey AS key, n_name AS ISO_A3, r_name AS NAM_0, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Muchinga' ELSE c_mktsegment END AS NAM_1, c_name AS NAM_2, geometry_wkt
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN {parcel_wkt} ON key = c_custkey""",
    "firststep": """SELECT v.region, v.distance_m, v.cell, v.w, CASE WHEN v.now THEN 0 ELSE min(s.p) END AS step
      FROM {cov} v LEFT JOIN (SELECT c.*, p FROM {cac} c JOIN {steps} s ON c.region = s.region AND c.distance_m = s.distance_m AND c.ID = s.facility_id) s
        ON v.region = s.region AND v.distance_m = s.distance_m AND v.cell = s.cell GROUP BY v.region, v.distance_m, v.cell, v.w, v.now""",
    "curves": f"""SELECT sp.region, sp.distance_m, sp.p, sp.province, sp.LGU, coalesce(sum(w) FILTER (step <= sp.p), 0) AS covered, coalesce(sum(w), 0) AS total,
        {pct('sum(w) FILTER (step <= sp.p)', 'sum(w)').replace('sum(w) > 0', 'coalesce(sum(w), 0) > 0')} AS access_pct
      FROM (SELECT s.region, s.distance_m, s.p, d.province, d.LGU FROM {{steps}} s, (SELECT DISTINCT province, LGU FROM {{dcell}}) d) sp
      LEFT JOIN (SELECT f.*, province, LGU FROM {{firststep}} f JOIN {{dcell}} USING (cell)) x
        ON x.region = sp.region AND x.distance_m = sp.distance_m AND x.province = sp.province AND x.LGU = sp.LGU
      GROUP BY sp.region, sp.distance_m, sp.p, sp.province, sp.LGU""",
    "osm": f"""SELECT osm_id, lat, lon, name FROM (
        SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY list) AS n FROM (
          SELECT c_custkey AS osm_id, {milli(lat('c_custkey'))} AS lat, {milli(lon('c_custkey'))} AS lon, 'Hospital ' || c_name AS name, 0 AS list FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 7 <> 0
          UNION ALL SELECT c_custkey, {milli(lat('c_custkey'))}, {milli(lon('c_custkey'))}, CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'Clinic ' || c_name END, 1 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 7 <> 0)) WHERE n = 1""",
}
# One row per cell not covered yet and one without a cell per combination; each round names the best site of the round.
CTES["walk"] = f"""(SELECT DISTINCT region, distance_m, 0 AS p, cell, w::DOUBLE AS w, NULL::VARCHAR AS ID, 0e0 AS gain FROM {{r0}}
      UNION ALL SELECT DISTINCT region, distance_m, 0, -1, 0e0, NULL, 0e0 FROM {{r0}})
    UNION ALL
    SELECT region, distance_m, p + 1, cell, w, best, best_gain FROM (
      SELECT *, first_value(ID) OVER best_first AS best, first_value(total) OVER best_first AS best_gain FROM (
        SELECT g.region, g.distance_m, g.p, g.cell, g.w, r.ID, CASE WHEN r.ID IS NULL THEN -1 ELSE sum(g.w) OVER (PARTITION BY g.region, g.distance_m, r.ID) END AS total
        FROM {{walk}} g LEFT JOIN {{r0}} r ON r.region = g.region AND r.distance_m = g.distance_m AND r.cell = g.cell WHERE g.p < {STEPS})
      WINDOW best_first AS (PARTITION BY region, distance_m ORDER BY total DESC, ID))
    WHERE best IS NOT NULL GROUP BY region, distance_m, p, cell, w, best, best_gain HAVING NOT coalesce(bool_or(ID = best), false)"""
CTES["picks"] = "SELECT region, distance_m, p, ID, gain FROM {walk} WHERE p > 0 AND cell = -1"
CTES["steps"] = """SELECT p.region, p.distance_m, p.p, p.ID AS facility_id, c.cell, c.longitude AS lon, c.latitude AS lat, p.gain,
    s.covered_population + sum(p.gain) OVER (PARTITION BY p.region, p.distance_m ORDER BY p.p) AS objective
  FROM {picks} p JOIN {cand} c ON c.region = p.region AND c.ID = p.ID JOIN {summary} s ON s.region = p.region AND s.distance_m = p.distance_m"""
CTES["located"] = f"""SELECT s.*, (SELECT arg_max(LGU, n) FROM (SELECT n, LGU FROM {{dedge}} e
      WHERE {crosses('s.lon', 's.lat')} OR {touches('s.lon', 's.lat')} GROUP BY n, LGU
      HAVING count(*) FILTER ({crosses('s.lon', 's.lat')}) % 2 = 1 AND NOT bool_or({touches('s.lon', 's.lat')}))) AS district FROM {{steps}} s"""
# Corners of the outline of lattice rows a..b, counterclockwise from the south-west; both outlines have one ring.
def _outline(name: str, key: str, rows: str) -> str:
    x, y = vertex("i", "j")
    sides = [("unnest(range(0, 5))", "lo", "i"), ("5", "unnest(range(lo, hi))", "5 + j - lo"), ("unnest(range(1, 6))", "hi", "10 + hi - lo - i"), ("0", "unnest(range(lo + 1, hi + 1))", "10 + 2 * (hi - lo) - (j - lo)")]
    parts = " UNION ALL ".join(f"SELECT {key}, i, j, {seq} AS s FROM (SELECT {key}, lo, hi, {i} AS i, {j} AS j FROM ({rows}))" for i, j, seq in sides)
    return f"SELECT {key}, 1 AS ring, s + 1 AS seq, {x} AS x, {y} AS y, false AS hole FROM ({parts})"


CTES["coutline"] = _outline("country", "iso3", "SELECT 'AOI' AS iso3, 0 AS lo, 5 AS hi")
CTES["soutline"] = _outline("strip", "strip", "SELECT strip, strip AS lo, strip + 1 AS hi FROM (SELECT unnest(range(0, 5)) AS strip)")
CTES["wide"] = "SELECT region, distance_m, p, LGU, " + pct("sum(covered)", "sum(total)") + " AS access_pct FROM {curves} GROUP BY region, distance_m, p, LGU"


# Clusters: cells, seeds from strips and tiles of equal weight, and ten rounds, each a table of its own.
KM, ROUNDS = 100, 10
STRIPS = 10
_XY = "(sum(sx) // sum(n))::BIGINT AS cx, (sum(sy) // sum(n))::BIGINT AS cy"
CTES["kcell"] = """SELECT *, (sx // n)::BIGINT AS x, (sy // n)::BIGINT AS y FROM (SELECT region, h3_index AS cell, count(*)::HUGEINT AS n, sum(round(xcoord * 1000000)::HUGEINT) AS sx,
    sum(round(ycoord * 1000000)::HUGEINT) AS sy FROM {aoi} GROUP BY region, h3_index)"""
CTES["kstrip"] = f"""SELECT c.*, (SELECT coalesce(sum(b.n), 0) FROM {{kcell}} b WHERE b.region = c.region AND floor(b.x / 10000) < floor(c.x / 10000)) * {STRIPS}
    // (SELECT sum(b.n) FROM {{kcell}} b WHERE b.region = c.region) AS strip FROM {{kcell}} c"""
CTES["km0"] = f"""SELECT region, k, {_XY} FROM (SELECT c.*, (strip * {KM // STRIPS} + (SELECT coalesce(sum(b.n), 0) FROM {{kstrip}} b WHERE b.region = c.region AND b.strip = c.strip AND floor(b.y / 10000) < floor(c.y / 10000)) * {KM // STRIPS}
    // (SELECT sum(b.n) FROM {{kstrip}} b WHERE b.region = c.region AND b.strip = c.strip))::INT AS k FROM {{kstrip}} c) GROUP BY region, k"""
for _i in range(1, ROUNDS + 1):
    CTES[f"kmg{_i}"] = f"""SELECT region, k, {_XY} FROM (SELECT c.region, c.cell, any_value(c.n) AS n, any_value(c.sx) AS sx, any_value(c.sy) AS sy,
        arg_min(m.k, {{'d': (m.cx - c.x) * (m.cx - c.x) + (m.cy - c.y) * (m.cy - c.y), 'k': m.k}}) AS k FROM {{kcell}} c JOIN {{km{_i - 1}}} m USING (region) GROUP BY c.region, c.cell) GROUP BY region, k"""
    CTES[f"km{_i}"] = f"SELECT o.region, o.k, coalesce(g.cx, o.cx) AS cx, coalesce(g.cy, o.cy) AS cy FROM {{km{_i - 1}}} o LEFT JOIN {{kmg{_i}}} g ON g.region = o.region AND g.k = o.k"


def _wide() -> str:
    names = [f"NATION_{i}" for i in range(25)]
    return ", ".join(f"coalesce(max(access_pct) FILTER (LGU = '{n}'), 0e0) AS lgu_{n}" for n in names)


def oracle_sql() -> dict[str, str]:
    edge_case = " ".join(f"WHEN {res} THEN {m}" for res, m in EDGE_M.items())
    q: dict[str, str] = {}

    def add(name: str, *ctes: str, select: str) -> None:
        q[name] = with_ctes(*ctes, select=select) if ctes else select

    add("hex_cell", "orders_at", select=f"SELECT key, h3_index FROM ({hexed('orders_at', 'xcoord', 'ycoord', 'h3_index')})")
    add(
        "hex_disk",
        select=f"""WITH c AS ({hexed(f"(SELECT c_custkey AS key, c_custkey % 4 AS k, {lon('c_custkey')} AS lon, {lat('c_custkey')} AS lat FROM customer)", "lon", "lat")})
          SELECT key, (cell + dq * {1 << Q_SHIFT} + dr)::BIGINT AS disk_cell, ((abs(dq) + abs(dr) + abs(dq + dr)) // 2)::INTEGER AS ring
          FROM c, (SELECT unnest(range(-3, 4)) AS dq), (SELECT unnest(range(-3, 4)) AS dr) WHERE (abs(dq) + abs(dr) + abs(dq + dr)) // 2 <= k""",
    )
    add(
        "k_rings",
        select=f"""SELECT resolution, ceil(l_extendedprice / (CASE resolution {edge_case} END))::INTEGER AS k, count(*) AS n
          FROM (SELECT l_extendedprice, 4 + l_linenumber % 7 AS resolution FROM lineitem) GROUP BY 1, 2""",
    )
    add("population_totals", "pix", select="SELECT sum(population) AS total_population, count(*) AS pixels FROM pix")
    add("population_by_cell", "pix", select="SELECT h3_index AS cell, sum(population) AS population, count(*) AS pixels FROM pix GROUP BY h3_index")
    add("population_by_region", "aoi", select="SELECT region, sum(population) AS total_pop, count(*) AS count FROM aoi GROUP BY region")
    add("population_aoi", "aoi", select="SELECT region, key || '_pop' AS ID, xcoord, ycoord, population, h3_index FROM aoi")
    add(
        "raster_pixels",
        select=f"""SELECT key, xcoord, ycoord, population, h3_index FROM ({hexed('''(SELECT (t // 64 * 32 + pos // 32) * 4294967296 + t % 64 * 32 + pos % 32 AS key, 22e0 + (t % 64 * 32 + pos % 32 + 0.5e0) * 0.01e0 AS xcoord, -8e0 + (t // 64 * 32 + pos // 32 + 0.5e0) * -0.01e0 AS ycoord, v AS population
            FROM (SELECT o_orderkey // 1024 AS t, o_orderkey % 1024 AS pos, floor(o_totalprice / 1000) - 200 AS v FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0) WHERE v > 0)''', 'xcoord', 'ycoord', 'h3_index')})""",
    )
    add("opacity_bands", "banded", select="SELECT region, key, opacity FROM banded")
    add("polygon_edges", "parcel_edges", select="SELECT key, x1, y1, x2, y2 FROM parcel_edges")
    add("polygon_bounds", "parcel_edges", select="SELECT key, min(least(x1, x2)) AS minx, min(y1) AS miny, max(greatest(x1, x2)) AS maxx, max(y2) AS maxy FROM parcel_edges GROUP BY key")
    add("polyfill", "rcell", "dcell", select="SELECT region AS name, cell FROM rcell UNION ALL SELECT LGU, cell FROM dcell")
    fx, fy = f"{FINE_GRID.dx!r}e0", f"{FINE_GRID.dy!r}e0"
    odd = "HAVING sum(CASE WHEN {inside} THEN 1 ELSE 0 END) % 2 = 1"
    add(
        "polyfill_parcels",
        "parcel_boxes",
        select=f"""SELECT key, cell FROM (SELECT key, (q + {OFFSET}) * {1 << Q_SHIFT} + r + {OFFSET} AS cell FROM (SELECT *, (q + r / 2e0) * {fx} AS x, r * {fy} AS y FROM parcel_boxes,
            LATERAL (SELECT unnest(range((floor(ylo / {fy}) - 1)::BIGINT, (ceil(yhi / {fy}) + 2)::BIGINT)) AS r),
            LATERAL (SELECT unnest(range((floor(xlo / {fx} - r / 2e0) - 2)::BIGINT, (ceil(xhi / {fx} - r / 2e0) + 3)::BIGINT)) AS q))
          WHERE xlo <= x AND x < xhi AND ylo <= y AND y < yhi) GROUP BY key, cell {odd.format(inside='true')}""",
    )
    s = f"{FINE_SPACING!r}e0"
    add(
        "grid_candidates_parcels",
        "parcel_boxes",
        select=f"""SELECT key, ix || '_' || iy || '_potential' AS ID, x AS longitude, y AS latitude FROM (
            SELECT *, x0 + ix * {s} AS x, y0 + iy * {s} AS y FROM (SELECT *, floor(min(xlo) OVER (PARTITION BY key)) AS x0, floor(min(ylo) OVER (PARTITION BY key)) AS y0,
                ceil(max(xhi) OVER (PARTITION BY key)) AS xe, ceil(max(yhi) OVER (PARTITION BY key)) AS ye FROM parcel_boxes),
              LATERAL (SELECT unnest(range((floor((xlo - x0) / {s}) - 1)::BIGINT, (ceil((xhi - x0) / {s}) + 2)::BIGINT)) AS ix),
              LATERAL (SELECT unnest(range((floor((ylo - y0) / {s}) - 1)::BIGINT, (ceil((yhi - y0) / {s}) + 2)::BIGINT)) AS iy))
          WHERE x BETWEEN xlo AND xhi AND y BETWEEN ylo AND yhi AND ix < ceil((xe - x0) / {s}) AND iy < ceil((ye - y0) / {s})
          GROUP BY key, ix, iy, x, y HAVING count(*) FILTER (NOT hole) > count(*) FILTER (hole AND x > xlo AND x < xhi AND y > ylo AND y < yhi)""",
    )
    add(
        "pixels_in_parcels",
        "pix",
        "parcel_boxes",
        select="""SELECT pixel, key FROM (SELECT p.key AS pixel, b.key, b.hole, xcoord > xlo AND xcoord < xhi AND ycoord > ylo AND ycoord < yhi AS strictly
            FROM pix p JOIN parcel_boxes b ON xcoord BETWEEN xlo AND xhi AND ycoord BETWEEN ylo AND yhi)
          GROUP BY pixel, key HAVING bool_or(NOT hole AND strictly) AND NOT bool_or(hole) AND NOT bool_or(NOT strictly)""",
    )
    add(
        "boundary_centroid",
        "parcel_boxes",
        select="""SELECT key, floor(sum(a * (xlo + xhi) / 2) / sum(a) * 1e6 + 0.5) / 1e6 AS center_lon, floor(sum(a * (ylo + yhi) / 2) / sum(a) * 1e6 + 0.5) / 1e6 AS center_lat, floor(sum(a) * 1e9 + 0.5) / 1e9 AS area
          FROM (SELECT *, (CASE WHEN hole THEN -1 ELSE 1 END) * (xhi - xlo) * (yhi - ylo) AS a FROM parcel_boxes) GROUP BY key""",
    )
    add("boundary_select", "parcel", select="SELECT key, ISO_A3, NAM_1, NAM_2 FROM parcel WHERE ISO_A3 = 'NATION_3' AND NAM_1 = 'MACHINERY'")
    add("lgu_normalize", "parcel", select="SELECT ISO_A3 AS iso3, NAM_1 AS province, NAM_2 AS LGU, geometry_wkt FROM parcel")
    add("name_corrections", "parcel", select="SELECT NAM_1, count(*) AS n FROM parcel GROUP BY NAM_1")
    add(
        "sanitize_names",
        select="""SELECT p_partkey, 'lgu_' || trim(regexp_replace(p_name || ' (' || p_brand || ') -' || p_type, '[^A-Za-z0-9]+', '_', 'g'), '_') AS safe_name,
            replace(lower(p_brand || '-' || p_type), '-', '_') AS label FROM part""",
    )
    add("province_names", "parcel", select="SELECT DISTINCT NAM_1 AS province FROM parcel WHERE ISO_A3 = 'NATION_3'")
    add("combinations", "parcel", "ds", select=f"SELECT region, distance_m, (distance_m // 1000) || 'km' AS label FROM (SELECT DISTINCT NAM_2 AS region FROM parcel UNION SELECT '{COUNTRY}'), ds")
    add(
        "wkt_roundtrip",
        "orders_at",
        select=f"SELECT key, 'POINT (' || {num(milli('xcoord'))} || ' ' || {num(milli('ycoord'))} || ')' AS geom_wkt, {milli('xcoord')} AS lon, {milli('ycoord')} AS lat FROM orders_at",
    )
    add("boundaries_geojson", "parcel", select="SELECT ISO_A3, NAM_0, NAM_1, NAM_2, geometry_wkt FROM parcel")
    add("boundaries_collection", "parcel", select="SELECT ISO_A3, NAM_0, NAM_1, NAM_2, geometry_wkt FROM parcel")
    add("facilities_file", "fac", select=f"SELECT ID, {milli('lon')} AS lon, {milli('lat')} AS lat, name FROM fac")
    add("facilities_projected", "fac", select=f"SELECT ID, {milli('lon')} AS lon, {milli('lat')} AS lat, name FROM fac")
    # Conformal latitude through inverse hyperbolic functions and complex tangents instead of square roots; constants by number.
    add(
        "projected_points",
        "pix",
        select=f"""SELECT key, zone, floor(100 * (500000e0 + {UTM_RADIUS} * (b + {' + '.join(f'{c!r} * cos({2 * j} * a) * sinh({2 * j} * b)' for j, c in UTM_WAVES)})))::BIGINT AS x_cm,
            floor(100 * (10000000e0 + {UTM_RADIUS} * (a + {' + '.join(f'{c!r} * sin({2 * j} * a) * cosh({2 * j} * b)' for j, c in UTM_WAVES)})))::BIGINT AS y_cm, TRUE AS returned
          FROM (SELECT key, zone, atan2(sinh(q), cos(l)) AS a, atanh(sin(l) / cosh(q)) AS b
            FROM (SELECT key, zone, radians(xcoord - (6 * zone - 183)) AS l, atanh(sin(radians(ycoord))) - {UTM_E} * atanh({UTM_E} * sin(radians(ycoord))) AS q
              FROM (SELECT key, xcoord, ycoord, (floor((xcoord + 180) / 6) + 1)::INTEGER AS zone FROM pix)))""",
    )
    add("csv_append", "fac", select=f"SELECT osm_id, name, {milli('lon')} AS lon, {milli('lat')} AS lat FROM fac")
    add(
        "unmatched_sites",
        "pix",
        "parcel_boxes",
        select="""SELECT count(*) AS unmatched FROM pix WHERE key NOT IN (SELECT pixel FROM (SELECT p.key AS pixel, b.key, b.hole, xcoord > xlo AND xcoord < xhi AND ycoord > ylo AND ycoord < yhi AS strictly
            FROM pix p JOIN parcel_boxes b ON xcoord BETWEEN xlo AND xhi AND ycoord BETWEEN ylo AND yhi)
          GROUP BY pixel, key HAVING bool_or(NOT hole AND strictly) AND NOT bool_or(hole) AND NOT bool_or(NOT strictly))""",
    )
    add("osm_elements", "osm", select="SELECT osm_id, lat, lon, name FROM osm")
    add("facility_ids", "osm", select="SELECT osm_id, osm_id || '_current' AS ID, lon, lat, name FROM osm")
    add("facilities_within", "ex", select="SELECT region, ID, name, lon, lat, cell AS h3_index FROM ex")
    add(
        "facilities_in_districts",
        "dedge",
        select=f"""SELECT c_custkey AS key, province, LGU FROM (SELECT c_custkey, {milli(lon('c_custkey'))} AS lon, {milli(lat('c_custkey'))} AS lat FROM customer), dedge
          WHERE {crosses('lon', 'lat')} OR {touches('lon', 'lat')} GROUP BY c_custkey, province, LGU
          HAVING count(*) FILTER ({crosses('lon', 'lat')}) % 2 = 1 AND NOT bool_or({touches('lon', 'lat')})""",
    )
    add("kmeans_candidates", f"km{ROUNDS}", select=hexed(f"(SELECT region, k || '_potential' AS ID, cx / 1e6 AS longitude, cy / 1e6 AS latitude FROM km{ROUNDS})", "longitude", "latitude", "h3_index").replace("SELECT *", "SELECT region, ID, longitude, latitude, h3_index FROM (SELECT *", 1) + ")")
    add("grid_candidates", "cand", select="SELECT region, ID, longitude, latitude, cell FROM cand")
    add(
        "grid_candidates_districts",
        "dedge",
        select=f"""SELECT LGU, ix || '_' || iy || '_potential' AS ID, x AS longitude, y AS latitude FROM (
            SELECT LGU, ix, iy, x0 + ix * 0.125e0 AS x, y0 + iy * 0.125e0 AS y FROM (SELECT LGU, floor(min(least(x1, x2))) AS x0, floor(min(y1)) AS y0, ceil(max(greatest(x1, x2))) AS xe, ceil(max(y2)) AS ye FROM dedge GROUP BY LGU),
              LATERAL (SELECT unnest(range(ceil((xe - x0) / 0.125e0)::BIGINT)) AS ix), LATERAL (SELECT unnest(range(ceil((ye - y0) / 0.125e0)::BIGINT)) AS iy)) g
          JOIN dedge e USING (LGU) WHERE {crosses('x', 'y')} OR {touches('x', 'y')} GROUP BY LGU, ix, iy, x, y
          HAVING count(*) FILTER ({crosses('x', 'y')}) % 2 = 1 OR bool_or({touches('x', 'y')})""",
    )
    add("coverage_cells", "exc", "cac", select="SELECT region, distance_m, ID AS facility_ID, cell, ring::INTEGER AS ring FROM exc UNION ALL SELECT region, distance_m, ID, cell, ring::INTEGER FROM cac")
    add("coverage_pairs", "exc", "aoi", select="SELECT region, distance_m, e.ID AS facility_ID, a.key || '_pop' AS pop_ID FROM exc e JOIN aoi a USING (region) WHERE a.h3_index = e.cell")
    add("pairs_to_cells", "exc", select="SELECT region, distance_m, ID AS facility_ID, cell FROM exc")
    add("facility_access", "ex", "exc", "ds", select="SELECT e.region, d.distance_m, e.ID, coalesce(sum(c.w), 0) AS pop_with_access FROM ex e CROSS JOIN ds d LEFT JOIN exc c ON c.region = e.region AND c.distance_m = d.distance_m AND c.ID = e.ID GROUP BY e.region, d.distance_m, e.ID")
    add("reused_access", "ex", "exc", "ds", select=f"SELECT e.region, d.distance_m, e.ID, coalesce(sum(c.w), 0) AS pop_with_access, CASE WHEN e.region = '{COUNTRY}' OR d.distance_m = {DISTANCES[-1]} THEN 2 ELSE 1 END AS run FROM ex e CROSS JOIN ds d LEFT JOIN exc c ON c.region = e.region AND c.distance_m = d.distance_m AND c.ID = e.ID GROUP BY e.region, d.distance_m, e.ID")
    add("candidate_access", "cand", "cac", "ds", select="SELECT e.region, d.distance_m, e.ID, coalesce(sum(c.w), 0) AS pop_with_access FROM cand e CROSS JOIN ds d LEFT JOIN cac c ON c.region = e.region AND c.distance_m = d.distance_m AND c.ID = e.ID GROUP BY e.region, d.distance_m, e.ID")
    add("cell_facilities", "exc", select="SELECT region, distance_m, cell, (strpos('0123456789abcdef', substr(md5(ID), 1, 1)) - 1)::INTEGER AS part, string_agg(ID, ',' ORDER BY ID) AS fac_ids FROM exc GROUP BY region, distance_m, cell, part")
    add("facility_cells", "exc", select="SELECT region, distance_m, ID AS facility_ID, (strpos('0123456789abcdef', substr(md5(cell::VARCHAR), 1, 1)) - 1)::INTEGER AS part, string_agg(cell::VARCHAR, ',' ORDER BY cell) AS cells FROM exc GROUP BY region, distance_m, ID, part")
    add("access_summary", "summary", select="SELECT * FROM summary")
    add("district_population", "rpop", "dcell", select="SELECT region, province, LGU, sum(w) AS population, count(*) AS cells FROM rpop JOIN dcell USING (cell) GROUP BY region, province, LGU")
    add("mclp_steps", "steps", select="SELECT region, distance_m, p, facility_id, cell, gain, objective FROM steps")
    add("mclp_relation_steps", "steps", select="SELECT region, distance_m, p, facility_id, gain, objective FROM steps")
    add("mclp_selected", "steps", select="SELECT region, distance_m, p, string_agg(facility_id, ',') OVER (PARTITION BY region, distance_m ORDER BY p) AS selected FROM steps")
    add("lgu_access_long", "curves", select="SELECT region, distance_m, p, province, LGU, covered, total, access_pct FROM curves")
    add("lgu_access_wide", "wide", select=f"SELECT region, distance_m, p, {_wide()} FROM wide GROUP BY region, distance_m, p")
    add(
        "lgu_accessibility",
        "located",
        "wide",
        "summary",
        "ex",
        select=f"""SELECT s.region, s.distance_m, s.p, (SELECT count(*) FROM ex WHERE ex.region = s.region) + s.p AS total_facilities, s.facility_id AS new_facility, s.district, s.lat, s.lon, s.cell AS h3_index,
            {pct('s.objective', 'm.total_population')} AS total_population_access_pct, w.* EXCLUDE (region, distance_m, p)
          FROM located s JOIN summary m ON m.region = s.region AND m.distance_m = s.distance_m
          JOIN (SELECT region, distance_m, p, {_wide()} FROM wide GROUP BY region, distance_m, p) w ON w.region = s.region AND w.distance_m = s.distance_m AND w.p = s.p""",
    )
    target = "SELECT region, distance_m, min(p) FILTER (ok) AS steps_needed, max(p) AS steps FROM (SELECT region, distance_m, p, bool_and(access_pct >= {t}) AS ok FROM curves {where} GROUP BY region, distance_m, p) GROUP BY region, distance_m"
    add("target_reached", "curves", select=target.format(t=TARGET, where="WHERE total > 0"))
    below = target.format(t=TARGET, where="")
    add("districts_below_target", "curves", select=f"SELECT c.region, c.distance_m, province, LGU, access_pct FROM curves c JOIN ({below}) t ON c.region = t.region AND c.distance_m = t.distance_m AND c.p = t.steps WHERE t.steps_needed IS NULL AND access_pct < {TARGET}")
    add("site_district", "located", select="SELECT region, distance_m, p, facility_id, lat, lon, district FROM located")
    add(
        "pareto_frontier",
        "summary",
        "steps",
        "ex",
        "cand",
        select=f""", n AS (SELECT s.*, (SELECT count(*) FROM ex WHERE ex.region = s.region) AS n_existing, (SELECT count(*) FROM cand WHERE cand.region = s.region) AS n_potential FROM summary s)
          SELECT region, distance_m, n_existing AS total_facilities, current_access AS access_pct, n_existing, n_potential, max_access FROM n
          UNION ALL SELECT n.region, n.distance_m, n_existing + p, {pct('objective', 'total_population')}, n_existing, n_potential, max_access FROM n JOIN steps s ON s.region = n.region AND s.distance_m = n.distance_m""",
    )
    layer = "SELECT b.region, v.distance_m, b.key || '_pop' AS ID, b.xcoord, b.ycoord, b.opacity FROM banded b JOIN cov v ON v.region = b.region AND v.cell = b.h3_index WHERE {cond}"
    add("layer_with_access", "banded", "cov", select=layer.format(cond="v.now"))
    add("layer_without_access", "banded", "cov", select=layer.format(cond="NOT v.now"))
    reach = "SELECT a.region, d.distance_m, a.key || '_pop' AS ID FROM aoi a CROSS JOIN ds d WHERE {no}EXISTS (SELECT 1 FROM exc e WHERE e.region = a.region AND e.cell = a.h3_index AND e.distance_m = d.distance_m)"
    add("pixels_without_access", "aoi", "exc", "ds", select=reach.format(no="NOT "))
    add("pixels_with_access", "aoi", "exc", "ds", select=reach.format(no=""))
    add(
        "layer_sample",
        "aoi",
        "cov",
        select="""SELECT region, distance_m, now, ID FROM (SELECT a.region, v.distance_m, v.now, a.key || '_pop' AS ID, row_number() OVER (PARTITION BY a.region, v.distance_m, v.now ORDER BY md5(a.key || '_pop|1'), a.key || '_pop') AS n
          FROM aoi a JOIN cov v ON v.region = a.region AND v.cell = a.h3_index) WHERE n <= 500""",
    )
    add("facility_layer", "ex", select="SELECT region, ID, lat, lon FROM ex")
    add(
        "dashboard_metadata",
        "steps",
        "summary",
        "coutline",
        select=f"""SELECT 'Area' AS country, CASE WHEN s.region = '{COUNTRY}' THEN NULL ELSE s.region END AS province, 2025 AS year, -13e0 AS central_lat, 27.5e0 AS central_long,
            (s.distance_m // 1000)::INTEGER AS distance_km, max(p)::INTEGER - 1 AS total_new_facilities, {pct('min(objective)', 'any_value(total_population)')} AS current_access,
            any_value(m.current_access) AS baseline_access, max(p)::INTEGER AS steps,
            (SELECT 'MULTIPOLYGON (((' || string_agg({num('x')} || ' ' || {num('y')}, ', ' ORDER BY seq) || ', ' || (SELECT {num('x')} || ' ' || {num('y')} FROM coutline WHERE seq = 1) || ')))' FROM coutline) AS geometry_wkt
          FROM steps s JOIN summary m ON m.region = s.region AND m.distance_m = s.distance_m GROUP BY s.region, s.distance_m""",
    )
    add("country_outline", "coutline", select="SELECT iso3, ring, seq, x, y, hole FROM coutline")
    add("strip_outlines", "soutline", select="SELECT strip, ring, seq, x, y, hole FROM soutline")
    corner = f"'(' || " + " || ', ' || ".join(f"{num(a)} || ' ' || {num(b)}" for a, b in (("xlo", "ylo"), ("xhi", "ylo"), ("xhi", "yhi"), ("xlo", "yhi"), ("xlo", "ylo"))) + " || ')'"
    inner = f"'(' || " + " || ', ' || ".join(f"{num(a)} || ' ' || {num(b)}" for a, b in (("xlo", "ylo"), ("xlo", "yhi"), ("xhi", "yhi"), ("xhi", "ylo"), ("xlo", "ylo"))) + " || ')'"
    add(
        "parcel_outlines",
        "parcel_boxes",
        select=f"""SELECT key, 'MULTIPOLYGON (' || string_agg(body, ', ' ORDER BY part) || ')' AS geometry_wkt
          FROM (SELECT key, part, '(' || string_agg(CASE WHEN hole THEN {inner} ELSE {corner} END, ', ' ORDER BY hole) || ')' AS body FROM parcel_boxes GROUP BY key, part) GROUP BY key""",
    )
    for name, change in (("fresh_combinations", "- INTERVAL 2 HOUR"), ("fresh_combinations_none", "+ INTERVAL 1 HOUR")):
        add(
            name,
            select=f"""WITH latest AS (SELECT CASE WHEN user_id % 6 = 0 THEN '{COUNTRY}' ELSE 'R' || (user_id % 6) END AS region, length(event_type)::INTEGER * 1000 AS distance_m, max(ts) AS written_at FROM events GROUP BY 1, 2),
          t AS (SELECT *, CASE WHEN written_at >= (SELECT max(written_at) {change} FROM latest) THEN 1 WHEN region = '{COUNTRY}' THEN 2 ELSE 3 END AS tier FROM latest)
          SELECT region, distance_m, tier FROM t WHERE tier = (SELECT min(tier) FROM t)""",
        )
    return q
