"""Map projections to and from longitude and latitude, as Column arithmetic.

The transverse Mercator is the series of Krueger to the fourth order in the third flattening: within 30 degrees of the
central meridian its error is far below a micrometre. Every stage of it is computed once per point, in a struct that
the next stage reads; written out as one expression it would repeat its parts.

Known systems, by EPSG code: 4326 (degrees), 3857 (web Mercator) and the UTM zones of WGS 84 (326zz north, 327zz south).
A null coordinate gives null; so does text that is no geometry. Heights are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from isoreach.functions.geometry import mercator_to_lonlat

# Ellipsoid WGS 84, and what every UTM zone shares.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_EASTING = 500_000.0
UTM_SOUTH_NORTHING = 10_000_000.0

_PIECE = r"^([^-+0-9.]*)([-+0-9.eE]+)\s+([-+0-9.eE]+)(?:\s+[-+0-9.eE]+)*([^-+0-9.]*)$"

Stage = Callable[[Column], Column]


def _polynomial(n: float, *coefficients: float) -> float:
    """c1 n + c2 n^2 + ..."""
    return sum(c * n**i for i, c in enumerate(coefficients, 1))


def _staged(x: Column, y: Column, stages: list[Stage]) -> Column:
    """Feed struct(x, y) through the stages; each reads fields of the struct before it."""
    start = F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    return reduce(lambda points, stage: F.transform(points, stage), stages, start)[0]


def _struct(**fields: Column) -> Column:
    return F.struct(*(value.alias(name) for name, value in fields.items()))


@dataclass(frozen=True)
class TransverseMercator:
    """A transverse Mercator system; longitudes in degrees, the rest in metres. The central meridian may be a Column."""

    lon0: float | Column
    scale: float = 1.0
    easting: float = 0.0
    northing: float | Column = 0.0
    semi_major: float = SEMI_MAJOR
    flattening: float = FLATTENING

    @property
    def _n(self) -> float:
        return self.flattening / (2 - self.flattening)

    @property
    def _radius(self) -> float:
        """Scale times the radius of the circle as long as a meridian."""
        n = self._n
        return self.scale * self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)

    # Coefficients of the series, lowest power of n first.
    @property
    def _forward(self) -> list[float]:
        n = self._n
        return [
            _polynomial(n, 1 / 2, -2 / 3, 5 / 16, 41 / 180),
            _polynomial(n, 0, 13 / 48, -3 / 5, 557 / 1440),
            _polynomial(n, 0, 0, 61 / 240, -103 / 140),
            _polynomial(n, 0, 0, 0, 49561 / 161280),
        ]

    @property
    def _backward(self) -> list[float]:
        n = self._n
        return [
            _polynomial(n, 1 / 2, -2 / 3, 37 / 96, -1 / 360),
            _polynomial(n, 0, 1 / 48, 1 / 15, -437 / 1440),
            _polynomial(n, 0, 0, 17 / 480, -37 / 840),
            _polynomial(n, 0, 0, 0, 4397 / 161280),
        ]

    @property
    def _latitude(self) -> list[float]:
        n = self._n
        return [
            _polynomial(n, 2, -2 / 3, -2, 116 / 45),
            _polynomial(n, 0, 7 / 3, -8 / 5, -227 / 45),
            _polynomial(n, 0, 0, 56 / 15, -136 / 35),
            _polynomial(n, 0, 0, 0, 4279 / 630),
        ]

    def stages_forward(self) -> list[Stage]:
        """From struct(x = lon, y = lat) to struct(x, y) in metres.

        Spark's asinh is off by a rounding of 1, whatever its argument; atanh keeps the digits of small ones.
        """
        e = math.sqrt(self.flattening * (2 - self.flattening))
        wave = lambda p, f, g, start: sum((c * f(p["a"] * (2 * j)) * g(p["b"] * (2 * j)) for j, c in enumerate(self._forward, 1)), start)
        return [
            lambda p: _struct(l=F.radians(p["x"] - self.lon0), s=F.sin(F.radians(p["y"])), t=F.tan(F.radians(p["y"]))),
            lambda p: _struct(l=p["l"], t=p["t"], s=F.sinh(e * F.atanh(e * p["s"]))),
            lambda p: _struct(l=p["l"], t=p["t"] * F.sqrt(1 + p["s"] * p["s"]) - p["s"] * F.sqrt(1 + p["t"] * p["t"])),
            lambda p: _struct(a=F.atan2(p["t"], F.cos(p["l"])), b=F.atanh(F.sin(p["l"]) / F.sqrt(1 + p["t"] * p["t"]))),
            lambda p: _struct(
                x=self.easting + self._radius * wave(p, F.cos, F.sinh, p["b"]), y=self.northing + self._radius * wave(p, F.sin, F.cosh, p["a"])
            ),
        ]

    def stages_inverse(self) -> list[Stage]:
        """From struct(x, y) in metres to struct(x = lon, y = lat)."""
        wave = lambda p, f, g: sum(c * f(p["a"] * (2 * j)) * g(p["b"] * (2 * j)) for j, c in enumerate(self._backward, 1))
        return [
            lambda p: _struct(a=(p["y"] - self.northing) / self._radius, b=(p["x"] - self.easting) / self._radius),
            lambda p: _struct(a=p["a"] - wave(p, F.sin, F.cosh), b=p["b"] - wave(p, F.cos, F.sinh)),
            lambda p: _struct(l=F.atan2(F.sinh(p["b"]), F.cos(p["a"])), c=F.asin(F.sin(p["a"]) / F.cosh(p["b"]))),
            lambda p: _struct(
                x=self.lon0 + F.degrees(p["l"]), y=F.degrees(p["c"] + sum(d * F.sin(p["c"] * (2 * j)) for j, d in enumerate(self._latitude, 1)))
            ),
        ]

    def project(self, lon: Column, lat: Column) -> Column:
        """STRUCT<x, y> in metres."""
        return _staged(lon, lat, self.stages_forward())

    def unproject(self, x: Column, y: Column) -> Column:
        """STRUCT<x, y> of longitude and latitude."""
        return _staged(x, y, self.stages_inverse())


def utm(zone: int | Column, south: bool = False) -> TransverseMercator:
    """The UTM zone (1 to 60) on WGS 84."""
    return TransverseMercator(zone * 6.0 - 183.0, UTM_SCALE, UTM_EASTING, UTM_SOUTH_NORTHING if south else 0.0)


def _web_mercator(p: Column) -> Column:
    place = mercator_to_lonlat(p["x"], p["y"])
    return _struct(x=place["lon"], y=place["lat"])


def stages_to_degrees(epsg: int) -> list[Stage]:
    """Stages from the coordinates of a system to struct(x = lon, y = lat)."""
    if epsg == 4326:
        return []
    if epsg == 3857:
        return [_web_mercator]
    family, zone = divmod(epsg, 100)
    if family in (326, 327) and 1 <= zone <= 60:
        return utm(zone, south=family == 327).stages_inverse()
    raise ValueError(f"coordinate system EPSG:{epsg} is not among 4326, 3857 and the UTM zones of WGS 84")


def to_lonlat(x: Column, y: Column, epsg: int) -> Column:
    """Coordinates of a known system as STRUCT<lon, lat>."""
    point = _staged(x, y, stages_to_degrees(epsg))
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(point["x"].alias("lon"), point["y"].alias("lat")))


def wkt_to_lonlat(wkt: Column, epsg: int) -> Column:
    """WKT of any geometry type in a known system as WKT in degrees: each vertex is replaced within the text."""
    if not stages_to_degrees(epsg):
        return wkt
    part = lambda piece, i: F.regexp_extract(piece, _PIECE, i)
    number = lambda piece, i: F.nullif(part(piece, i), F.lit("")).cast("double")
    # The text around a vertex rides along through the stages.
    points = F.transform(
        F.split(wkt, ","),
        lambda v: _struct(p=_struct(x=number(v, 2), y=number(v, 3)), before=part(v, 1), after=part(v, 4)),
    )
    carried = lambda stage: lambda v: _struct(p=stage(v["p"]), before=v["before"], after=v["after"])
    points = reduce(lambda vertices, stage: F.transform(vertices, carried(stage)), stages_to_degrees(epsg), points)
    texts = F.transform(points, lambda v: F.concat(v["before"], v["p"]["x"].cast("string"), F.lit(" "), v["p"]["y"].cast("string"), v["after"]))
    return F.when(~F.exists(texts, lambda t: t.isNull()), F.array_join(texts, ","))
