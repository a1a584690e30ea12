"""GeoJSON boundaries and facilities, OSM elements.

GeoJSON is read in splits whatever its layout: one feature per line (newline-delimited, or a collection laid
out that way) as lines, anything else by a scan of its structure. The layout is found out unless it is given;
a file without any feature, or with a feature that does not parse, is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoreach.functions.geometry import geojson_wkt, point_x, point_y, polygon_bounds, wkt_geojson
from isoreach.functions.projection import wkt_to_lonlat
from isoreach.functions.names import NAME_COLUMNS, correct_names
from isoreach.operators.joins import Workspace, lookup_join
from isoreach.sources.tables import path_exists

_GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])


_FEATURE = r'"type"\s*:\s*"Feature"'
_COLLECTION = r'"type"\s*:\s*"FeatureCollection"'


def _feature_schema(properties: list[str] | None) -> T.StructType:
    """Features with the listed properties, or with all of them as a map."""
    fields = T.MapType(T.StringType(), T.StringType())
    if properties is not None:
        fields = T.StructType([T.StructField(p, T.StringType()) for p in properties])
    return T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("properties", fields), T.StructField("geometry", _GEOMETRY)]
    )


def feature_rows(features: DataFrame, properties: list[str] | None, feature: str = "feature") -> DataFrame:
    """Parsed feature structs to properties + geometry_wkt."""
    f = F.col(feature)
    return features.select(
        *([f["properties"].alias("properties")] if properties is None else [f["properties"][p].alias(p) for p in properties]),
        geojson_wkt(f["geometry"]["type"], f["geometry"]["coordinates"]).alias("geometry_wkt"),
    )


def parse_features(lines: DataFrame, properties: list[str] | None, text: str = "value") -> DataFrame:
    """Text rows holding one GeoJSON feature each (a trailing comma is allowed).

    Rows that do not name a feature (the frame of a collection) are skipped; a row that does and cannot be
    parsed is an error.
    """
    line = F.regexp_replace(F.trim(F.col(text)), r",$", "")
    crowded = F.regexp_count(text, F.lit(_FEATURE)) > 1
    checked = F.when(crowded & F.col(text).rlike(r"\}\s*,?\s*\{\s*" + _FEATURE), F.raise_error(F.lit("a line holds more than one feature: read it as a collection"))).otherwise(line)
    # Null instead of a filter alone: the order in which conditions of merged filters are tried is not ours to choose.
    named = lines.filter(F.col(text).rlike(_FEATURE)).select(F.when(F.col(text).rlike(_FEATURE), checked).alias("_line"))
    parsed = named.select(F.from_json("_line", _feature_schema(properties), {"mode": "FAILFAST"}).alias("feature"))
    return feature_rows(parsed.filter("feature.type = 'Feature'"), properties)


def feature_texts(spark: SparkSession, path: str) -> DataFrame:
    """The JSON text of every feature of GeoJSON files in any layout: ``file``, ``value``; large files are read in splits.

    Files are read as pieces that end at a closing brace, wherever lines break. What a piece does to the state of the scan
    (in a string or not, how deep) follows from its own text for either state it may start in, so states are composed by
    running sums: over the splits of a file first, which are few, then over the pieces of a split. A feature ends where the
    depth returns to that of the collection's list (or to none, for one object after the other), and its pieces are put
    together again. A task holds the pieces of a split, and a feature as a whole.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value"
    )
    # Without escaped characters every quote opens or closes a string.
    plain = F.regexp_replace("value", r"\\.", "")
    parts = F.split(plain, '"')

    def outside(first: int) -> Column:
        return F.array_join(F.filter(parts, lambda _, i: i % 2 == first), "")

    def depth(text: Column, brace_counts: Column) -> Column:
        openings, closings = (F.length(text) - F.length(F.translate(text, c, "")) for c in ("{[", "]"))
        return openings - closings - brace_counts.cast("int")

    flips = (F.size(parts) - 1) % 2
    # The brace behind a piece counts if the piece does not end inside a string.
    told = pieces.select("file", "_block", "_at", "value", flips.alias("_flip"), depth(outside(0), flips == 0).alias("_d0"), depth(outside(1), flips == 1).alias("_d1"))

    def before(c: Column, by: list[str], order: str) -> Column:
        return F.coalesce(F.sum(c).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def carried(table: DataFrame, c: str, out: str) -> DataFrame:
        """``out``: sum of ``c`` over everything before the row in its file."""
        inside = table.withColumn("_here", before(F.col(c), ["file", "_block"], "_at"))
        blocks = table.groupBy("file", "_block").agg(F.sum(c).alias("_sum")).withColumn("_base", before(F.col("_sum"), ["file"], "_block")).drop("_sum")
        return lookup_join(inside, blocks, ["file", "_block"], skewed=False).withColumn(out, F.col("_here") + F.col("_base")).drop("_here", "_base")

    work = Workspace(spark)
    within = carried(work.save(told, "pieces"), "_flip", "_quotes").withColumn("_d", F.when(F.col("_quotes") % 2 == 0, F.col("_d0")).otherwise(F.col("_d1")))
    deep = carried(work.save(within.drop("_d0", "_d1"), "states"), "_d", "_from")
    framed = deep.groupBy("file").agg((F.max(F.col("value").rlike(_COLLECTION).cast("int")) * 2).alias("_list"))
    ends = ((F.col("_quotes") + F.col("_flip")) % 2 == 0) & (F.col("_from") + F.col("_d") == F.col("_list"))
    closed = lookup_join(deep, framed, ["file"], skewed=False).withColumn("_end", ends.cast("int"))
    numbered = carried(work.save(closed, "ends"), "_end", "_feature")
    start = r'(?s)^.*"features"\s*:\s*\['
    framing = F.when(F.col("value").rlike(start), F.regexp_replace("value", start, "")).otherwise(F.lit(""))
    own = F.when(F.col("_from") < F.col("_list"), framing).otherwise(F.col("value"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_at", own.alias("v")))), lambda p: p["v"]), "}")
    found = numbered.groupBy("file", "_feature").agg(text.alias("value"), F.max("_end").alias("_whole"))
    # Behind the last feature there is only the end of the frame; a feature cut off is kept, to fail when it is parsed.
    kept = found.filter(((F.col("_whole") == 1) & F.col("value").contains("{")) | F.col("value").rlike(_FEATURE))
    return kept.select("file", F.concat(F.regexp_replace("value", r"(?s)^[^{]*", ""), F.lit("}")).alias("value"))


def read_geojson(spark: SparkSession, path: str, properties: list[str] | None, layout: str = "auto") -> DataFrame:
    """GeoJSON to rows. ``layout``: lines (one feature per line), collection (any layout), or auto.

    It counts as lines if features start lines and no line holds two of them, or one together with the frame of a collection.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such GeoJSON: {path}")
    if layout == "auto":
        text = spark.read.text(path)
        line = F.regexp_replace(F.trim("value"), ",$", "")
        count = F.regexp_count("value", F.lit(_FEATURE))
        single = line.startswith("{") & line.endswith("}") & (count == 1) & ~F.col("value").rlike(_COLLECTION)
        found = text.agg(F.sum(count).alias("features"), F.sum(F.when(single, 1).otherwise(0)).alias("lines"), F.max(F.col("value").rlike(_COLLECTION).cast("int")).alias("frame")).first()
        if not (found["features"] or found["frame"]):
            raise ValueError(f"no GeoJSON feature in {path}")
        layout = "lines" if found["features"] and found["lines"] == found["features"] else "collection"
    if layout == "lines":
        return parse_features(spark.read.text(path), properties)
    if layout != "collection":
        raise ValueError(f"unknown layout: {layout}")
    return parse_features(feature_texts(spark, path), properties)


def write_geojson(df: DataFrame, path: str, wkt: str = "geometry_wkt", mode: str = "overwrite") -> None:
    """Rows to newline-delimited GeoJSON features, read back by ``read_geojson``."""
    properties = F.to_json(F.struct(*[c for c in df.columns if c != wkt]), {"ignoreNullFields": "false"})
    line = F.concat(
        F.lit('{"type": "Feature", "properties": '), properties, F.lit(', "geometry": '), F.coalesce(wkt_geojson(F.col(wkt)), F.lit("null")), F.lit("}")
    )
    df.select(line.alias("value")).write.mode(mode).text(path)


# Attributes of the boundary files per administrative level.
BOUNDARY_COLUMNS = {0: ["ISO_A3", "NAM_0"], 1: ["ISO_A3", "NAM_0", "NAM_1"], 2: ["ISO_A3", "NAM_0", "NAM_1", "NAM_2"]}


def load_boundaries(spark: SparkSession, folder: str, admin_level: int, layout: str = "auto", epsg: int = 4326) -> DataFrame:
    """Boundaries of one administrative level with known name errors corrected, in degrees.

    The known properties are columns; all properties of the file are the map ``attributes``, names corrected there too.
    ``epsg`` is the system of the file's coordinates, one of those in ``functions/projection.py``.
    """
    if admin_level not in BOUNDARY_COLUMNS:
        raise ValueError(f"admin_level must be 0, 1 or 2, not {admin_level}")
    path = f"{folder.rstrip('/')}/wb_admin{admin_level}.geojson"
    listed = BOUNDARY_COLUMNS[admin_level]
    found = read_geojson(spark, path, None, layout)
    known = found.select(
        *(F.col("properties")[c].alias(c) for c in listed),
        wkt_to_lonlat(F.col("geometry_wkt"), epsg).alias("geometry_wkt"),
        F.col("properties").alias("attributes"),
    )
    named = [c for c in NAME_COLUMNS if c in listed]
    return correct_names(known).withColumn("attributes", F.transform_values("attributes", lambda k, v: F.coalesce(*(F.when(k == c, F.col(c)) for c in named), v)))


def select_boundaries(boundaries: DataFrame, iso3: str, province: str | None = None) -> DataFrame:
    """Features of one country or province; an empty selection is an error naming what there is."""
    country = boundaries.filter(F.col("ISO_A3") == iso3)
    chosen = country if province is None else country.filter(F.col("NAM_1") == province)
    if chosen.isEmpty():
        if province is None:
            raise ValueError(f"no boundary has ISO_A3 = '{iso3}'")
        available = [r[0] for r in country.select("NAM_1").distinct().orderBy("NAM_1").collect()]
        raise ValueError(f"no boundary has NAM_1 = '{province}'; there are {available}")
    return chosen


def region_table(adm0: DataFrame, adm1: DataFrame, iso3: str, country: str = "Country") -> DataFrame:
    """Country and all its provinces as rows: iso3, region, geometry_wkt, attributes."""
    whole = select_boundaries(adm0, iso3).select(F.col("ISO_A3").alias("iso3"), F.lit(country).alias("region"), "geometry_wkt", "attributes")
    parts = adm1.filter(F.col("ISO_A3") == iso3).select(F.col("ISO_A3").alias("iso3"), F.col("NAM_1").alias("region"), "geometry_wkt", "attributes")
    return whole.unionByName(parts)


def reference_latitude(adm0: DataFrame, iso3: str) -> float:
    """Middle latitude of a country, for ``Settings.ref_lat``: the grid's cells are as wide as they should be there."""
    b = polygon_bounds("geometry_wkt")
    found = select_boundaries(adm0, iso3).agg(F.min(b["miny"]).alias("lo"), F.max(b["maxy"]).alias("hi")).first()
    if found["lo"] is None:
        raise ValueError(f"the boundary with ISO_A3 = '{iso3}' has no geometry")
    return (found["lo"] + found["hi"]) / 2


def select_districts(adm2: DataFrame, iso3: str) -> DataFrame:
    """Districts as iso3, province, LGU, geometry_wkt."""
    country = adm2.filter(F.col("ISO_A3") == iso3)
    if country.isEmpty():
        raise ValueError(f"no district has ISO_A3 = '{iso3}'")
    return normalize_districts(country)


def normalize_districts(adm2: DataFrame) -> DataFrame:
    return adm2.select(
        F.col("ISO_A3").alias("iso3"), F.col("NAM_1").alias("province"), F.col("NAM_2").alias("LGU"), "geometry_wkt"
    )


ELEMENT_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("center", T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)


def element_rows(elements: DataFrame, use_center: bool = False, element: str = "element", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parsed elements to osm_id, lat, lon, name; elements without coordinates are dropped.

    Ways and relations carry theirs under ``center``, which counts only with ``use_center``.
    """
    e = F.col(element)
    lat, lon = (F.coalesce(e[c], e["center"][c]) if use_center else e[c] for c in ("lat", "lon"))
    rows = elements.select(
        *keep, e["id"].alias("osm_id"), lat.alias("lat"), lon.alias("lon"), e["tags"]["name"].alias("name")
    )
    return rows.dropna(subset=["lat", "lon"])


def parse_elements(lines: DataFrame, use_center: bool = False, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Text rows holding one element each."""
    parsed = lines.select(*keep, F.from_json(F.regexp_replace(F.trim(F.col(text)), r",$", ""), ELEMENT_SCHEMA).alias("element"))
    return element_rows(parsed, use_center, keep=keep)


def read_osm(spark: SparkSession, path: str, use_center: bool = False) -> DataFrame:
    """A stored query response (``{"elements": [...]}``), one or many files."""
    schema = T.StructType([T.StructField("elements", T.ArrayType(ELEMENT_SCHEMA))])
    elements = spark.read.schema(schema).json(path, multiLine=True).select(F.posexplode("elements").alias("pos", "element"))
    return element_rows(elements, use_center, keep=("pos",))


def merge_elements(*lists: DataFrame, order: str = "pos") -> DataFrame:
    """Union of element lists, one row per osm_id: the earlier list wins, then the lower ``order``.

    An aggregation, not a window: copies of one id are combined before they are shuffled.
    """
    ranked = [df.withColumn("_list", F.lit(i)) for i, df in enumerate(lists)]
    every = reduce(lambda a, b: a.unionByName(b), ranked)
    columns = [c for c in every.columns if c not in ("osm_id", "_list", order)]
    best = F.min(F.struct("_list", order, *columns)).alias("_best")
    return every.groupBy("osm_id").agg(best).select("osm_id", *[f"_best.{c}" for c in columns])


def load_facilities(
    spark: SparkSession, source: str, path: str | list[str] | None, use_center: bool = False, layout: str = "auto", epsg: int = 4326
) -> DataFrame:
    """Facilities from stored OSM responses (hospitals before clinics) or from a GeoJSON of points.

    Those of a file keep all their properties as a map, and the file's ``ID``. Without one, ``ID`` is made from
    osm_id, else from name and place, so no facility is without a key. ``epsg`` is the system of the file's coordinates
    (stored responses are in degrees); places come out in degrees.
    """
    if source == "osm":
        paths = [path] if isinstance(path, str) else list(path or [])
        return merge_elements(*[read_osm(spark, p, use_center) for p in paths])
    if source == "file":
        if path is None:
            raise ValueError("source 'file' needs a path")
        points = read_geojson(spark, path, None, layout)
        points = points.withColumn("geometry_wkt", wkt_to_lonlat(F.col("geometry_wkt"), epsg))
        points = points.withColumn("lon", point_x(F.col("geometry_wkt"))).withColumn("lat", point_y(F.col("geometry_wkt")))
        of = F.col("properties")
        made = F.concat(F.coalesce(of["osm_id"], F.md5(F.concat_ws("|", of["name"], F.col("lon").cast("string"), F.col("lat").cast("string")))), F.lit("_current"))
        return points.select(F.coalesce(of["ID"], made).alias("ID"), of["osm_id"].alias("osm_id"), of["name"].alias("name"), "properties", "geometry_wkt", "lon", "lat")
    raise ValueError(f"source must be 'osm' or 'file', not {source!r}")
