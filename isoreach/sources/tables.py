"""Tables, CSV, compute-or-reuse, and the run log."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isoreach.functions.geometry import has_geometry, wkt_edges
from isoreach.functions.names import with_unique_columns
from isoreach.sources import versions

FINGERPRINT = "isoreach.fingerprint"
PART = "isoreach.part."

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("distance_m", T.IntegerType(), False),
        T.StructField("written_at", T.TimestampType(), False),
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ensure_dir(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def load_table(spark: SparkSession, name: str) -> DataFrame:
    if not table_exists(spark, name):
        raise FileNotFoundError(f"no table named {name}")
    return spark.table(name)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Managed table; an overwrite may change the schema. Columns that differ only in case are renamed.

    An overwrite is a new version that readers see once it is complete (see ``versions``); a partitioned table is written
    in place, its parts being marked one by one (see ``materialize_parts``).
    """
    if mode == "overwrite" and not partition_by:
        versions.replace_table(df, name)
        return
    spark = df.sparkSession
    current = versions.current_version(spark, name)
    if current and mode == "overwrite":
        spark.sql(f"DROP VIEW {name}")
    elif current:
        name = current
    with_unique_columns(df).write.mode(mode).partitionBy(*partition_by).saveAsTable(name)


def load_geometry(spark: SparkSession, name: str, wkt: str = "geometry_wkt") -> DataFrame:
    """A geometry table with its polygons parsed into ``edges``; empty for missing or blank text."""
    table = load_table(spark, name)
    return table.withColumn("edges", F.when(has_geometry(F.col(wkt)), wkt_edges(wkt)))


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no CSV data at {path}")
    return spark.read.schema(schema).csv(path, header=True)


def fingerprint(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()[:16]


def input_identity(spark: SparkSession, source: DataFrame | str | list[str]) -> str:
    """What tells one input from another: for files (a path, paths, or what a DataFrame reads) their number and a
    hash of names, lengths and times; for data in memory the hash of its plan."""
    plan = str(source.semanticHash()) if isinstance(source, DataFrame) else ""
    paths = list(source.inputFiles()) if isinstance(source, DataFrame) else [source] if isinstance(source, str) else list(source)
    if not paths:
        return plan
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    found = listed.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("h")).first()
    return f"{found['n']}-{found['h']}" + (f"-{fingerprint({'columns': source.dtypes})}" if plan else "")


def stored_fingerprint(spark: SparkSession, name: str) -> str | None:
    return versions.properties(spark, versions.current_version(spark, name) or name).get(FINGERPRINT)


def materialize(spark: SparkSession, make: Callable[[], DataFrame], name: str, params: dict | None = None, force: bool = False) -> DataFrame:
    """Reuse table ``name`` if it was completed with the same parameters, else compute it and replace it.

    The fingerprint belongs to the version, so rows and fingerprint change at once: an interrupted write is never taken
    for a result, and leaves the table as it was.
    """
    mark = fingerprint(params or {})
    if force or not table_exists(spark, name) or stored_fingerprint(spark, name) != mark:
        versions.replace_table(make(), name, {FINGERPRINT: mark})
    return spark.table(name)


def rectangles(parts: list[tuple]) -> list[tuple[list, list]]:
    """(first keys, second keys) whose products make up the parts: keys with equal partners share a rectangle."""
    partners: dict = {}
    for first, second in parts:
        partners.setdefault(first, set()).add(second)
    shared: dict = {}
    for first, seconds in partners.items():
        shared.setdefault(tuple(sorted(seconds)), []).append(first)
    return [(sorted(firsts), list(seconds)) for seconds, firsts in sorted(shared.items())]


def content_marks(table: DataFrame, keys: list[str]) -> dict[tuple, str]:
    """A mark for the rows of each key: their number and the sum of their hashes, whatever their order."""
    hashed = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) if kind.startswith("map") else F.col(f"`{c}`") for c, kind in table.dtypes])
    rows = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(20,0)")).alias("h")).collect()
    return {tuple(r[k] for k in keys): f"{r['n']}-{r['h']}" for r in rows}


def part_marks(spark: SparkSession, name: str) -> dict[tuple, str]:
    """The parts of a table that were completed, with their fingerprints."""
    if not table_exists(spark, name):
        return {}
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    held = [json.loads(bytes.fromhex(r["value"])) for r in rows if r["key"].startswith(PART)]
    return {tuple(part): mark for part, mark in held}


def _literal(value) -> str:
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _mark_parts(spark: SparkSession, name: str, marks: dict[tuple, str]) -> None:
    # Part and mark travel as hexadecimal text, so that any name can be a part.
    pairs = [f"'{PART}{fingerprint({'part': part})}' = '{json.dumps([part, mark]).encode().hex()}'" for part, mark in marks.items()]
    if pairs:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(pairs)})")


def _drop_parts(spark: SparkSession, name: str, keys: tuple[str, ...], parts: list[tuple]) -> None:
    """Take parts out of a table: the marks go first, so that a part half dropped is never taken for complete."""
    if parts:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(repr(PART + fingerprint({'part': p})) for p in parts)})")
        specs = ", ".join("PARTITION (" + ", ".join(f"`{k}` = {_literal(v)}" for k, v in zip(keys, p, strict=True)) + ")" for p in parts)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize_parts(
    spark: SparkSession, make: Callable[[list[tuple]], DataFrame], name: str, wanted: dict[tuple, str], keys: tuple[str, ...], force: bool = False
) -> list[tuple]:
    """Bring table ``name``, partitioned by ``keys``, to the wanted parts (key values -> fingerprint); the parts written.

    ``make(parts)`` computes the rows of some parts. Only parts that are new or whose fingerprint changed are computed and
    written; parts not wanted any more are dropped; all others stay as they are, files included. The number of parts is
    that of a run's regions and distances, so they are listed on the driver. A part loses its mark before it is touched and
    gets it once its rows are written: an interrupted run leaves it unmarked, and the next run computes it. A part may be
    empty. If the columns have changed, or no part is marked, the whole table is made anew.
    """
    held = {} if force else part_marks(spark, name)
    todo = sorted(part for part, mark in wanted.items() if held.get(part) != mark)
    fresh = make(todo) if todo and held else None
    if not held or (fresh is not None and dict(fresh.dtypes) != dict(spark.table(name).dtypes)):
        todo = sorted(wanted)
        save_table(make(todo), name, partition_by=keys)
    else:
        _drop_parts(spark, name, keys, sorted({p for p in held if p not in wanted} | set(todo)))
        if fresh is not None:
            columns = [f"`{c}`" for c in spark.table(name).columns]
            with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                with_unique_columns(fresh).select(*columns).write.mode("overwrite").insertInto(name)
    _mark_parts(spark, name, {part: wanted[part] for part in todo})
    whole = fingerprint({"parts": sorted(map(list, part_marks(spark, name).items()), key=str)})
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{FINGERPRINT}' = '{whole}')")
    return todo


def log_run(spark: SparkSession, log_table: str, table_name: str, combos: DataFrame) -> None:
    """Append one row per combination written to ``table_name`` now, as a batch: runs at the same time lose no entry."""
    entries = combos.select(
        F.lit(table_name).alias("table_name"),
        F.col("region").cast("string"),
        F.col("distance_m").cast("int"),
        F.current_timestamp().alias("written_at"),
    )
    versions.append_batch(entries, log_table)


def fresh_combinations(run_log: DataFrame, since, country: str = "Country") -> DataFrame:
    """Which combinations to show: those written since ``since``; if none, the country's at every distance;
    if none, the first that exists (by region, then distance)."""
    latest = run_log.groupBy("region", "distance_m").agg(F.max("written_at").alias("written_at"))
    tier = F.when(F.col("written_at") >= F.lit(since), 1).when(F.col("region") == country, 2).otherwise(3)
    tiered = latest.withColumn("tier", tier)
    best = tiered.agg(F.min("tier").alias("tier"), F.min(F.struct("region", "distance_m")).alias("_first"))
    return (
        tiered.join(F.broadcast(best), "tier")
        .filter((F.col("tier") < 3) | (F.struct("region", "distance_m") == F.col("_first")))
        .select("region", "distance_m", "written_at", "tier")
    )
