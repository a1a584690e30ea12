"""Tables that are replaced and appended to as a whole.

A versioned table is a view over its current version, a table of its own that never changes once it is complete. A
replacement writes a new version beside it and then points the view there, which is one change in the catalog: whoever
reads sees the old rows or the new ones, and a write that dies leaves the old ones. The version before is kept, so a
query planned on it can end, and can be restored.

A batched table takes appends as partitions of their own, staged apart from each other. Appends of several sessions at
once lose nothing, readers meet a batch once it is whole, and a batch written again under its name replaces itself, so
a retried job does not double its rows.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoreach.functions.names import with_unique_columns

INFIX = "__v"
COMPLETE = "isoreach.complete"
BATCH = "batch_id"


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_properties(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in values.items())})")


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table that a versioned table stands for now; None for a plain table, another view, or no table."""
    if not spark.catalog.tableExists(name):
        return None
    text = [r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'View Text'").collect()]
    target = text[0].rsplit(" ", 1)[1] if text else ""
    return target if target.startswith(name + INFIX) else None


def versions(spark: SparkSession, name: str, complete: bool = True) -> list[str]:
    """Versions from the oldest to the newest; with ``complete=False`` those whose write has not ended."""
    database, _, base = name.rpartition(".")
    within = f" IN {database}" if database else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{within} LIKE '{base}{INFIX}*'").collect()]
    full = sorted(f"{database}.{t}" if database else t for t in found)
    return [t for t in full if (COMPLETE in properties(spark, t)) == complete]


def _point(spark: SparkSession, name: str, version: str) -> None:
    if current_version(spark, name):
        spark.sql(f"ALTER VIEW {name} AS SELECT * FROM {version}")  # a change of one catalog entry
        return
    if spark.catalog.tableExists(name):
        # A plain table becomes the oldest version. This happens once in its life and is not one change.
        before = f"{name}{INFIX}{0:020d}_plain"
        spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        set_properties(spark, before, {COMPLETE: "true"})
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {version}")


def replace_table(df: DataFrame, name: str, marks: dict[str, str] | None = None, keep: int = 1) -> str:
    """Make the rows of ``df``, whatever its columns, the rows of versioned table ``name``; the new version's name.

    ``marks`` are properties of the version. ``df`` may read ``name`` itself. If several sessions replace a table at once,
    the last one to end wins. The newest ``keep`` versions before the current one stay.
    """
    spark, rows = df.sparkSession, with_unique_columns(df)
    version = f"{name}{INFIX}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    rows.limit(0).write.saveAsTable(version)
    try:
        rows.write.insertInto(version)
        set_properties(spark, version, {**(marks or {}), COMPLETE: "true"})
        _point(spark, name, version)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    drop_versions(spark, name, keep)
    return version


def restore_version(spark: SparkSession, name: str, version: str) -> None:
    """Make an earlier complete version the current one again."""
    if version not in versions(spark, name):
        raise ValueError(f"{version} is not a complete version of {name}")
    _point(spark, name, version)


def drop_versions(spark: SparkSession, name: str, keep: int = 1, unfinished: bool = False) -> list[str]:
    """Drop complete versions but the current one, those after it and the ``keep`` newest before it.

    With ``unfinished`` also what dead writers left; only for when no one is writing.
    """
    now = current_version(spark, name)
    older = [v for v in versions(spark, name) if now and v < now]
    gone = older[: max(0, len(older) - keep)] + (versions(spark, name, complete=False) if unfinished else [])
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    return gone


def append_batch(df: DataFrame, name: str, batch: str | None = None) -> str:
    """Append rows to batched table ``name`` as one batch (a new one, or the one of that name made anew); its name.

    The table has the columns of the first batch and ``batch_id``. An empty batch leaves nothing.
    """
    spark, batch = df.sparkSession, batch or uuid.uuid4().hex
    rows = with_unique_columns(df)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        # The option makes every write stage its files in a folder of its own and replace the partitions it has rows for.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {BATCH} STRING) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({BATCH})")
    held = spark.table(name).columns
    if BATCH not in held:
        raise ValueError(f"table {name} was not made by appending batches")
    rows.withColumn(BATCH, F.lit(batch)).select(*(f"`{c}`" for c in held)).write.mode("overwrite").insertInto(name)
    return batch
