"""Joins that broadcast by a checked size and split hot keys otherwise, and lineage cuts."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
# A key is hot beyond this many rows; never more than MAX_HOT_KEYS keys are, because the limit grows
# with the table: a key needs more than total / MAX_HOT_KEYS rows.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000
# What a task makes of its rows where a table is dealt out before every row becomes many.
TASK_ROWS = 1 << 19
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def row_bytes(df: DataFrame) -> int:
    """Width of a row in a hash relation, counting 64 bytes for anything of variable length."""
    width = {"int": 8, "bigint": 8, "double": 8, "float": 8, "boolean": 8, "date": 8, "timestamp": 8}
    return 16 + sum(width.get(kind, 64) for _, kind in df.dtypes)


def fits_broadcast(df: DataFrame, rows: int) -> bool:
    return rows * row_bytes(df) <= BROADCAST_BYTES


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table of at most ``rows`` rows, if that many are small enough."""
    return F.broadcast(df) if fits_broadcast(df, rows) else df


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner", max_rows: int | None = None, skewed: bool = True
) -> DataFrame:
    """Join a large side to a smaller one (inner, left, left_semi, left_anti).

    ``max_rows`` is a proven bound of the lookup (counted here if absent). If that fits, the lookup is
    broadcast and the large side does not move. Beyond it both sides are shuffled, hot keys of the large
    side in pieces; pass ``skewed=False`` where its keys cannot be hot.
    """
    if max_rows is None:
        max_rows = lookup.select(*on).limit(BROADCAST_BYTES // row_bytes(lookup) + 1).count()
    if fits_broadcast(lookup, max_rows):
        return big.join(F.broadcast(lookup), on, how)
    return hot_join(big, lookup, on, how) if skewed else big.join(lookup, on, how)


def hot_join(
    big: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Shuffled equi-join that splits the hot keys of the large side and copies only their lookup rows.

    Rows per key are counted first (combined map-side; ``counts`` is (on, n) if already known). A key
    with n rows gets n / limit pieces, a piece per hash of the row. The list of hot keys is at most
    MAX_HOT_KEYS rows by construction, so it is fixed on the driver and broadcast. ``counts`` may as well
    weigh keys by the rows they become; the large side is then dealt over tasks for ``rows`` of them, and the lookup is
    not broadcast either, however small Spark takes its files to be.
    """
    dealt = lambda df, *keys: df if rows is None else deal(df, rows, *keys)
    merged = lambda df: df if rows is None else df.hint("merge")
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    counts = counts.persist()
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    limit = max(hot_rows, total // MAX_HOT_KEYS)
    hot = counts.filter(F.col("n") > limit).select(*on, F.ceil(F.col("n") / limit).cast("int").alias("_pieces"))
    found = hot.collect()
    counts.unpersist()
    if not found:
        return dealt(big, *on).join(merged(lookup), on, how)
    hot = F.broadcast(big.sparkSession.createDataFrame(found, hot.schema))
    piece = F.coalesce(F.pmod(F.xxhash64(*big.columns), F.col("_pieces")).cast("int"), F.lit(0))
    pieces = big.join(hot, on, "left").withColumn("_piece", piece).drop("_pieces")
    copies = lookup.join(hot, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    return dealt(pieces, *on, "_piece").join(merged(copies.drop("_pieces")), [*on, "_piece"], how).drop("_piece")


def deal(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` over as many tasks as ``rows`` (those it holds or will become) need, by ``keys`` or evenly.

    Adaptive execution sizes tasks by the bytes they read: rows of a small table that become many each would all stay
    in one task. A given number of tasks is kept.
    """
    return df.repartition(max(1, math.ceil(rows / TASK_ROWS)), *keys)


def local_rows(spark: SparkSession, rows: list, schema: pa.Schema) -> DataFrame:
    """A small driver-side table as a local relation (no Python workers when it is read)."""
    columns = list(zip(*rows, strict=True)) or [[] for _ in schema]
    arrays = [pa.array(list(values), field.type) for values, field in zip(columns, schema, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=schema))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the one the cluster names, else (tests) a folder of our own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="isoreach-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return root


def arrow_rows(spark: SparkSession, rows: int) -> None:
    """From now on Arrow batches of the session have at most so many rows."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= rows:
        spark.conf.set(ARROW_ROWS, rows)


class Workspace:
    """Tables of one iterative run below the checkpoint folder.

    Reading back a written table cuts the lineage, survives the loss of executors, keeps the columnar
    form and its statistics, and (unlike a checkpoint) can be dropped as soon as it is replaced.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/isoreach-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
        """``batch_rows``: rows of an Arrow batch while this is written, if the session allows more. Whole texts go to Python
        in batches that the JVM and the worker hold at the same time: ten thousand of them are tens of MB on either side."""
        path = f"{self.root}/{name}"
        now = self.spark.conf.get(ARROW_ROWS)
        if batch_rows is not None:
            arrow_rows(self.spark, batch_rows)
        try:
            df.write.mode("errorifexists").parquet(path)
        finally:
            if batch_rows is not None:
                self.spark.conf.set(ARROW_ROWS, now)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def close(self) -> None:
        """Drop everything; results must not depend on the tables any more."""
        self.drop()
