"""Exact quantiles of every group by refining histograms.

A pass counts each group's values in equal buckets between the least and the largest value of an interval; running counts
tell which bucket holds a wanted rank, and that bucket, from its own least to its own largest value, is the interval of
the next pass. Buckets are equal in width, or in orders of magnitude where an interval spans many. A pass narrows an
interval by a factor of BUCKETS or down to a single value, so any doubles end after some six passes, and values that
repeat end at once. What is shuffled is at most BUCKETS rows for each task and
interval; no value is sorted, and no sketch decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoreach.operators.joins import Workspace, lookup_join

BUCKETS = 4096


def _magnitude(c: str) -> Column:
    """Order of magnitude with the sign of the value, for intervals over many orders."""
    return F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.signum(c) * (F.log(F.abs(c)) + F.lit(745.0)))


def exact_quantiles(table: DataFrame, groups: list[str], value: str, shares: list[float], buckets: int = BUCKETS, passes: int = 64) -> DataFrame:
    """``groups`` + ``q`` (position in ``shares``) + ``quantile``: the least value with at least ceil(share * n) values up to it.

    Null, NaN and infinite values are left out; a group without others gives no row, an empty table none at all. The table
    is read once for each pass, so it should be a stored one.
    """
    spark, work = table.sparkSession, Workspace(table.sparkSession)
    v = F.col(value).cast("double")
    rows = table.select(*groups, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") != F.lit(float("inf"))))
    rows = rows.withColumn("_v", F.col("_v") + F.lit(0.0))  # -0.0 is 0.0
    whole = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)]))
    rank = F.greatest(F.ceil(F.col("_q.share") * F.col("_n")), F.lit(1)).cast("long")
    # ``_rank`` counts from the start of the interval [_lo, _hi].
    state = work.save(whole.withColumn("_q", wanted).select(*groups, F.col("_q.q").alias("q"), rank.alias("_rank"), "_lo", "_hi"), "state-0")
    for i in range(1, passes + 1):
        open_ = state.filter("_lo < _hi")
        if open_.isEmpty():
            return state.select(*groups, "q", F.col("_lo").alias("quantile"))
        intervals = open_.select(*groups, "_lo", "_hi").distinct()
        inside = lookup_join(rows, intervals, groups).filter("_v BETWEEN _lo AND _hi")
        # Neither scale ever decreases in the value. Halved, so that the width of an interval does not overflow.
        equal = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        orders = _magnitude("_hi") - _magnitude("_lo")
        share = F.when(orders > 8, (_magnitude("_v") - _magnitude("_lo")) / orders).otherwise(equal)
        place = F.least(F.floor(share * buckets), F.lit(buckets - 1))
        counted = inside.groupBy(*groups, "_lo", "_hi", place.alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        order = Window.partitionBy(*groups, "_lo", "_hi").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("_upto", F.sum("_c").over(order))
        met = open_.join(counted, [*groups, "_lo", "_hi"]).filter("_rank > _upto - _c AND _rank <= _upto")
        narrowed = met.select(*groups, "q", (F.col("_rank") - F.col("_upto") + F.col("_c")).alias("_rank"), F.col("_least").alias("_lo"), F.col("_most").alias("_hi"))
        state = work.save(state.filter("_lo = _hi").unionByName(narrowed), f"state-{i}")
    raise RuntimeError("quantiles did not settle")
