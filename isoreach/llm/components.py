"""Connected components of a link table, by rounds of joins (alternating large and small stars).

Rounds are written to the shared folder, so a lost executor costs one round. Links at a hot node are split by Spark's
skew join; minima are combined before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoreach.operators.joins import Workspace


def _least(pairs: DataFrame) -> DataFrame:
    """For each node ``u``, the least of itself and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least node of u's surroundings."""
    both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.filter(F.col("v") > F.col("u")).join(_least(both), "u")
    own = _least(both).filter(F.col("m") < F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(own.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, are linked to the least of them. Links are (larger u, smaller v)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = links.join(least, "u").filter(F.col("v") != F.col("m"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, work: Workspace, name: str = "components", rounds: int = 60) -> DataFrame:
    """(id, component_id) of every node of ``links`` (u, v); the component is named by its least node.

    Self links and repeated links are allowed; null ends link nothing; an empty table gives an empty result.
    """
    links = links.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = work.save(ordered, f"{name}-0")
    for i in range(1, rounds + 1):
        # Done when every node has one link and no node is both a leaf and a root.
        leaves, distinct = now.agg(F.count(F.lit(1)), F.count_distinct("u")).first()
        if leaves == distinct and not now.join(now.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component_id"))
            return now.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionAll(roots)
        large = work.save(_large_star(now).distinct(), f"{name}-{i}-large")
        after = work.save(_small_star(large).distinct(), f"{name}-{i}")
        work.drop(f"{name}-{i}-large")
        work.drop(f"{name}-{i - 1}")
        now = after
    raise RuntimeError("components did not converge")
