"""Connected components of a graph given as pairs of numbers, by alternating star steps.

Each round links every node to the least of its neighbours: a large-star step for greater neighbours, then a
small-star step for lesser ones. Minima are combined before the shuffle and joins on hubs can be split, so no node's
neighbours ever meet in one task. Rounds are few (about the logarithm of the longest chain) and each is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.session import pin


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """node and component (the least node reachable) for every node that has a link to another."""
    edges = pin(
        pairs.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct()
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.lit(0)), F.count_distinct("u"),
        ).first()
        if state[0] == 0 or (state[:2] == seen and state[0] == state[2]):
            break
        seen = state[:2]
        edges = pin(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
