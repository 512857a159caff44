"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is joins and partially aggregated minima on node ids; nothing is collected but
one checksum row.  Edges are checkpointed each round, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.max("v")).first())


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node with an edge to another; component = the smallest node."""
    stars = saved(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct())
    before, now = None, checksum(stars)
    while now != before:
        stars = saved(small_star(large_star(stars)))
        before, now = now, checksum(stars)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
