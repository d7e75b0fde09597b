"""Connected components by alternating star contractions, each a pair of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantlake.llm.common import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    hashed = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), hashed).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): ``root`` is the smallest node that ``node`` reaches over ``edges`` (a, b).

    Nodes without an edge to another node are left out. Every round is written to the shared folder, so a lost executor
    costs one round at most.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = store(pairs.distinct(), "edges")
    before = _signature(current)
    while before[0]:
        current = store(_small_star(_large_star(current)), "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
