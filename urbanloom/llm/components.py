"""Connected components over edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least")).withColumn("least", F.least("least", "high"))
    moved = both.filter(F.col("low") > F.col("high")).join(least, "high")
    return moved.select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these neighbours."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    others = edges.join(least, "high").filter(F.col("low") != F.col("least"))
    return others.select(F.col("low").alias("high"), F.col("least").alias("low")).unionByName(
        least.select("high", F.col("least").alias("low"))
    ).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node of each component, for nodes of ``links`` that
    are not that node themselves. Edges stay edges between two nodes: no group of
    neighbours is ever gathered, a hub's rows are joined with its one minimum. Each round
    is stored, so the plan does not grow and a lost executor costs one round."""
    a, b = F.col(left), F.col(right)
    edges = stored(
        links.filter(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct(), "edges"
    )
    state = None
    while True:
        sums = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if state == tuple(sums):
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
        state = tuple(sums)
        edges = stored(_small_star(_large_star(edges)), "edges")
