"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each step links the neighbours of a node to the smallest of them; steps are map-side aggregations and joins on
    the node, and a written table ends each round. Rounds grow with the logarithm of the longest chain. No edges
    give no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = written(e, f"{name}-0")
    seen = None
    for k in range(1, 60):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v")))
        last, e = e, written(moved.where("u <> v").distinct(), f"{name}-{k}")
        discard(last)
        now = tuple(
            e.agg(
                F.count("*"),
                F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
            ).first()
        )
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("u"), "v").distinct()
    return e.union(roots).groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
