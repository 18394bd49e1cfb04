"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and one join, pre-aggregated before its shuffle; the edge
table is written to shared storage between steps. After O(log n) rounds each node of
a component points at its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.text import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, root: str) -> DataFrame:
    """``node, component`` (smallest node) for every node with an edge in ``edges (a, b)``.

    Null ends and loops are no edges; repeated and reversed edges count once; no edges, no rows.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen, step = stored(now, root, "edges_0"), None, 0
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen, step = state, step + 1
        now = stored(_small_star(_large_star(now)), root, f"edges_{step}")
