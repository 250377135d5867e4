"""Connected components of links, by alternating large and small stars.

Each round is two aggregations by node, with minima taken on the map side, and joins whose
skewed sides Spark splits. Rounds grow with the logarithm of the number of nodes; what a
round leaves is stored in the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.sources.durable import durable


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node sends its (larger or smaller) neighbours to the least of them."""
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges  # u > v in every edge
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    if large:
        moved = sides.filter("v > u").join(least, "u").select(F.col("v").alias("u"), "m")
    else:
        others = sides.join(least, "u").select(F.col("v").alias("u"), "m")
        moved = others.unionByName(least.select("u", "m"))
    moved = moved.filter("u <> m").select(
        F.greatest("u", "m").alias("u"), F.least("u", "m").alias("v")
    )
    return moved.distinct()


def components(links: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every node of ``links (a, b)``; component: its least id.

    Links may repeat, point either way or join a node to itself; nulls link nothing. An
    empty table gives an empty result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    nodes = edges.filter("u = v").select("u", "v")
    edges = durable(edges.filter("u > v").distinct(), "links")
    mark = None
    while True:
        sums = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if sums[0] == 0 or tuple(sums) == mark:
            break
        mark = tuple(sums)
        edges = durable(_stars(durable(_stars(edges, True), "stars"), False), "stars")
    joined = edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id"))
    alone = nodes.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return joined.unionByName(roots.unionByName(alone)).groupBy("id").agg(
        F.min("component_id").alias("component_id")
    )
