"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, label): label is the smallest node of its component. Nodes
    without edges don't appear.

    Each step replaces every node's edges by edges to the least neighbour: first for
    greater neighbours (large star), then for smaller ones (small star). It ends when a
    step changes nothing: each component is then a star around its least node. The least
    neighbour is a partial aggregate, so a hub's edges are never gathered in one task.
    Every step is written out, which cuts the lineage.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc-0")
    before, step = None, 0
    while True:
        size = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if size == before or not size[0]:
            break
        before, step = size, step + 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))
        now = staged(small.where("u <> v").distinct(), f"cc-{step}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
