"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import checkpointed, compact, few


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: neighbours above u go to the least of u and its neighbours. Small star: u and its neighbours below go to the least of these. Every join is on an edge's end, so a hot end is split as a skewed join."""
    both = edges.select("u", "v").where("u > v") if small else edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    moved = joined.where("v <> m" if small else "v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """From edges (u, v): node and component, the least node of its component, for every node with an edge to another."""
    now, rows = compact(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        # a star has no more edges than what it was made of
        now = few(checkpointed(few(_stars(few(_stars(now, small=False), rows), small=True), rows)), rows)
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
