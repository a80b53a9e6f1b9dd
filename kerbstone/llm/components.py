"""Connected components by alternating large-star and small-star steps, each cut with checkpoint()."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import materialise


def connected_components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node that an edge (a, b) names; component is the least node it reaches.

    The rows never outgrow the edges: both steps only point a node at the least node it knows. A hub's edges are
    joined with its one minimum, which adaptive execution may split; nothing is collected.
    """
    now = materialise(spark, edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        # large star: each greater neighbour of a node points at the least of its neighbourhood
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.unionByName(least.where("m <> u").select("u", F.col("m").alias("v"))).distinct()
        # small star: a node and its lesser neighbours point at the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(spark, small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
