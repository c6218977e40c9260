"""Connected components by alternating large and small stars; edges stay distributed, each round is written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import discard, written


def _round(edges: DataFrame) -> DataFrame:
    """edges(u > v) -> (u, v, moved): moved holds nowhere when all were stars around their least node.

    Large star: larger neighbours of a node go to the least of its neighbours; the least is found by partial aggregates,
    so a node with very many neighbours is no single task's work. Small star: what a node's smaller neighbours have in
    common is its least one; after the large star a node has few of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    up = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") < F.col("u")).alias("moved"))
    down = up.repartition("u").groupBy("u", "v").agg(F.bool_or("moved").alias("moved")).withColumn("m", F.min("v").over(W.partitionBy("u")))
    other = F.col("v") > F.col("m")
    return down.select(F.when(other, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (F.col("moved") | other).alias("moved"))


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v: long) -> (node, component): the least node reachable, for every node that has an edge to another. As
    many rounds as it takes; their number grows with the logarithm of a chain's length."""
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = None
    while True:
        now = written(_round(now.select("u", "v")))
        if before is not None:
            discard(before)
        if not now.where("moved").limit(1).count():
            break
        before = now
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
