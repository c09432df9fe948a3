"""Connected components of a table of links, by alternating stars, without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest one; u > v in every edge."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node but the roots: root is the smallest node that it reaches."""
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = common.stage(spark, edges, "links")
    mark = None
    while True:
        edges = common.stage(spark, _star(_star(edges, True), False), "stars")
        row = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(row) == mark or not row[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(row)
