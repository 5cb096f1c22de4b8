"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronoctx.plans.session import store


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``u, v``, with the smallest node
    of its component as root.

    Every round hangs each node's greater neighbours onto the smallest one it
    knows, then its smaller ones, until the edges are stars; the rounds grow with
    the logarithm of the nodes. Edges are written each round, so their lineage
    stays short, and never leave the executors.
    """
    both = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    edges = store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _checksum(edges)
    while True:
        around = edges.select(F.inline(both))
        least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = store(large.join(least, "u").select(F.inline(hung)).where("u > v").distinct(), "edges")
        now = _checksum(edges)
        if now == seen:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        seen = now
