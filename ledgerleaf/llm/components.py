"""Connected components of a graph given as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    return down.join(least, "a").select("b", "low").unionByName(least.select(F.col("a").alias("b"), "low")).select(F.col("b").alias("a"), F.col("low").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the smallest node it is connected to.

    Each round is written to the shared folder; the links stay there, only their number and checksum reach the driver.
    A node's neighbours are never gathered: its smallest is an aggregate, and a join hands it on.
    """
    clean = lambda e: e.filter("a <> b").distinct()
    edges = materialise(clean(edges.select("a", "b")), "links")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        if state[0] == 0:
            break
        edges = materialise(clean(_small_star(clean(_large_star(edges)))), "links")
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
