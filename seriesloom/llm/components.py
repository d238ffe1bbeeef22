"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b: long); the root is the smallest node reachable.

    Each round turns neighbourhoods into stars around smaller nodes: large stars hand a node's larger
    neighbours to its smallest one, small stars the smaller ones (and the node). Rounds grow with the
    logarithm of the nodes; each is written, and nothing but counts comes to the driver.
    """
    edges = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.filter(F.col("a") != F.col("b")), "large-stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter(F.col("a") != F.col("b")).distinct(), "small-stars")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).head()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
