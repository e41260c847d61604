"""Connected components of a table of links, by alternating large and small stars on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import stored


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the smallest node that is reachable) of all nodes with links, of any type that orders.

    Each round turns the neighbours of a node to the smallest one: first those above it, then those below it. Paths
    shorten to less than half in a round, so that rounds grow with the logarithm of the longest path. Degrees of a node
    are never gathered: stars are built by a minimum, which is summed up before it is shuffled, and a join.
    """
    edges = stored(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), "links")
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stored(both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").where("u < v").distinct(), "large")
        joined = large.join(large.groupBy("v").agg(F.min("u").alias("m")), "v")  # u below v: all neighbours below v turn to the smallest
        small = joined.select(F.col("m").alias("u"), "v").unionByName(joined.select(F.col("m").alias("u"), F.col("u").alias("v")))
        small = stored(small.where("u < v").distinct(), "small")
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            return small.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(small.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        edges = small
