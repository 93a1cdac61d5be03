"""Connected components of a link table, by joins and aggregates over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node it can reach.

    Each round hangs the larger neighbours of a node under its smallest one (large star) and then all of its
    neighbours that are not larger (small star); the number of rounds grows with the logarithm of a component's
    length.  A round keeps no more links than there were, and ends when no link has moved.
    """
    edges = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    mark = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = store(large, "large_star")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(low.select("a", F.col("m").alias("b")))
        edges = store(small.where("a <> b").distinct(), "small_star")
        # the links of two rounds are the same set exactly when count and both sums agree
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == mark:
            break
        mark = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
