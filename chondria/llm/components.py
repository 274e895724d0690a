"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chondria.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)`` but the roots: root is the smallest node that can be reached.

    Each round joins every node's links with the smallest node among them. Minima are partial aggregates and the joins are
    split by adaptive execution, so a hub may have any number of links. Each round is stored; rounds grow with the logarithm of
    the longest chain.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = stored(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.countDistinct("a")).first()
        if now == state and now[0] == now[2]:
            return edges.toDF("node", "root")
        state = now
