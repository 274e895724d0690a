"""Connected components of links between nodes of any type that has an order."""

from pyspark.sql import DataFrame, functions as F

from chondria.operators.storage import settled


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``links(a, b)``; the root is the least node that can be reached.

    Every round hangs each node on the least root among its neighbours' roots and then halves the paths to the roots, so the number of rounds grows with the
    logarithm of the longest chain. A round is stored, and ends the lineage of the one before. Minima are partial aggregates, so a node may
    have any number of links. The rounds run when this is called.
    """
    edges = settled(links.filter("a <> b").select("a", "b").unionByName(links.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                    "links")
    state = settled(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "roots")
    while True:
        by_node = state.select(F.col("node").alias("b"), F.col("root").alias("r"))
        seen = edges.join(by_node, "b").groupBy("a").agg(F.min("r").alias("r"))
        near = state.join(seen, state["node"] == seen["a"]).select("node", "root", F.least("root", "r").alias("r"))
        # A root is hung, too, on what any of its nodes has seen.
        hung = near.select(F.col("node").alias("n"), "r").unionByName(near.select(F.col("root").alias("n"), "r")).groupBy("n").agg(F.min("r").alias("r"))
        up = hung.select(F.col("n").alias("m"), F.col("r").alias("rr"))
        after = settled(hung.join(up, hung["r"] == up["m"]).select(F.col("n").alias("node"), F.least("r", "rr").alias("root")), "roots")
        moved = after.join(state.withColumnRenamed("root", "was"), "node").filter("root <> was").limit(1).count()
        state = after
        if not moved:
            return state
