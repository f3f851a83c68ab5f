"""Connected components of a table of edges, by joins."""

from pyspark.sql import functions as F

from waybill.llm.frames import stored


def both_ways(edges):
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges):
    """(node, root) for every node of `edges` (a, b); the root is the smallest node it is
    connected to. Each round takes the smallest root among the neighbours, then the root's
    own root, so a chain of n nodes needs about log n rounds. Only the number of changed
    nodes comes to the driver."""
    links = stored(both_ways(edges).distinct(), "links")
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = stored(roots.select("node", F.least("node", "root").alias("root")), "roots")
    while True:
        near = links.join(roots, links.b == roots.node).groupBy("a").agg(F.min("root").alias("near"))
        seen = roots.join(near, roots.node == near.a).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("up")
        )
        over = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        moved = stored(
            seen.join(over, "up").select("node", F.least("up", "top").alias("root"), "old"),
            "roots",
        )
        changed = moved.where("root <> old").limit(1).count()
        roots = moved.drop("old")
        if not changed:
            return roots
