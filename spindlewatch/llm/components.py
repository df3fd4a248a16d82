"""Connected components of a graph given as a table of links."""

from pyspark.sql import functions as F

from spindlewatch.llm.common import written


def _signature(edges):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(links):
    """(node, label) of every node in ``links`` (a, b): nodes have equal labels exactly if links connect them.

    The label is the smallest node of a component. Links are moved towards smaller nodes, in two alternating
    ways, until each node is linked with its component's smallest only; the number of rounds grows with the
    logarithm of a component's extent. Every round is written, and compared with the one before by count and
    hash, so nothing is gathered on the driver.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "links")
    before = _signature(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("w"))
        least = least.select("node", F.least("node", "w").alias("least"))
        # Larger neighbours of a node are linked with the smallest neighbour of that node.
        large = (
            edges.join(least, edges["v"] == least["node"])
            .select("u", F.col("least").alias("v"))
            .distinct()
        )
        small_least = large.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
        # Smaller neighbours of a node, and itself, are linked with the smallest of them.
        small = (
            large.join(small_least, large["u"] == small_least["node"])
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
            .where("u != v")
            .distinct()
        )
        edges = written(small, "links")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
