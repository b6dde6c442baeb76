"""Groups of nodes that links join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.session import discard, settle


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the lowest node it can reach.

    Nodes are of any type that can be ordered, structs included.  Labels spread
    along the links and jump to the label of their label, so the rounds grow
    with the logarithm of the longest chain.  Tables of past rounds are dropped.
    """
    # Both ways from one reading of the links, which may be a costly join.
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = settle(links.select(F.explode(ways).alias("_w")).select("_w.a", "_w.b").distinct(), "edges")
    labels = settle(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct(), "labels")
    while True:
        reached = labels.select(F.col("node").alias("b"), "root")
        near = edges.join(reached, "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        stepped = labels.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_next"))
        stepped = settle(stepped, "labels")
        jump = stepped.select(F.col("node").alias("_next"), F.col("_next").alias("_far"))
        after = settle(stepped.join(jump, "_next").select("node", F.least("_next", "_far").alias("root"), "_old"), "labels")
        still = after.where(F.col("_old") != F.col("root")).isEmpty()
        discard(stepped)
        discard(labels)
        labels = after
        if still:
            discard(edges)
            return labels.select("node", "root")
