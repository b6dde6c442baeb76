"""Connected components of link tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.session import discard, settle


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the links ``a, b``; ``comp`` is the component's smallest node.

    Every round takes the smallest label among a node's neighbours and then
    follows the label's own label, so long chains need few rounds.  Minima are
    combined before they move, and hot nodes are only the streamed side of a
    join.  Rounds go on until nothing changes; each is a written table.
    """
    both = links.where("a <> b").select("a", "b")
    both = settle(both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("_near"))
        hooked = settle(
            labels.join(near, labels["node"] == near["a"]).select("node", "comp", F.least("comp", "_near").alias("_low")), "hooked"
        )
        root = hooked.select(F.col("node").alias("_root"), F.col("_low").alias("_of_root"))
        jumped = hooked.join(root, hooked["_low"] == root["_root"]).select(
            "node", F.col("_of_root").alias("comp"), (F.col("_of_root") < F.col("comp")).alias("_moved")
        )
        after = settle(jumped, "labels")
        discard(labels)
        discard(hooked)
        labels = after.select("node", "comp")
        if after.where("_moved").isEmpty():
            discard(both)
            return labels
