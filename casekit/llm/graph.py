"""Connected components of an undirected graph by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(a, b)`` edges over long node ids to ``(node, label)``; the label is the smallest
    node id of the component.

    Each round takes the least label around a node, then the label of that label, so a
    path of n nodes needs about log2(n) rounds.  Every round is an aggregate and joins on
    pre-combined keys, written to the shared folder; a node with very many neighbours is
    split by AQE's skew join and combined map-side.  Nothing is gathered on the driver but
    one count a round.
    """
    both = stored(edges.select("a", "b").where("a <> b")
                  .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
                               .where("a <> b")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label"))
    labels = stored(labels, "labels")
    for _ in range(max_rounds):
        # least label around each node
        around = (both.join(labels.withColumnRenamed("node", "b"), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        better = labels.join(around, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("hook"))
        better = stored(better, "labels")
        # a label is a node: follow it once more
        jump = better.select(F.col("node").alias("hook"), F.col("hook").alias("next"))
        after = better.join(jump, "hook").select(
            "node", F.least("hook", "next").alias("label"), "old")
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
