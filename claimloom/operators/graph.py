"""Connected components by label propagation with pointer jumping, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.session import cut


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """nodes(node), edges(a, b) -> node, component (the smallest node of the component).

    Each round a node takes the smallest label among its own and its neighbours', then the label of its label (pointer jumping), so
    rounds grow with the logarithm of the diameter. Labels are checkpointed each round in the shared folder. Only one count a round
    reaches the driver. Defined results: nodes without edges are their own component; null ends of edges, loops and repeats are
    ignored; ends of edges that are no nodes are added.
    """
    e = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    both = cut(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = cut(ends.withColumn("label", F.col("node")))
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        step = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("low", "label")).alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        fresh = cut(step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")))
        changed = fresh.filter("old <> label").limit(1).count()
        labels = fresh.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    alone = nodes.select("node").distinct().join(ends, "node", "left_anti")
    return labels.select("node", F.col("label").alias("component")).unionByName(alone.select("node", F.col("node").alias("component")))
