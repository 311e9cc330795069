"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.session import reliable_checkpoint


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable.

    Each round a node takes the smallest label among its own and its neighbours', then the label of that
    label; stars end after two rounds, long chains after about as many as the logarithm of their length.
    Labels are aggregated map-side first, so a node with very many links is no hot spot; each round is a
    written table, so a lost executor costs one round at most.  Links and labels stay on the cluster."""
    both = reliable_checkpoint(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = reliable_checkpoint(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        moved = reliable_checkpoint(step.join(jump, step["label"] == jump["via"], "left").select(
            "node", F.least("label", F.coalesce("beyond", "label")).alias("label"), "old"))
        if moved.where("label <> old").isEmpty():
            return moved.select("node", F.col("label").alias("component"))
        labels = moved.select("node", "label")
