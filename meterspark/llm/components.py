"""Connected components of links, by the smallest node that reaches each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterspark.llm.storage import kept


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in `links` (a, b): label is the smallest node reachable.

    Each round takes the least label among the neighbours and then follows labels once (pointer
    jumping), so rounds grow with the logarithm of the longest chain. Labels, links and components
    stay distributed; per round just the number of changes reaches the driver.
    """
    edges = kept(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                 .filter("a <> b").distinct())
    labels = kept(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = (edges.join(labels, edges["b"] == labels["node"])
                .groupBy("a").agg(F.min("label").alias("near")))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("beyond"))
        after = kept(lower.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("beyond", "low")).alias("new"), "label"))
        moved = after.filter("new < label").limit(1).count()
        labels = after.select("node", F.col("new").alias("label"))
        if not moved:
            return labels
