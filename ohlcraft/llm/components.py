"""Connected components of a table of links, by labels that sink to the smallest id."""

from pyspark.sql import DataFrame, functions as F

from ohlcraft.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for the nodes of links (a, b); the smallest node names it.

    Each round a node takes the smallest label among itself, its neighbours and the node its
    label names, so that chains halve; it ends when no label sinks any more. Every round is
    written to the shared folder, and no node's links meet in one task: labels are joined to
    links, which a skewed join may split, and minima are formed before the shuffle.
    """
    ends = links.select("a", "b").union(links.select("b", "a")).distinct()
    ends = stage(ends.where("a <> b"), "links")
    labels = stage(
        ends.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")), "labels")
    while True:
        near = ends.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        sunk = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        named = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        sunk = stage(sunk.join(named, "component", "left").select(
            "node", "old", F.least("component", "next").alias("component")), "labels")
        labels = sunk.select("node", "component")
        if sunk.where("component < old").isEmpty():
            return labels
