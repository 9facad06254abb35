"""Connected components over an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import materialise


def connect(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns u, v); root is the component's smallest node.

    Each round gives a node the smallest label among its neighbours and then
    that label's own label, so the number of rounds is about the logarithm of
    the longest path. Labels are written between rounds. Both sides of a join
    are plain scans, so that Spark can split a node with very many neighbours.
    """
    both = edges.filter("u <> v").select("u", "v").union(edges.filter("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialise(both.distinct(), "links")
    labels = materialise(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select("node", F.least("node", "low").alias("root")),
        "labels",
    )
    while True:
        seen = both.join(labels, both.v == labels.node).select(F.col("u").alias("node"), "root")
        lower = seen.union(labels).groupBy("node").agg(F.min("root").alias("root"))
        lower = materialise(lower, "labels")
        up = lower.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = lower.join(up, "root").select("node", F.col("above").alias("root"))
        jumped = materialise(jumped, "labels")
        changed = jumped.exceptAll(labels).limit(1).count()
        labels = jumped
        if not changed:
            return labels
