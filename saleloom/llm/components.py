"""Connected components of an undirected graph, by label propagation with pointer jumping on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleloom.operators.work import freeze


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node of its component.

    A round takes the smallest label among a node's neighbours, then the label of that label; the rounds needed grow
    with the logarithm of the longest path. Labels of neighbours are combined before the shuffle, so that a node of
    very many edges is no bottleneck. Nothing is gathered on the driver but the number of changed labels.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = freeze(both.distinct(), "edges")
    lowest = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = freeze(lowest.select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        found = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        found = freeze(found, "labels")
        jump = found.select(F.col("node").alias("at"), F.col("label").alias("next"))
        jumped = found.join(jump, F.col("label") == F.col("at")).select(
            "node", "old", F.least("label", "next").alias("label"))
        jumped = freeze(jumped, "labels")
        changed = jumped.where("label <> old").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
