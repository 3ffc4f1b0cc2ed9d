"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktidy.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` edges -> ``(node, label)``: the smallest node of each component, for nodes with edges.

    Smallest labels spread along the edges and labels are followed to their own label, so long chains
    take few rounds.  It stops when nothing changes.  Joins and grouped minima only: a node with very
    many edges is split by the adaptive skew join and combined before the shuffle.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = stage(both, "edges")
    labels = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        reached = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("reached"))
        spread = labels.join(reached, labels.node == reached.a).select("node", F.col("label").alias("before"), F.least("label", "reached").alias("label"))
        spread = stage(spread, "spread")
        owner = spread.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stage(spread.join(owner, "label").select("node", "before", F.col("next").alias("label")), "labels")
        if labels.filter("label <> before").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
