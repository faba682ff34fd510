"""Connected components of a link table, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Each round, a node takes the smallest label among its neighbours' labels
    and its own, then the label of its label (which halves the way to the
    smallest). Neighbours' labels are aggregated before they are shuffled, so a
    node with many links is no hot task. Rounds end when no label changes.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).union(links.select(F.col(b), F.col(a))).where("x <> y").distinct()
    edges = cut_lineage(both, "component-edges")
    labels = cut_lineage(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("component")), "component-labels")
    while True:
        near = edges.join(labels, edges["y"] == labels["node"]).groupBy(F.col("x").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.col("component").alias("was"), F.least("component", F.coalesce("near", "component")).alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("further"))
        new = cut_lineage(step.join(jump, "c", "left").select("node", "was", F.least("c", F.coalesce("further", "c")).alias("component")), "component-labels")
        changed = new.where("was <> component").limit(1).count()
        labels = new.drop("was")
        if not changed:
            return labels
