"""Connected components of an edge table, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest reachable node) for every node of ``edges``
    (columns a, b).  Each round takes the smallest label of a node's
    neighbours and then that label's own label, which halves long chains;
    rounds are stored, so a lost executor repeats one round at most."""
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .where("a <> b").distinct(), "edges")
    labels = saved(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b")
        best = near.groupBy("a").agg(F.min("other").alias("other")).withColumnRenamed("a", "node")
        step = labels.join(best, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("other", "label")).alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = saved(step.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("top", "label")).alias("label")), "labels")
        if new.where("old <> label").isEmpty():
            return new.select("node", F.col("label").alias("component"))
        labels = new.select("node", "label")
