"""Connected components of an edge table, by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.storage import saved

MOST_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges (a long, b long): label is the least node of its component.

    Each round takes the least label among a node and its neighbours, then the
    label of that label, so a path shrinks by more than half a round.  Sums are
    pre-aggregated and joins can be split by adaptive execution, so a node with
    many edges loads no single task.
    """
    both = saved(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))).where("node IS NOT NULL AND other IS NOT NULL").distinct())
    labels = saved(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")))
    for _ in range(MOST_ROUNDS):
        told = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        nearer = labels.join(told, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = saved(nearer.join(up, "label", "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), (F.least("label", F.coalesce("up", "label")) < F.col("old")).alias("moved")))
        labels = new.drop("moved")
        if new.where("moved").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
