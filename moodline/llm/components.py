"""Connected components of an undirected edge table, by repeated least labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.tables import written


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, label): the least node of each component.

    Each round takes the least label among a node and its neighbours, then
    follows labels one step further, so paths shrink by more than half; every
    round is one partially aggregated shuffle and is written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("least"))
                     .select(F.col("a").alias("node"), F.least("a", "least").alias("label")))
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        stepped = (labels.join(near, labels["node"] == near["a"], "left")
                   .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        new = written(stepped.join(jump, stepped["label"] == jump["via"], "left")
                      .select("node", "was", F.least("label", "further").alias("label")))
        changed = new.where("label <> was").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
