"""Connected components of links between numbered nodes, as joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.shared import kept


def components(links: DataFrame) -> DataFrame:
    """`node` and `label` (the smallest node of its component) for every node of `links` (a, b).

    Each round the smallest label among a node's neighbours goes to the node and to the node that
    is its label, so whole trees are hooked and not their leaves alone; then each node takes its
    label's label. Labels only fall, and rounds end when none does. Each round is written to the
    shared folder.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = kept(both.where("a != b").distinct(), "links")
    labels = kept(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = kept(labels.join(seen, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label")), "lower")
        hooks = lower.where("label < before").groupBy(F.col("before").alias("node")).agg(F.min("label").alias("hook"))
        hooked = lower.join(hooks, "node", "left").select("node", "before", F.least("label", "hook").alias("label"))
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        step = kept(hooked.join(above, "label").select("node", "before", F.col("above").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("label != before").isEmpty():
            return labels
