"""Connected components of a table of links, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.session import cut_lineage


def min_labels(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) for every node of ``links`` (``a``, ``b``).

    A round gives each node the smallest label of its neighbours (a partial minimum per task, so a node with
    very many links is no group in one task) and then the label of that label, so a chain of n nodes
    needs about log2(n) rounds. Each round is a reliable checkpoint; the last one changes nothing."""
    both = cut_lineage(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                         .select("node", F.least("node", "least").alias("label")))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("label").alias("its"))
        near = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("its").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("now"))
        target = labels.select(F.col("node").alias("now"), F.col("label").alias("far"))
        step = cut_lineage(step.join(target, "now", "left")
                           .select("node", "label", F.least("now", F.coalesce("far", "now")).alias("next")))
        labels = step.select("node", F.col("next").alias("label"))
        if step.filter("label <> next").isEmpty():
            return labels
