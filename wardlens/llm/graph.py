"""Connected components of a table of links, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of every node of ``links`` (columns ``a``,
    ``b``). Each round takes the smallest label among the neighbours, then the label of that label, so long
    chains halve; each round is written to the shared folder. A node with very many links costs a partial
    minimum, not a group in one task."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), f"{name}-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), name)
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("l")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("l").alias("near")))
        step = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("label").alias("far"))
        new = stored(step.join(jump, "now", "left").select(
            "node", "was", F.least("now", F.coalesce("far", "now")).alias("label")), name)
        labels = new.select("node", "label")
        if new.filter("was <> label").isEmpty():
            return labels
