"""Connected components of a graph of links, by joins: the least label of the neighbours, then of the label's label, until nothing changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store


def components(links: DataFrame) -> DataFrame:
    """node, label (least node that can be reached) for every node of links (a, b)."""
    both = store.cut(links.select("a", "b").union(links.select("b", "a")).distinct(), "cc-links")
    labels = store.cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = store.cut(labels.join(near, "node").select("node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "cc-lower")
        store.discard(labels)
        up = lower.select(F.col("node").alias("label"), F.col("label").alias("up"))
        labels = store.cut(lower.join(up, "label").select("node", F.col("up").alias("label"), (F.col("moved") | (F.col("up") < F.col("label"))).alias("moved")), "cc-labels")
        store.discard(lower)
        if not labels.where("moved").limit(1).count():
            store.discard(both)
            return labels.select("node", "label")
