"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """The component of every node of ``links(a, b)``: columns node, label (its smallest node).

    Each round takes the smallest label among the neighbours, then jumps to the label of that
    label, so that chains shorten by halves; it ends when no label moves. An empty table gives an
    empty table; loops and repeated links change nothing.
    """
    links = links.where("a <> b")
    both = materialize(links.union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        seen = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        moved = materialize(seen.join(target, "label", "left").select("node", "was", F.least("label", "jump").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            return labels
