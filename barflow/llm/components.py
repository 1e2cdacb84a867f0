"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Smallest node (``comp``) that each ``node`` of the links (``a``, ``b``) reaches; nodes without links are absent.

    Every round takes the least label among a node's neighbours and then its label's label, so long chains halve. Each
    round is written to the shared folder, so that a lost executor costs one round at most.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = labels.alias("l").join(seen.agg(F.min("comp").alias("least")).alias("s"), "node")
        near = materialize(near.select("node", "comp", F.least("comp", "least").alias("next")))
        jump = near.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = near.join(jump, "next").select("node", F.least("next", "far").alias("comp"), F.col("comp").alias("old"))
        moved = materialize(moved)
        labels = moved.select("node", "comp")
        if moved.filter("comp <> old").isEmpty():
            return labels
