"""Connected components of links, as joins that are written after every round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, class_id): the smallest node that each node of ``links`` (a, b) is connected with.

    Each round takes the smallest label among the neighbours, then the label of
    that label, until nothing changes.
    """
    edges = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("class_id")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("class_id").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("class_id").alias("old"), F.least("class_id", "near").alias("class_id"))
        jump = labels.select(F.col("node").alias("class_id"), F.col("class_id").alias("further"))
        moved = stored(
            lower.join(jump, "class_id").select("node", "old", F.least("class_id", "further").alias("class_id")), "labels")
        labels = moved.select("node", "class_id")
        if moved.filter("old <> class_id").isEmpty():
            return labels
