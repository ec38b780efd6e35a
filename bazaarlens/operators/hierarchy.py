"""Roll-ups along the digits of a code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.durable import cut_lineage


def with_ancestors(leaves: DataFrame, code: str, depths: int) -> DataFrame:
    """Each leaf once per prefix length: columns ``depth`` and ``node`` are added.

    This replaces the prefix join (a nested loop) by an equality.
    """
    return leaves.withColumn("depth", F.explode(F.sequence(F.lit(1), F.lit(depths)))).withColumn(
        "node", F.substring(F.col(code), F.lit(1), F.col("depth"))
    )


def prefix_rollup(leaves: DataFrame, code: str, depths: int, **measures: Column) -> DataFrame:
    """Aggregate leaves into all their ancestors in one shuffle."""
    return with_ancestors(leaves, code, depths).groupBy("depth", "node").agg(
        *[expr.alias(name) for name, expr in measures.items()]
    )


def prefix_tree(leaves: DataFrame, code: str, depths: int) -> DataFrame:
    """Distinct nodes per level, built downwards from the roots.

    Each level extends the known nodes by one digit and is deduplicated before
    the next, so a level never holds more rows than it has nodes.
    """
    codes = cut_lineage(leaves.select(code).distinct())
    level = codes.select(F.lit(1).alias("depth"), F.substring(code, 1, 1).alias("node")).distinct()
    tree = level
    for depth in range(1, depths):
        extended = codes.select(
            F.substring(code, 1, depth).alias("node"), F.substring(code, 1, depth + 1).alias("child")
        ).distinct()
        level = level.join(extended, "node").select(F.lit(depth + 1).alias("depth"), F.col("child").alias("node"))
        tree = tree.unionByName(level)
    return tree


def closure(edges: DataFrame) -> DataFrame:
    """All (ancestor, descendant, distance) pairs of a parent-child relation, at their least distance.

    Paths are doubled: a least path of more than ``reach`` edges, up to twice as
    many, is one of exactly ``reach`` edges and a known one. So every round joins
    the pairs at that distance with all known pairs, keeps the least sum, and
    leaves known pairs out, which also ends cycles. A chain of n edges takes about
    log2(n) rounds. Every round is written to the shared folder, so neither the
    plan nor the lineage grows.
    """
    known = cut_lineage(edges.select(
        F.col("parent").alias("ancestor"), F.col("child").alias("descendant"), F.lit(1).alias("distance")).distinct())
    reach = 1
    while True:
        farthest = known.filter(F.col("distance") == reach).select("ancestor", F.col("descendant").alias("via"))
        if farthest.isEmpty():
            return known
        onward = known.select(F.col("ancestor").alias("via"), "descendant", (F.col("distance") + reach).alias("distance"))
        longer = (
            farthest.join(onward, "via").groupBy("ancestor", "descendant").agg(F.min("distance").alias("distance"))
            .join(known.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti")
        )
        known = known.unionByName(cut_lineage(longer))
        reach *= 2
