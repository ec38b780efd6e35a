"""Top rows of a frame and of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .skew import join_per_key


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """The first ``k`` rows: each task keeps k, the driver stage merges those."""
    return df.orderBy(*order).limit(k)


def ranked_top_k(df: DataFrame, k: int, value: str, tiebreak: str) -> DataFrame:
    """First ``k`` rows by value with ROW_NUMBER, RANK and DENSE_RANK.

    A rank depends only on rows ahead of it, and those are in the top k
    themselves, so ranking the k rows gives the ranks among all rows.
    """
    best = top_k(df, k, [F.desc(value), F.col(tiebreak)])
    peers = W.orderBy(F.desc(value))
    return best.select(
        "*",
        F.row_number().over(W.orderBy(F.desc(value), F.col(tiebreak))).cast("long").alias("row_number"),
        F.rank().over(peers).cast("long").alias("rank"),
        F.dense_rank().over(peers).cast("long").alias("dense_rank"),
    )


def top_n_per_group(
    df: DataFrame,
    by: str,
    value: str,
    n: int,
    ties: str = "dense_rank",
    name: str | None = None,
    keep: DataFrame | None = None,
) -> DataFrame:
    """Rows whose RANK or DENSE_RANK by descending ``value`` is at most ``n``.

    All tied rows are kept. Only distinct values are ranked: they are counted
    before the shuffle and each task passes on at most ``n`` per group, so
    neither a huge group nor a huge tie meets in one task. Pass a frame that is
    cheap to read twice. ``keep`` restricts the groups.
    """
    if ties not in ("rank", "dense_rank"):
        raise ValueError("ties must be 'rank' or 'dense_rank'")
    name = name or ties
    if keep is not None:
        df = df.join(keep.select(by), by, "left_semi")
    values = df.groupBy(by, value).agg(F.count("*").alias("_ties"))
    w = W.partitionBy(by).orderBy(F.desc(value))
    best = values.withColumn("_dense", F.row_number().over(w)).filter(F.col("_dense") <= n)
    if ties == "dense_rank":
        cut = best.select(by, value, "_ties", F.col("_dense").cast("long").alias(name))
    else:
        upto = F.sum("_ties").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
        cut = (
            best.withColumn(name, (upto - F.col("_ties") + 1).cast("long"))
            .filter(F.col(name) <= n)
            .select(by, value, "_ties", name)
        )
    return join_per_key(df, cut, [by, value], "_ties")


def top_row_numbers(df: DataFrame, by: str, order: Sequence, n: int, name: str = "row_number") -> DataFrame:
    """Exactly ``n`` rows per group (fewer if the group is smaller).

    Spark limits every task to ``n`` rows per group before the shuffle.
    """
    w = W.partitionBy(by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("long")).filter(F.col(name) <= n)


def best_per_group(df: DataFrame, by: str, value: str, label: str) -> DataFrame:
    """One row per group: the label with the largest value (smallest label on a
    tie), its value, and the total of the group, in one aggregation."""
    # Largest value first, then smallest label: the minimum of (-value, label).
    best = F.min(F.struct((-F.col(value)).alias("neg"), F.col(label).alias("label")))
    return (
        df.groupBy(by)
        .agg(best.alias("_best"), F.sum(value).alias("group_total"))
        .select(
            by,
            F.col("_best.label").alias(label),
            (-F.col("_best.neg")).alias(value),
            "group_total",
        )
    )


def share_of_group(df: DataFrame, by: str, value: str, name: str = "group_total") -> DataFrame:
    """Attach the total of each row's group without gathering the group.

    Pass a frame that is cheap to read twice.
    """
    totals = df.groupBy(by).agg(F.sum(value).alias(name), F.count("*").alias("_members"))
    return join_per_key(df, totals, [by], "_members")
