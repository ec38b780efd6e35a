"""Joins that keep the grain of the report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grand_total(df: DataFrame, expr: Column) -> Column:
    """A total over a whole frame, usable next to any row (scalar subquery)."""
    return df.agg(expr).scalar()


def small_side(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Broadcast a stored lookup if it is counted to be small.

    A larger one is returned as it is, for Spark to join by shuffling. Pass a
    table or written frame: it is counted here and read again by the join.
    """
    return F.broadcast(df) if df.count() <= rows else df


def labelled(df: DataFrame, lookup: DataFrame, key: str, translated: str, name: str) -> DataFrame:
    """Translate ``key`` through an incomplete lookup, keeping what it misses."""
    return df.join(lookup, key, "left").withColumn(name, F.coalesce(translated, key)).drop(translated)


def per_parent(child: DataFrame, key: str, **measures: Column) -> DataFrame:
    """Collapse a child table to one row per parent, so the join is one to one."""
    return child.groupBy(key).agg(*[expr.alias(name) for name, expr in measures.items()])


def repeated_sum(value, copies) -> Column:
    """Sum of ``value`` had every row been repeated ``copies`` times.

    A row-by-row join of two children repeats every row of one child once per
    row of the other. With both children aggregated per parent, the inflated
    totals follow from the counts and the repeated rows are never built.
    """
    return F.sum(F.col(value) * F.col(copies).cast("decimal(10,0)"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return child.filter(F.col(column).isNotNull()).join(keys, F.col(column) == F.col("_parent"), "left_anti")


def role_join(df: DataFrame, lookup: DataFrame, key: str, roles: Sequence[tuple[str, str]]) -> DataFrame:
    """Join the same lookup once per role, prefixing its columns.

    ``roles`` pairs a column of ``df`` with a prefix. Unmatched rows stay.
    """
    for column, prefix in roles:
        side = lookup.select(
            F.col(key).alias("_role_key"),
            *[F.col(c).alias(f"{prefix}_{c}") for c in lookup.columns if c != key],
        )
        df = df.join(side, F.col(column) == F.col("_role_key"), "left").drop("_role_key")
    return df
