"""Gap-free calendar series.

Series have one row per calendar month, so windows over them are bounded by the
length of the calendar, whatever the size of the facts behind them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def month_spine(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every month start from ``first`` to ``last`` inclusive."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return month_spine_between(bounds, F.col("a"), F.col("b"))


def month_spine_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Months between two date columns of a one-row frame."""
    steps = F.sequence(first, last, F.expr("interval 1 month"))
    return bounds.select(F.explode(steps).alias("month"))


def densify(spine: DataFrame, series: DataFrame, fill: Mapping[str, object], on: str = "month") -> DataFrame:
    """One row per spine entry; missing values become the given constants.

    ``series`` has at most one row per month of the calendar, so it is broadcast.
    """
    joined = spine.join(F.broadcast(series), on, "left")
    filled = [F.coalesce(F.col(c), F.lit(v).cast(series.schema[c].dataType)).alias(c) for c, v in fill.items()]
    return joined.select(on, *filled)


def trailing(order: str, first: int, last: int = 0):
    """ROWS BETWEEN ``first`` PRECEDING AND ``last`` PRECEDING, over a series."""
    return W.orderBy(order).rowsBetween(-first, -last)


def full_frame_only(expr: Column, window, rows: int) -> Column:
    """``expr`` once the frame holds ``rows`` rows, NULL while it warms up."""
    return F.when(F.count("*").over(window) == rows, expr)
