"""Trailing frames over groups of any size.

A window sorts each group in one task. Here a group is cut into blocks, and each
block also gets the rows that the frames of its first rows reach back to (its
halo), so that a hot group spreads over many tasks. A halo is at most as long as
the frame, and a block no shorter, so the rows are at most doubled.

A measure is ("sum" | "count" | "min" | "max", column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import ordered_scan
from .skew import join_per_key

BLOCK_ROWS = 50_000
# Width of a block of values, in frames.
BLOCK_FRAMES = 4

KINDS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _blocks(df: DataFrame, place: Column, frame: int, width: int) -> DataFrame:
    """``df`` with the block of each row; rows that the next blocks reach back to come once more for each, as halo."""
    own = F.floor(place / F.lit(width))
    last = F.floor((place + frame) / F.lit(width))
    return df.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(own, last)))


def trailing_rows(
    df: DataFrame, order: Sequence, by: Sequence[str], measures: Mapping[str, tuple[str, str]],
    first: int, last: int = 0, block: int = BLOCK_ROWS,
) -> DataFrame:
    """Measures over ROWS BETWEEN ``first`` PRECEDING AND ``last`` PRECEDING of each group.

    ``order`` must be unique within a group.
    """
    numbered = ordered_scan(df, order, by, number="_row")
    blocks = _blocks(numbered, F.col("_row") - 1, first, max(block, first))
    frame = W.partitionBy(*by, "_block").orderBy("_row").rowsBetween(-first, -last)
    found = blocks.select("*", *[KINDS[kind](source).over(frame).alias(name) for name, (kind, source) in measures.items()])
    return found.filter(F.col("_own") == F.col("_block")).drop("_row", "_own", "_block")


def trailing_range(
    df: DataFrame, order: str, by: Sequence[str], measures: Mapping[str, tuple[str, str]], first: int,
) -> DataFrame:
    """Measures over RANGE BETWEEN ``first`` PRECEDING AND CURRENT ROW of each group.

    ``order`` is a date (``first`` counts days) or a whole number, not NULL. Rows
    with one value share their frame, so they are summed up before anything is
    ordered, however many they are. Pass a frame that is cheap to read twice.
    """
    merged = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    values = df.groupBy(*by, order).agg(
        F.count("*").alias("_rows"), *[KINDS[kind](source).alias(f"_at_{name}") for name, (kind, source) in measures.items()])
    is_date = df.schema[order].dataType.simpleString() == "date"
    values = values.withColumn("_place", (F.unix_date(order) if is_date else F.col(order)).cast("long"))
    blocks = _blocks(values, F.col("_place"), first, max(1, BLOCK_FRAMES * first))
    frame = W.partitionBy(*by, "_block").orderBy("_place").rangeBetween(-first, W.currentRow)
    found = blocks.select(
        *by, order, "_rows", "_own", "_block",
        *[merged[kind](f"_at_{name}").over(frame).alias(name) for name, (kind, _) in measures.items()])
    per_value = found.filter(F.col("_own") == F.col("_block")).drop("_own", "_block")
    return join_per_key(df, per_value, [*by, order], "_rows")
