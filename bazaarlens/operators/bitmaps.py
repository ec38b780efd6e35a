"""Exact distinct counts that merge: dense numbers for ids, and bitmaps of them.

COUNT(DISTINCT) of a coarser group cannot be computed from those of finer ones.
Bitmaps can: one per group and range of 32,768 numbers, merged by union at any
level or date range, without reading the facts again. A bitmap has 4 kB (mostly
zeros, which files compress), so the grain should be one that many rows share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import cut_lineage
from .ordered import ordered_scan


def dense_numbers(df: DataFrame, column: str) -> DataFrame:
    """``column`` and its number, from 1 without gaps: one row per value that is not NULL."""
    return ordered_scan(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], number="number")


def distinct_bitmaps(df: DataFrame, grain: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """grain, bucket and bits: which numbers of ``column`` occur in each group of ``grain``."""
    # Pairs first: a value that is frequent in a group is then one row.
    pairs = df.select(*grain, column).distinct().join(numbers, column)
    place = pairs.select(*grain, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").alias("position"))
    return place.groupBy(*grain, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def count_distinct(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Distinct values per group of ``by``, columns of the grain or expressions of them that ``bitmaps`` has."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def stored_bitmaps(df: DataFrame, grain: Sequence[str], column: str) -> DataFrame:
    """Bitmaps of ``column``, written once for any number of merges. Pass a frame that is cheap to read twice."""
    return cut_lineage(distinct_bitmaps(df, grain, column, dense_numbers(df, column)))
