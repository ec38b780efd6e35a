"""Differences between two stored versions of a table, without comparing all rows.

A version is stored in ranges of the key's hash, one folder each, beside a tree of
fingerprints: per range, and per block of ranges, the number of rows and the sum of
their hashes. Two versions are compared from the top: equal blocks are left alone,
of unequal ones the ranges are compared, and only unequal ranges are read again and
compared row by row. Hashes have 64 bits, twice with other seeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGES = 256
BLOCK = 16  # ranges of a block
PRINTS = "block int, range int, rows long, first decimal(38,0), second decimal(38,0)"


def _row_hashes(df: DataFrame) -> list:
    # A NULL is not skipped: which columns are NULL is part of the hash.
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    return [F.xxhash64(F.lit(seed), nulls, *df.columns).cast("decimal(38,0)") for seed in ("first", "second")]


def write_version(df: DataFrame, key: Sequence[str], path: str, ranges: int = RANGES) -> None:
    """Store ``df`` under ``path`` in ranges of its key, with its fingerprints.

    The rebalance hint splits a large range into several files.
    """
    placed = df.withColumn("_range", F.pmod(F.xxhash64(*key), F.lit(ranges)).cast("int"))
    placed.hint("rebalance", F.col("_range")).write.partitionBy("_range").parquet(f"{path}/rows")
    first, second = _row_hashes(df)
    stored = read_version(df.sparkSession, path, df.schema)
    (stored.groupBy(F.floor(F.col("_range") / BLOCK).cast("int").alias("block"), F.col("_range").alias("range"))
     .agg(F.count("*").alias("rows"), F.sum(first).cast("decimal(38,0)").alias("first"), F.sum(second).cast("decimal(38,0)").alias("second"))
     .coalesce(1).write.parquet(f"{path}/prints"))


def read_version(spark: SparkSession, path: str, schema) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return spark.read.schema(f"{fields}, _range int").parquet(f"{path}/rows")


def _unequal(old: DataFrame, new: DataFrame, by: str) -> list[int]:
    """Values of ``by`` whose fingerprints differ; a missing one counts as empty."""
    total = lambda df, side: df.groupBy(by).agg(*[F.sum(c).alias(f"{c}_{side}") for c in ("rows", "first", "second")])
    both = total(old, "a").join(total(new, "b"), by, "full")
    same = F.lit(True)
    for c in ("rows", "first", "second"):
        same = same & F.coalesce(f"{c}_a", F.lit(0)).eqNullSafe(F.coalesce(f"{c}_b", F.lit(0)))
    return [r[by] for r in both.filter(~same).collect()]


def changed_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """Ranges that differ, from the fingerprints alone: at most RANGES numbers."""
    a, b = (spark.read.schema(PRINTS).parquet(f"{path}/prints") for path in (old, new))
    blocks = _unequal(a, b, "block")
    return sorted(_unequal(a.filter(F.col("block").isin(blocks)), b.filter(F.col("block").isin(blocks)), "range")) if blocks else []


def difference(spark: SparkSession, old: str, new: str, schema, key: Sequence[str]) -> DataFrame:
    """The key and ``change`` (inserted, removed or changed) of every row that differs; the key is unique in a version."""
    ranges = changed_ranges(spark, old, new)
    sides = []
    for path, side in ((old, "old"), (new, "new")):
        rows = read_version(spark, path, schema).filter(F.col("_range").isin(ranges) if ranges else F.lit(False))
        first, second = _row_hashes(rows.drop("_range"))
        sides.append(rows.select(*key, F.struct(first.alias("f"), second.alias("s")).alias(side)))
    both = sides[0].join(sides[1], list(key), "full")
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.select(*key, change.alias("change")).filter(F.col("change").isNotNull())
