"""Joins of many rows to one row per key, when one key may own most of the rows.

Spark splits a skewed partition only when both sides of the join come straight
from a shuffle. A side that was aggregated by the join key does not, so a hot
key is handled here: the aggregate itself tells how many rows every key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import cut_lineage

# Rows of one value per key that may be broadcast: some tens of megabytes.
SMALL_ROWS = 500_000


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; the right keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_right_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    same = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        same = term if same is None else same & term
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def join_per_key(
    df: DataFrame, per_key: DataFrame, by: Sequence[str], rows: str, small: int = SMALL_ROWS
) -> DataFrame:
    """Add the columns of ``per_key`` to the rows of ``df`` that have its key.

    ``per_key`` is unique in ``by``, and ``rows`` holds the number of rows of
    ``df`` per key; that column is not added. Counted to be small, ``per_key``
    is broadcast. Otherwise the keys that would overfill a shuffle partition
    (fewer than there are partitions) are broadcast, and only the rows of the
    others are shuffled. Pass a frame that is cheap to read twice.
    """
    by = list(by)
    per_key = cut_lineage(per_key)
    sizes = per_key.agg(F.count("*").alias("keys"), F.sum(rows).alias("rows")).first()
    if sizes["keys"] <= small:
        return null_safe_join(df, F.broadcast(per_key.drop(rows)), by)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(rows) * partitions >= sizes["rows"]
    hot, cold = per_key.filter(is_hot).drop(rows), per_key.filter(~is_hot).drop(rows)
    others = null_safe_join(df, F.broadcast(hot.select(*by)), by, "left_anti")
    return null_safe_join(df, F.broadcast(hot), by).unionByName(null_safe_join(others, cold, by))
