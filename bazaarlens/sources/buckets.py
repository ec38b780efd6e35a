"""Facts of one order kept together: orders and their children bucketed and sorted by order id.

Joins, aggregations and reference checks by order id then need no exchange. A
bucket is read by one task, which nothing splits, so a table is bucketed only if
its buckets are even: their sizes are counted before anything is written. A table
with a hot order stays as it is, and joins with it are shuffled, so that adaptive
execution splits the hot order.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import scratch_path

FACTS = ("orders", "order_items", "order_payments", "order_reviews")
KEY = "order_id"
# Rows of the largest bucket, in rows of an average one, up to which buckets are even.
EVEN = 3.0


def largest_bucket(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the largest bucket over those of an average one (0 without rows)."""
    # hash() is what buckets are dealt by; at most one row per bucket and task is shuffled.
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n"))
    r = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return r["most"] * buckets / r["all"] if r["all"] else 0.0


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str) -> str:
    """Save ``df`` as a bucketed, sorted table, and return the table's name."""
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).sortWithinPartitions(key)
     .write.bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(df.sparkSession, table)).saveAsTable(table))
    return table


class BucketedTables:
    """The tables ``t``, with the facts of an order bucketed where their buckets are even.

    ``close`` gives up the catalog entries; the files stay.
    """

    def __init__(self, t, buckets: int | None = None):
        self._base, self.spark = t, t.spark
        self.buckets = buckets or int(t.spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables: dict[str, str] = {}
        self._facts: dict[str, DataFrame] = {}
        for name in FACTS:
            df = t.by_name(name)
            even = largest_bucket(df, KEY, self.buckets) <= EVEN
            if even:
                self.tables[name] = write_bucketed(df, KEY, self.buckets, name)
            self._facts[name] = self.spark.table(self.tables[name]) if even else df

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return self._facts[name] if name in self._facts else getattr(self._base, name)

    def by_name(self, name: str) -> DataFrame:
        return self._facts[name] if name in self._facts else self._base.by_name(name)

    @property
    def delivered_orders(self) -> DataFrame:
        if "orders" not in self.tables:
            return self._base.delivered_orders
        return self._facts["orders"].filter(F.col("order_status") == "delivered")

    def references(self) -> Mapping[str, DataFrame]:
        return {name: self.by_name(name) for name in ("customers", "sellers", "products", *FACTS)}

    def close(self) -> None:
        for table in self.tables.values():
            self.spark.sql(f"drop table if exists {table}")
