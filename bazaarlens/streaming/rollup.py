"""Daily revenue per seller and category, kept up to date by increments.

An increment names the orders that changed in any way: lines that came, a
delivery, a recalled delivery, another date, a deletion. A ledger holds what each
order last contributed (day, seller, category, revenue, units). A batch computes
the present contributions of its orders from the stored tables, takes the former
ones from the ledger, and writes the difference, by day, seller and category.
The rollup is the sum of all differences, so only days that change are written,
and an order that moved or went leaves nothing behind.

A batch counts once it is marked as done; one that stopped halfway is written
again from the same former state, one that is done is not written again. Changes
made to an order after a batch read it belong to a later batch that names the
order again. Compaction writes the last contribution of every order and the sums
as a new version, which is read together with the batches after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import day
from ..plans import base
from ..sources.store import current_version, file_exists, make_file, switch_version

GRAIN = ("day", "seller_id", "category")
MEASURES = {"revenue": "decimal(25,2)", "units": "bigint"}
PLACED = "order_purchase_timestamp"


def _lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items of ``orders`` (order_id, day)."""
    return items.select("order_id", "product_id", "seller_id", "price").join(orders, "order_id")


def _daily(t, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items of ``orders``, summed per product first, then by day, seller and category."""
    per_product = (
        _lines(items, orders).groupBy("day", "seller_id", "product_id")
        .agg(F.sum("price").alias("revenue"), F.count("*").alias("units"))
    )
    return _summed(per_product.join(base.categories(t), "product_id"))


def _contributions(t, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items of ``orders``, summed per order, day, seller and category.

    An order seldom has a product twice, so its lines are summed once, after they
    got their category. They are dealt by order, as the caller joins them by order.
    """
    return (
        _lines(items, orders).join(base.categories(t), "product_id")
        .select("order_id", *GRAIN, "price").repartition("order_id")
        .groupBy("order_id", *GRAIN)
        .agg(F.sum("price").cast(MEASURES["revenue"]).alias("revenue"), F.count("*").alias("units"))
    )


def _placed(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", day(PLACED).alias("day"))


def partial_rollup(t, items: DataFrame) -> DataFrame:
    """Aggregate delivered line items to the grain of the rollup."""
    return _daily(t, items, _placed(base.delivered_orders(t)))


def _schema(t, *names: str) -> T.StructType:
    """The named columns of a batch; the type of the ids is that of the tables."""
    ids = {c: t.order_items.schema[c].dataType.simpleString() for c in ("order_id", "seller_id")}
    types = {**ids, "day": "date", "category": "string", "batch": "bigint", **MEASURES}
    return T.StructType.fromDDL(", ".join(f"{n} {types[n]}" for n in names))


LEDGER = ("order_id", *GRAIN, *MEASURES)
CHANGES = (*GRAIN, *MEASURES)


def _done(folder: str, batch: int) -> str:
    return f"{folder}/done/batch={batch}"


def _read(t, folder: str, part: str, columns: tuple[str, ...], before: int | None = None, root: str | None = None) -> DataFrame:
    """Rows of the done batches, with their batch: the compacted state first, then what came after it.

    ``before`` leaves that batch and later ones out.
    """
    schema = _schema(t, *columns, "batch")
    upto, frame = -1, t.spark.createDataFrame([], schema)
    if root and file_exists(t.spark, f"{root}/CURRENT"):
        version = current_version(t.spark, root)
        upto = _last_batch(version)
        frame = t.spark.read.schema(schema).parquet(f"{version}/{part}")
    if not file_exists(t.spark, f"{folder}/{part}"):
        return frame
    names = _batches(t.spark, folder, upto, before)
    if not names:
        return frame
    stored = t.spark.read.schema(schema).option("basePath", f"{folder}/{part}").parquet(*[f"{folder}/{part}/{n}" for n in names])
    return stored if upto < 0 else frame.unionByName(stored)


def _last_batch(version: str) -> int:
    return int(version.rstrip("/").split("/")[-1].split("-")[1])


def _batches(spark: SparkSession, folder: str, after: int, before: int | None = None) -> list[str]:
    """Folder names of the done batches after ``after`` and before ``before``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/done")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    numbers = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path))
    return [f"batch={n}" for n in numbers if n > after and (before is None or n < before)]


def _last_contributions(ledger: DataFrame) -> DataFrame:
    """The rows of the last batch that named each order, in one pass over the ledger."""
    last = F.max("batch").over(W.partitionBy("order_id"))
    return ledger.withColumn("_last", last).filter(F.col("order_id").isNotNull() & (F.col("batch") == F.col("_last"))).drop("_last")


def write_batch(t, changed: DataFrame, folder: str, batch: int, root: str | None = None) -> None:
    """Bring the rollup up to date with the changed orders (order_id), as batch ``batch``.

    With ``root``, former contributions are also taken from the compacted version.
    """
    spark = t.spark
    if file_exists(spark, _done(folder, batch)):
        return
    path = f"{folder}/named/batch={batch}"
    named_type = t.order_items.schema["order_id"].dataType
    changed.select(F.col("order_id").cast(named_type).alias("order_id")).distinct().write.mode("overwrite").parquet(path)
    named = spark.read.schema(_schema(t, "order_id")).parquet(path)

    orders = _placed(base.delivered_orders(t)).join(named, "order_id", "left_semi")
    present = _contributions(t, t.order_items, orders)
    # An order that contributes nothing (any more) has one row without a day.
    path = f"{folder}/ledger/batch={batch}"
    named.join(present, "order_id", "left").select(*LEDGER).write.mode("overwrite").parquet(path)
    present = spark.read.schema(_schema(t, *LEDGER)).parquet(path)

    former = _read(t, folder, "ledger", LEDGER, before=batch, root=root).join(named, "order_id", "left_semi")
    former = _last_contributions(former).select(*CHANGES).withColumns({m: -F.col(m) for m in MEASURES})
    changes = _summed(present.select(*CHANGES).unionByName(former).filter("day is not null"))
    changes.filter("revenue <> 0 or units <> 0").write.mode("overwrite").parquet(f"{folder}/changes/batch={batch}")
    make_file(spark, _done(folder, batch))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*GRAIN).agg(*[F.sum(m).cast(kind).alias(m) for m, kind in MEASURES.items()])


def start_rollup(tables: Callable[[], object], changed: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Follow a stream of changed orders (order_id); ``tables`` opens the current tables."""

    def on_batch(frame: DataFrame, batch: int) -> None:
        write_batch(tables(), frame, folder, batch)

    return (
        changed.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_rollup(t, folder: str, root: str | None = None) -> DataFrame:
    """The present sums; days, sellers and categories without units are not listed."""
    return _summed(_read(t, folder, "changes", CHANGES, root=root)).filter("units <> 0")


def compact(t, folder: str, root: str) -> str:
    """Write the present state, compacted batches included, as a new version under ``root``.

    The batches it holds are not read again and may be removed from ``folder``.
    """
    spark = t.spark
    former = _last_batch(current_version(spark, root)) if file_exists(spark, f"{root}/CURRENT") else -1
    upto = max([former, *(int(n.split("=")[1]) for n in _batches(spark, folder, former))])
    version = f"version-{max(upto, 0)}-{uuid.uuid4().hex}"
    ledger = _last_contributions(_read(t, folder, "ledger", LEDGER, before=upto + 1, root=root)).filter("day is not null")
    ledger.select(*LEDGER).write.parquet(f"{root}/{version}/ledger/batch={upto}")
    sums = _summed(_read(t, folder, "changes", CHANGES, before=upto + 1, root=root)).filter("units <> 0")
    sums.write.parquet(f"{root}/{version}/changes/batch={upto}")
    return switch_version(spark, root, version)


def read_compacted(t, folder: str, root: str) -> DataFrame:
    """The compacted sums, and the changes of later batches in ``folder``."""
    return read_rollup(t, folder, root)
