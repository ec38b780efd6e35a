"""Stored tables: versioned loads, derived tables, statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import checks, delivery
from .csv_ingest import read_text_csv, require_header, typed
from .schemas import TABLES, TableSpec
from .tables import StoredTables, centroids

FREE_TEXT = ("order_reviews",)
POINTER = "CURRENT"
WRITERS = 3  # tables written at a time, so that the last tasks of one leave no cores idle


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def file_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, as a mark."""
    _file_system(spark, path).create(_hadoop_path(spark, path), True).close()


def current_version(spark: SparkSession, root: str) -> str:
    """Folder of the version readers should use."""
    stream = _file_system(spark, root).open(_hadoop_path(spark, f"{root}/{POINTER}"))
    try:
        return f"{root}/{stream.readLine().strip()}"
    finally:
        stream.close()


def switch_version(spark: SparkSession, root: str, version: str) -> str:
    """Point readers to ``version`` with one rename; older versions stay readable."""
    fs = _file_system(spark, root)
    draft = f"{root}/.{POINTER}-{uuid.uuid4().hex}"
    stream = fs.create(_hadoop_path(spark, draft), True)
    stream.writeBytes(version)
    stream.close()
    jvm = spark._jvm
    source, target = _hadoop_path(spark, draft), _hadoop_path(spark, f"{root}/{POINTER}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        source.toUri(), spark._jsc.hadoopConfiguration()
    ) if source.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(source, target, options)
    return f"{root}/{version}"


def at_once(spark: SparkSession, work: Callable[[str], None], names: Iterable[str]) -> None:
    """``work`` for every name, ``WRITERS`` of them at a time; fails if one fails."""
    with ThreadPoolExecutor(WRITERS) as pool:
        list(pool.map(inheritable_thread_target(spark)(work), names))


def write_versions(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    verify: Callable[[Mapping[str, DataFrame]], None] | None = None,
    layouts: Mapping[str, Callable[[DataFrame, str], None]] | None = None,
    finish: Callable[[str], None] | None = None,
) -> DataFrame:
    """Write all frames under a new version, verify what was written, then switch to it.

    ``layouts`` says how a table is written to its path, if not as it comes;
    ``finish`` gets the path of the verified version and adds to it. A failure,
    also one that ``verify`` raises, leaves the current version untouched.
    Returns the rows per table, counted from what was written, and their total.
    """
    version = f"version-{uuid.uuid4().hex}"

    def write(name: str) -> None:
        layout = (layouts or {}).get(name, lambda df, at: df.write.mode("overwrite").parquet(at))
        layout(frames[name], f"{root}/{version}/{name}")

    at_once(spark, write, frames)
    written = {name: spark.read.schema(frame.schema).parquet(f"{root}/{version}/{name}") for name, frame in frames.items()}
    if verify is not None:
        verify(written)
    if finish is not None:
        finish(f"{root}/{version}")
    switch_version(spark, root, version)
    counts = None
    for name, frame in written.items():
        one = frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("row_count").alias("row_count")).select(F.lit("TOTAL").alias("table_name"), "row_count")
    return counts.unionByName(total)


def require_integrity(
    frames: Mapping[str, DataFrame], expected_rows: Mapping[str, int] | None = None, specs: Mapping[str, TableSpec] = TABLES,
) -> None:
    """Keys, references, required columns, the score range and, where given, the row counts of all tables."""
    reports = [
        checks.uniqueness(frames, {name: specs[name].key for name in frames if specs[name].key}),
        checks.references(frames),
        *[checks.null_counts(name, frame, specs[name].required) for name, frame in frames.items() if specs[name].required],
        checks.score_range(frames["order_reviews"]),
    ]
    if expected_rows:
        reports.append(checks.row_counts({name: frames[name] for name in expected_rows}, expected_rows))
    for report in reports:
        checks.require(report)


def load_tables(
    spark: SparkSession, csv_paths: Mapping[str, str], root: str, expected_rows: Mapping[str, int] | None = None,
    specs: Mapping[str, TableSpec] = TABLES,
) -> DataFrame:
    """Load the nine CSV tables, a few at a time. All headers are checked before
    anything is written, and the written tables before readers see them.

    Orders are stored by month and customers sorted by person; centroids and the
    distances of the zips that occur together are stored beside the tables.
    """
    texts = {
        name: read_text_csv(spark, csv_paths[name], name in FREE_TEXT) for name in specs
    }
    for name, df in texts.items():
        require_header(df, specs[name])

    def derive(path: str) -> None:
        t = StoredTables(spark, path, specs)
        centroids(t.geolocation).write.parquet(f"{path}/geolocation_centroid")
        delivery.pair_distances(t).write.parquet(f"{path}/zip_distances")

    return write_versions(
        spark, {name: typed(df, specs[name]) for name, df in texts.items()}, root,
        lambda frames: require_integrity(frames, expected_rows, specs),
        {"orders": lambda df, path: write_by_month(df, "order_purchase_timestamp", path),
         "customers": lambda df, path: write_sorted(df, "customer_unique_id", path)},
        derive)


def open_store(spark: SparkSession, root: str, specs: Mapping[str, TableSpec] = TABLES) -> StoredTables:
    return StoredTables(spark, current_version(spark, root), specs)


def refresh_centroids(spark: SparkSession, geolocation: DataFrame, root: str) -> DataFrame:
    """Rebuild the centroid table in a new version and switch readers to it."""
    write_versions(spark, {"geolocation_centroid": centroids(geolocation)}, root)
    return read_centroids(spark, root)


def read_centroids(spark: SparkSession, root: str) -> DataFrame:
    schema = "zip string, lat double, lng double, source_rows long"
    return spark.read.schema(schema).parquet(f"{current_version(spark, root)}/geolocation_centroid")


def analyzed_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Save ``df`` at ``path``, collect its statistics under the table name
    ``name``, and return those of every column: one row per column. The name is
    given up again, the files stay."""
    spark = df.sparkSession
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
    stats = None
    for column in df.columns:
        one = (
            spark.sql(f"DESCRIBE EXTENDED {name} {column}")
            .groupBy()
            .pivot("info_name", ["min", "max", "num_nulls"])
            .agg(F.first("info_value"))
            .select(
                F.lit(column).alias("column_name"),
                F.col("min").alias("min_value"),
                F.col("max").alias("max_value"),
                F.col("num_nulls").cast("long").alias("null_count"),
            )
        )
        stats = one if stats is None else stats.unionByName(one)
    spark.sql(f"DROP TABLE {name}")
    return stats


def write_by_month(df: DataFrame, timestamp: str, path: str) -> None:
    """Partition facts by calendar month, so date filters skip whole folders.

    The rebalance hint brings a month together and splits it again into files
    of the advisory size, however large the month is.
    """
    (
        df.withColumn("order_month", F.date_format(timestamp, "yyyy-MM"))
        .hint("rebalance", F.col("order_month"))
        .write.mode("overwrite").partitionBy("order_month").parquet(path)
    )


def write_sorted(df: DataFrame, key: str, path: str, partitions: int | None = None) -> None:
    """Range-sort files by a lookup key, so row groups outside it are skipped.

    The hash of the row is part of the range, so the rows of a hot key spread
    over several neighbouring files.
    """
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(count, F.col(key), F.xxhash64(*df.columns))
        .sortWithinPartitions(key)
        .write.mode("overwrite")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .parquet(path)
    )
