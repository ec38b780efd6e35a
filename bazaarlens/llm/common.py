"""What the operators of this folder share: reading tables and durable intermediates."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from ..sources.durable import scratch_path

# White space of the contracts: blank, and the control characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application."""
    context = spark.sparkContext
    if getattr(context, "_sent_bazaarlens", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="bazaarlens-source-"), "bazaarlens_source.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(top):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    context._sent_bazaarlens = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and continue from the files.

    Readers take only the columns they need, and a lost executor costs nothing
    that was computed before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long), ``text`` (null becomes empty), and the whole row as ``row``.

    Other columns, whatever their names, are only found inside ``row``, which is
    pruned where nothing reads it.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )


def words(text: Column) -> Column:
    """The maximal runs of characters other than BLANKS."""
    return F.filter(F.split(text, BLANK_RUN, -1), lambda w: w != "")
