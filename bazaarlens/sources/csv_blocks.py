"""Parallel reading of CSV files whose quoted fields hold line breaks.

A line break ends a record only outside quotes, and whether a block of a file
starts inside quotes depends on all quotes before it. So the quotes are counted
first: one number per block, summed up along each file. Then every task knows how
its block begins and cuts its lines into records. A record that crosses into the
next block is left over as fragments, at most two per block; only these are
shuffled and joined. There are as many tasks as blocks, and no file is read by
one task. The files are read twice: for the counts, and to be cut; records and
fragments are then taken from what was cut.

A quote inside a quoted field is doubled, so that each quote flips the state.
A single quote within an unquoted field is malformed: it fails the load by an odd
number of quotes in the file or by records that do not have the header's fields.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .durable import cut_lineage

COMPLETE, OPENS, GOES_ON, CLOSES = range(4)
PARSING = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (first byte of the piece that a task reads) and the lines, in order within a block."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def block_states(lines: DataFrame) -> DataFrame:
    """One row per block: file, block, whether it starts inside quotes, and whether it ends there."""
    quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    upto = F.sum("quotes").over(W.partitionBy("file").orderBy("block"))
    return counts.select(
        "file", "block", ((upto - F.col("quotes")) % 2 == 1).alias("starts_inside"), (upto % 2 == 1).alias("ends_inside"),
        (F.row_number().over(W.partitionBy("file").orderBy(F.desc("block"))) == 1).alias("is_last"))


def _cut(inside):
    """Records and fragments of each block; ``inside`` holds the blocks that start inside quotes."""

    def run(batches):
        now, open_lines, within, is_head, is_first = None, [], False, False, False

        def left_over():
            if open_lines:
                yield (*now, GOES_ON if is_head else OPENS, is_first, "\n".join(open_lines))

        for batch in batches:
            rows = []
            for key, file, block, line in zip(*(batch.column(c).to_pylist() for c in ("key", "file", "block", "line"))):
                if (file, block) != now:
                    rows += left_over()
                    now, open_lines = (file, block), []
                    within = is_head = (key, block) in inside.value
                    is_first = block == 0
                open_lines.append(line)
                within ^= line.count('"') % 2 == 1
                if not within:
                    rows.append((file, block, CLOSES if is_head else COMPLETE, is_first, "\n".join(open_lines)))
                    open_lines, is_head, is_first = [], False, False
            yield _batch(rows)
        yield _batch(list(left_over()))

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 5
    types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "block", "kind", "is_first", "text"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """text of every record, and whether it is the first of its file."""
    lines = read_lines(spark, path)
    # One row per block of the input comes to the driver.
    states = block_states(lines).filter("starts_inside or (is_last and ends_inside)").select(
        F.xxhash64("file").alias("key"), "file", "block", "starts_inside", "is_last", "ends_inside").collect()
    for r in states:
        if r["is_last"] and r["ends_inside"]:
            raise ValueError(f"{r['file']}: a quoted field does not end")
    inside = spark.sparkContext.broadcast({(r["key"], r["block"]) for r in states if r["starts_inside"]})
    cut = cut_lineage(lines.select(F.xxhash64("file").alias("key"), "file", "block", "line").mapInArrow(
        _cut(inside), "file string, block long, kind int, is_first boolean, text string"))
    complete = cut.filter(F.col("kind") == COMPLETE).select("text", "is_first")
    # At most two fragments per block; a record begins with the one that opens it.
    # Within a block the closing fragment comes before the opening one.
    along = W.partitionBy("file").orderBy("block", (F.col("kind") == OPENS))
    joined = (
        cut.filter(F.col("kind") != COMPLETE)
        .withColumn("record", F.sum((F.col("kind") == OPENS).cast("int")).over(along))
        .groupBy("file", "record")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("text"),
             F.max("is_first").alias("is_first")))
    return complete.unionByName(joined.select("text", "is_first"))


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All records as strings under ``columns``, the names in the header of every file.

    A file with another header, or a record with more or fewer fields, fails the read.
    """
    schema = ", ".join(f"_c{i} string" for i in range(len(columns)))
    # The end of a Windows line, and the byte order mark, belong to no field.
    text = F.regexp_replace("text", "\\r$", "")
    text = F.when(F.col("is_first"), F.regexp_replace(text, "^﻿", "")).otherwise(text)
    records = read_records(spark, path).select("is_first", text.alias("text")).filter("is_first or text <> ''")
    parsed = records.select("is_first", "text", F.from_csv("text", schema, PARSING).alias("r"))
    names = F.array(*[F.lit(c) for c in columns])
    found = F.array(*[F.col(f"r._c{i}") for i in range(len(columns))])
    # The check and the choice are one condition, so that neither runs without the other.
    is_record = F.when(~F.col("is_first"), F.lit(True)).when(found == names, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit(f"the header is not {columns}: "), "text")).cast("boolean"))
    return parsed.filter(is_record).select(*[F.col(f"r._c{i}").alias(c) for i, c in enumerate(columns)])
