"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches of ascending id. A batch's distinct line keys are
merge-joined with the runs: a key that a run knows belongs to an earlier
document; an unknown one belongs to its smallest id within the batch, and goes
into a new run. When a level has ``FAN_IN`` runs they are merged into one run of
the next level. Runs are tables bucketed and sorted by the hash, so that a
batch is shuffled to the runs and the runs stay where they are. At the end every
line whose key belongs to another document is dropped.

A key is the line without BLANKS at both ends, A-Z lower-cased; keys under
``MIN_CHARS`` code points are never dropped. Keys are compared by 128-bit
hashes. Null and empty texts are one empty line. Rows with the same id are one
document: they keep the same lines. A row without an id takes no part and keeps
all its lines. Other columns are carried along unread.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.durable import scratch_path
from .common import BLANKS, doc_texts, stored

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    bare = F.trim(line, F.lit(BLANKS))
    # lower() and A-Z agree on ASCII, where it is faster.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class Runs:
    """Levelled sorted runs of (h1, h2, owner); every hash is in one run only."""

    def __init__(self, spark, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[str]] = []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.made: list[str] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.made.append(name)
        (df.select(*HASH, "owner").repartition(self.buckets, *HASH).sortWithinPartitions(*HASH)
         .write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", scratch_path(self.spark, name)).saveAsTable(name))
        return name

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, df: DataFrame) -> None:
        """A new run on level 0; full levels are merged upwards."""
        level, run = 0, self._write(df)
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fan_in:
                return
            merged = self.spark.table(self.levels[level][0])
            for name in self.levels[level][1:]:
                merged = merged.union(self.spark.table(name))
            run, self.levels[level] = self._write(merged), []
            level += 1

    def owners(self, fresh: DataFrame) -> DataFrame:
        """``fresh`` with the earlier owner of each hash as ``first``, null where no run has it."""
        for i, run in enumerate(self.tables()):
            fresh = fresh.join(run.withColumnRenamed("owner", f"first{i}"), HASH, "left")
        firsts = [c for c in fresh.columns if c.startswith("first")]
        found = F.coalesce(*firsts) if len(firsts) > 1 else F.col(firsts[0]) if firsts else F.lit(None)
        return fresh.select(*HASH, "owner", "several", found.cast("long").alias("first"))

    def drop(self) -> None:
        """Forget the catalog entries."""
        for name in self.made:
            self.spark.sql(f"drop table if exists {name}")


def owned_keys(lines: DataFrame, batches: int, fan_in: int = FAN_IN) -> DataFrame:
    """(batch, h1, h2, owner) of the keys that some document other than their owner also holds."""
    runs, decided = Runs(lines.sparkSession, fan_in), []
    try:
        for b in range(batches):
            fresh = lines.filter(F.col("batch") == b).groupBy(*HASH).agg(
                F.min("doc_id").alias("owner"), (F.min("doc_id") < F.max("doc_id")).alias("several"))
            joined = stored(runs.owners(fresh), "line-batch")
            if b + 1 < batches:
                runs.add(joined.filter("first is null"))
            decided.append(joined.filter("first is not null or several").select(
                F.lit(b).alias("batch"), *HASH, F.coalesce("first", "owner").alias("owner")))
    finally:
        runs.drop()
    out = decided[0]
    for d in decided[1:]:
        out = out.union(d)
    return out


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """``row``, ``doc_id``, ``n_lines``, ``n_dropped`` and ``kept`` (the remaining text) of every row."""
    texts = doc_texts(docs).withColumn("text_hash", F.xxhash64("text"))
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 10_000).alias("c")).first()["c"] or []
    batch = sum([(F.col("doc_id") > c).cast("int") for c in cuts], F.lit(0))
    key = line_key(F.col("line"))
    lines = stored(
        texts.filter("doc_id is not null")
        .select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", key.alias("key"))
        .filter(F.char_length("key") >= MIN_CHARS)
        .select(batch.alias("batch"), "doc_id", "text_hash", "pos",
                F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), F.col("key")).alias("h2")),
        "lines")
    owned = owned_keys(lines, batches, fan_in)
    drops = (
        lines.join(owned, ["batch", *HASH]).filter("doc_id <> owner")
        .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    )
    df = texts.join(drops, ["doc_id", "text_hash"], "left").select(
        "row", "doc_id", "text", F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    # What lies between two dropped lines stays.
    df = df.withColumn("edges", F.concat(F.array(F.lit(-1)), "gone", F.array(F.size("lines"))))
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("edges") - 1),
        lambda j: F.slice("lines", F.get("edges", j - 1) + 2, F.get("edges", j) - F.get("edges", j - 1) - 1))
    return df.select(
        "row", "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(F.flatten(pieces), "\n")).alias("kept"))


def without_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The rows of ``docs``, all columns, with the remaining text and its length."""
    out = dedup_lines(docs, batches)
    row = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return out.select(row.alias("row")).select("row.*")
