"""Importance resampling towards a target distribution.

Features are runs of consecutive words, hashed into buckets. The bucket counts of
the corpus and of the target give each bucket a gain, a log ratio with add-one
counts; a document weighs the sum of its features' gains. A pseudo-random Gumbel
number, fixed by the id, is added to the weight: the documents with the highest
sums are a draw without replacement in proportion to their weights. They are
found by ``regular_sort``, which gives exact ranks.

Weights are looked up in an array of one gain per bucket (80 kB), the only thing
the driver hands out. Words are those of ``words.ALPHANUMERIC``.

Null and empty texts have no feature, weigh 0 and are not drawn, as all documents
under ``min_words`` words. Very long texts are read whole. A row without an id
gets the number of an empty id and comes last among ties. Repeated rows are
documents of their own: each is counted, and each has a rank; rows with equal
score and id are ranked next to each other. An empty target or corpus leaves all
counts zero. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .regular_sort import first_ranks
from .words import ALPHANUMERIC, Remembered, byte_texts, byte_words, runs

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Occurrences per bucket over all rows of ``texts`` (a column ``text``)."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        bucket = Remembered(lambda w: crc32(w) % buckets)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                found = Counter(runs(byte_words(data, ALPHANUMERIC), longest))
                at = np.fromiter(map(bucket.__getitem__, found), np.int64, len(found))
                total += np.bincount(at, np.fromiter(found.values(), np.int64, len(found)), buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    data = texts.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"))
    rows = data.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of each bucket, rounded down."""
    buckets, all_corpus, all_target = len(corpus), float(corpus.sum()), float(target.sum())
    return [
        floor(1000 * log((t + 1.0) * (all_corpus + buckets) / ((s + 1.0) * (all_target + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())]


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel number that the id fixes, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""
    buckets = len(gain)

    def score(batches):
        worth = Remembered(lambda w: gain[crc32(w) % buckets])
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()):
                words = byte_words(data, ALPHANUMERIC)
                features = words if longest == 1 else list(runs(words, longest))
                weight = sum(map(worth.__getitem__, features))
                rows.append((len(words), len(features), weight, weight + gumbel(doc_id, seed)))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_features", "weight", "score"])

    return byte_texts(docs).mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null where not drawn) of every row.

    ``percent`` of the rows with at least ``min_words`` words are drawn, rounded down.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    out = stored(scored(docs, gain, longest, seed), "scored")
    fit = F.col("n_words") >= min_words
    eligible = out.filter(fit).count()
    # Longs without nulls, ascending: high scores first, rows without an id last.
    keys = {"_k0": -F.col("score"), "_k1": F.col("doc_id").isNull().cast("long"), "_k2": F.coalesce("doc_id", F.lit(0)),
            "_k3": F.col("n_features"), "_k4": F.col("weight")}
    ranked = first_ranks(out.filter(fit).withColumns(keys), list(keys), percent * eligible // 100, eligible).drop(*keys)
    return ranked.unionByName(out.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
