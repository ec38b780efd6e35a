"""Exact token counts for every context limit, from one histogram of encoded lengths.

Documents are encoded and only their lengths are shuffled, pre-aggregated. For
each length that occurs the table answers, by suffix sums: how many documents
are longer, how many tokens all documents hold, how many are left when each is
truncated there, and which share of documents fits. Any other limit, and any
quantile, follows from the row at or below it (``totals_at``, ``quantile``).

Null and empty texts have length 0. Repeated rows and rows without an id count
each. An empty table gives an empty histogram. Other columns are not read.
"""

from __future__ import annotations

import base64
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import doc_texts, stored

RANKS = "byte_bpe_50k.tiktoken"
BLOCK = 128  # lengths per block of the suffix sums


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def encoder(path: str):
    """One encoder per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every row."""
    path = path or ranks_path()

    def run(batches):
        own = encoder(path)
        for batch in batches:
            n = [len(own.encode_ordinary(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])

    return doc_texts(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def length_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per occurring length: the answers for a context limit of that length."""
    histogram = stored(lengths(docs, path).groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    return answers(histogram)


def answers(histogram: DataFrame) -> DataFrame:
    """Suffix sums over (n_tokens, n_docs), block by block."""
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    # One row per BLOCK lengths; the longest document bounds their number.
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(W.partitionBy()).alias("all_docs"), F.sum("t").over(W.partitionBy()).alias("all_tokens"))
    longer = W.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(W.unboundedPreceding, -1)
    sums = h.select(
        "block", "n_tokens", "n_docs",
        F.coalesce(F.sum("n_docs").over(longer), F.lit(0)).alias("docs_longer"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_longer"))
    docs_over = F.col("docs_longer") + F.col("docs_after")
    tokens_over = F.col("tokens_longer") + F.col("tokens_after")
    return sums.join(blocks, "block").select(
        F.col("n_tokens").alias("context_limit"),
        "n_docs",
        docs_over.alias("docs_over"),
        (F.col("all_docs") - docs_over).alias("docs_fitting"),
        F.col("all_tokens").alias("tokens_total"),
        (F.col("all_tokens") - tokens_over + docs_over * F.col("n_tokens")).alias("tokens_truncated"),
        (tokens_over - docs_over * F.col("n_tokens")).alias("tokens_lost"),
        F.round((F.col("all_docs") - docs_over) / F.col("all_docs"), 9).alias("quantile"))


def totals_at(table: DataFrame, limit: int) -> DataFrame:
    """Documents fitting and tokens kept at any limit, occurring or not."""
    # Between two occurring lengths both change linearly with the limit.
    low = table.filter(F.col("context_limit") <= limit).orderBy(F.desc("context_limit")).limit(1)
    found = low.select(
        F.lit(limit).cast("long").alias("context_limit"), "docs_fitting", "docs_over",
        (F.col("tokens_truncated") + F.col("docs_over") * (limit - F.col("context_limit"))).alias("tokens_truncated"))
    # Below the shortest length every document is cut to the limit.
    none = table.agg(F.max(F.col("docs_fitting") + F.col("docs_over")).alias("n"), F.min("context_limit").alias("least"))
    none = none.filter(F.col("least") > F.lit(limit)).select(
        F.lit(limit).cast("long").alias("context_limit"), F.lit(0).cast("long").alias("docs_fitting"),
        F.col("n").alias("docs_over"), (F.col("n") * limit).alias("tokens_truncated"))
    return found.union(none)


def quantile(table: DataFrame, q: float) -> DataFrame:
    """The smallest length that at least the share ``q`` of the documents does not exceed."""
    return table.filter(F.col("docs_fitting") >= F.ceil(q * (F.col("docs_fitting") + F.col("docs_over")))).agg(
        F.min("context_limit").alias("length"))
