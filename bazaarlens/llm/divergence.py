"""Audit of how sources differ within a language, by a recount over perfect hashes.

1. Exact frequencies: the documents that hold a term, per language, pre-aggregated
   per task. Terms in fewer than ``min_docs`` documents of the language go.
2. The kept terms of a language are cut into shards by hash; each shard becomes a
   minimal perfect hash in a task of its own, with its terms in slot order.
3. The second pass reads the texts again, ordered by group within each partition.
   Only one group is open at a time: its slots are one dense array, in which a term
   is counted once its hash is verified against the stored term.
4. Each shard's counts of all groups meet as one dense matrix, from which the
   divergences are summed, in integers.

The hashes are broadcast up to BROADCAST_BYTES of terms, the most frequent ones
first. Beyond it, the rarer terms are counted per task and group, and joined with
the slots that their shards gave them; the results are the same.

Probabilities are in billionths with add-one counts, rounded down. A divergence
of p from q is the sum of (p - q)^2 / q, each rounded down.

Null texts, languages and sources are empty ones; empty texts have no term, but
their groups occur. Each row is a document, repeated rows and rows without an id
included. Very long texts are read whole. Ties are ranked by the item's bytes.
A language without kept terms has divergences of 0 and no terms. Other columns
are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import perfect_hash
from .common import stored
from .words import LETTERS, byte_texts, byte_words

MIN_DOCS = 3
TOP_TERMS = 200
SHARD_TERMS = 4096
# Terms that are broadcast: their bytes, and 16 bytes each for offsets and bits.
BROADCAST_BYTES = 64 << 20
TERM_BYTES = 16
HELD_TERMS = 1 << 19  # counted terms that a task holds before it hands them on
CELLS = 1 << 20  # of the matrix of pairs computed at once
BILLION = 1_000_000_000

SHARD = ["lang", "hot", "shard"]


def group_texts(docs: DataFrame) -> DataFrame:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return byte_texts(docs, name("lang"), name("source")).select("lang", "source", "data")


def _document_counts(batches):
    """Documents per language and term of this task, in several rows where there are many."""
    held: dict[str, Counter] = {}
    room = HELD_TERMS

    def flush():
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "term", "n"])
        held.clear()

    for batch in batches:
        for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist()):
            own = held.setdefault(lang, Counter())
            room += len(own)
            own.update(set(byte_words(data, LETTERS)))
            room -= len(own)
            if room <= 0:
                yield from flush()
                room = HELD_TERMS
    yield from flush()


def kept_terms(texts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term (bytes) and n, its number of documents, where that is ``min_docs`` or more."""
    return texts.select("lang", "data").mapInArrow(_document_counts, "lang string, term binary, n long") \
        .groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)


def hot_from(kept: DataFrame, limit: int) -> int:
    """The least number of documents (a power of two) of a term that is broadcast."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = kept.groupBy(level.alias("level")).agg(
        F.sum(F.octet_length("term") + TERM_BYTES).alias("bytes")).orderBy(F.desc("level")).collect()
    least, used = 1 << 62, 0
    for r in sizes:  # at most 63 levels
        used += r["bytes"]
        if used > limit:
            break
        least = 1 << r["level"]
    return least


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    terms = sorted(rows["term"])
    sizes, bits, number = perfect_hash.build(terms)
    ordered: list = [None] * len(terms)
    for term, at in zip(terms, number.tolist()):
        ordered[at] = term
    one = {c: [rows[c].iloc[0]] for c in [*SHARD, "shards"]}
    return pd.DataFrame({**one, "sizes": [sizes], "bits": [bits], "terms": [ordered]})


def shards_of(kept: DataFrame, limit: int = BROADCAST_BYTES, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard: lang, hot, shard, their number, level sizes, bits, and the terms in slot order."""
    terms = kept.withColumn("hot", F.col("n") >= hot_from(kept, limit))
    sizes = stored(terms.groupBy("lang", "hot").agg(F.count("*").alias("terms")), "language-sizes")
    count = F.ceil(F.col("terms") / shard_terms).cast("int")
    return stored(
        terms.join(sizes, ["lang", "hot"])
        .select("lang", "hot", "term", F.pmod(F.xxhash64("term"), count).cast("int").alias("shard"), count.alias("shards"))
        .groupBy(*SHARD).applyInPandas(
            _build_shard, "lang string, hot boolean, shard int, shards int, sizes array<int>, bits binary, terms array<binary>"),
        "shards")


class Recount:
    """The second pass over one partition, whose rows are ordered by group."""

    def __init__(self, hashes, some_cold: bool):
        self.hashes, self.some_cold = hashes, some_cold
        self.dense = np.zeros(0, np.int64)

    def open(self, group) -> None:
        self.group, self.hash = group, self.hashes.get(group[0])
        self.cold, self.touched = Counter(), []
        if self.hash is not None and len(self.dense) < len(self.hash):
            self.dense = np.zeros(len(self.hash), np.int64)

    def add(self, counts: Counter) -> None:
        terms, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        number = self.hash.numbers(terms) if self.hash is not None else np.full(len(terms), -1)
        known = number >= 0
        self.dense[number[known]] += n[known]
        self.touched.append(number[known])
        if self.some_cold:
            for i in np.flatnonzero(~known).tolist():
                self.cold[terms[i]] += int(n[i])

    def rows(self):
        """What was counted since the group was opened; the slots are zero again."""
        at = np.unique(np.concatenate([np.zeros(0, np.int64), *self.touched]))
        if len(at):
            shard, slot = self.hash.shard_and_slot(at)
            yield self._batch(shard, slot, self.dense[at], [None] * len(at))
            self.dense[at] = 0
        if self.cold:
            none = [None] * len(self.cold)
            yield self._batch(none, none, list(self.cold.values()), list(self.cold))
        self.cold, self.touched = Counter(), []

    def _batch(self, shard, slot, n, terms):
        lang, source = (pa.array([x] * len(n), pa.string()) for x in self.group)
        return pa.RecordBatch.from_arrays(
            [lang, source, pa.array(shard, pa.int32()), pa.array(slot, pa.int32()), pa.array(n, pa.int64()), pa.array(terms, pa.binary())],
            ["lang", "source", "shard", "slot", "n", "term"])


def hot_hashes(shards: DataFrame) -> dict[str, perfect_hash.ShardedHash]:
    """The hash of each language over its broadcast terms, whose size ``hot_from`` has bounded."""
    by_lang: dict[str, list] = {}
    columns = ["lang", "shard", "shards", "sizes", "bits", "terms"]
    found = shards.filter("hot").select(*columns).toArrow().combine_chunks()
    lists = found.column("terms").combine_chunks()
    for i, (lang, shard, n, sizes, bits) in enumerate(zip(*(found.column(c).to_pylist() for c in columns[:-1]))):
        # A shard that no term fell into stays empty.
        by_lang.setdefault(lang, [([], b"", [])] * n)[shard] = (sizes, bits, lists[i].values)
    return {lang: perfect_hash.ShardedHash(own) for lang, own in by_lang.items()}


def recount(texts: DataFrame, shards: DataFrame) -> DataFrame:
    """lang, source, hot, shard, slot and n (occurrences) of every kept term of every group that holds it."""
    context = texts.sparkSession.sparkContext
    some_cold = not shards.filter("not hot").isEmpty()
    sent = context.broadcast(hot_hashes(shards))

    def count(batches):
        state = Recount(sent.value, some_cold)
        group, counts = None, Counter()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source", "data"))
            for lang, source, data in zip(*columns):
                if (lang, source) != group:
                    if group is not None:
                        state.add(counts)
                        yield from state.rows()
                    group, counts = (lang, source), Counter()
                    state.open(group)
                counts.update(byte_words(data, LETTERS))
                if len(counts) >= HELD_TERMS:
                    state.add(counts)
                    counts = Counter()
                    if len(state.cold) >= HELD_TERMS:
                        yield from state.rows()
        if group is not None:
            state.add(counts)
            yield from state.rows()

    found = texts.sortWithinPartitions("lang", "source").mapInArrow(
        count, "lang string, source string, shard int, slot int, n long, term binary")
    if some_cold:
        found = stored(found, "recounted")
        slots = shards.filter("not hot").select("lang", "shard", F.posexplode("terms").alias("slot", "term"))
        cold = found.filter("term is not null").groupBy("lang", "source", "term").agg(F.sum("n").alias("n")) \
            .join(slots, ["lang", "term"]).select("lang", "source", F.lit(False).alias("hot"), "shard", "slot", "n")
        found = found.filter("term is null")
    found = found.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n")) \
        .select("lang", "source", F.lit(True).alias("hot"), "shard", "slot", "n")
    return stored(found.unionByName(cold) if some_cold else found, "counts")


def billionths(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total), exact for counts of any size."""
    if counts.max(initial=0) >= (1 << 63) // BILLION - 1:
        return (1 + (counts.astype(object) + 1) * BILLION // total.astype(object)).astype(np.int64)
    return 1 + (counts + 1) * BILLION // total


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(p - q)^2 / q, rounded down; both are at most 10^9 + 1."""
    return (p - q) ** 2 // q


def _shard_results(top: int):
    def run(counts: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        own = shard.iloc[0]
        lang, groups, terms = own["lang"], list(own["groups"]), list(own["terms"])
        sources, totals = [g["source"] for g in groups], np.array([g["n"] for g in groups], np.int64)
        at = {s: i for i, s in enumerate(sources)}
        matrix = np.zeros((len(sources), len(terms)), np.int64)
        matrix[counts["source"].map(at).to_numpy(), counts["slot"].to_numpy()] = counts["n"].to_numpy()
        p = billionths(matrix, totals[:, None] + own["vocabulary"])
        out = []
        step = max(1, CELLS // max(1, len(terms)))
        for i, source in enumerate(sources):
            for j in range(0, len(sources), step):
                sums = distances(p[i], p[j:j + step]).sum(axis=1)
                out += [("pair", source, s, int(v)) for s, v in zip(sources[j:j + step], sums) if s != source]
        q = billionths(matrix.sum(axis=0), np.array(totals.sum() + own["vocabulary"]))
        order = np.argsort(np.array(terms, dtype=object), kind="stable")
        by_bytes = np.empty(len(terms), np.int64)
        by_bytes[order] = np.arange(len(terms))
        for i, source in enumerate(sources):
            found = np.flatnonzero((matrix[i] > 0) & (p[i] > q))
            value = distances(p[i][found], q[found])
            best = np.lexsort((by_bytes[found], -value))[:top]
            out += [("term", source, terms[k].decode("utf-8", "replace"), int(v)) for k, v in zip(found[best].tolist(), value[best])]
        frame = pd.DataFrame(out, columns=["part", "source", "item", "value"])
        frame.insert(0, "lang", lang)
        return frame

    return run


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """lang, source, part, item, value and rank: per group its divergence from the other sources, and its leading terms."""
    texts = group_texts(docs)
    kept = stored(kept_terms(texts, min_docs), "kept-terms")
    shards = shards_of(kept, limit, SHARD_TERMS)
    counts = recount(texts, shards)
    groups = stored(
        texts.select("lang", "source").distinct()
        .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "groups")
    # As many entries per language as it has sources; the result has their square.
    per_lang = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
    vocabulary = shards.groupBy("lang").agg(F.sum(F.size("terms")).cast("long").alias("vocabulary"))
    languages = stored(per_lang.join(vocabulary, "lang", "left"), "languages")
    whole = shards.select(*SHARD, "terms").join(languages.filter("vocabulary is not null"), "lang")
    found = stored(
        counts.groupBy(*SHARD).cogroup(whole.groupBy(*SHARD))
        .applyInPandas(_shard_results(top), "lang string, part string, source string, item string, value long"), "divergences")
    sources = F.col("groups.source")
    empty = languages.filter("vocabulary is null").select("lang", sources.alias("others"), F.explode(sources).alias("source")) \
        .select("lang", "source", F.explode("others").alias("item")).filter("item <> source") \
        .select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(empty)
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = found.filter("part = 'term'").select("lang", "source", "item", "value").withColumn("rank", rank).filter(F.col("rank") <= top)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return columns(pairs.withColumn("rank", rank), "pair").unionByName(columns(terms, "term"))
