"""Near-duplicates: consistent weighted sampling over TF-IDF word shingles.

1. Document frequencies of shingles are counted over all documents, in a fixed
   number of bins. A shingle weighs its count in the text times
   ``1 + ln(N / df) / ln(N)``.
2. Documents with the same words form one node. Each node gets BANDS x ROWS
   samples of the improved consistent weighted sampling (Ioffe 2010): a sample
   of two texts is equal with the probability of their weighted Jaccard
   similarity. ROWS samples make a band key; equal keys make candidates.
3. In each bucket of equal keys all nodes are compared with one of them, the
   pivot, by the exact weighted Jaccard similarity of their whole texts; those
   in other classes also with a second pivot. Similar nodes are linked, and
   connected links give classes.
4. Nodes still in another class than the second pivot of a bucket are compared
   with all nodes of such buckets that share one of their rarest shingles, of
   those that make up one minus the threshold of their weight, and have enough
   weight left from there on. Similar nodes must do so (prefix filter). So every pair of candidates is compared,
   proven dissimilar, or in one class already, and no bucket is listed as all
   pairs.

Rows that share an id are one document; if their texts differ, copies of any of
them count, near copies only of the smallest one. Texts without a word, null ones too, are
copies of each other; each row without an id stands alone, its class is null. Shorter texts than a shingle are one shingle.
Other columns are carried along unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, stored
from .components import connected
from .shingles import mix, prefix_hashes, span_hashes, word_shingles

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 14, 5
DF_BITS = 18
DF_BINS = 1 << DF_BITS
DF_BLOCK = 1 << 12
SLACK = 1e-6  # of a weight, for sums in floating point
CHUNK = 2048  # shingles sampled at once

_rng = np.random.Generator(np.random.Philox(11))
_SEEDS = _rng.integers(1, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
# The random variables of the sampling scheme, drawn once; 16 bits of a hash choose an entry.
_GAMMA = _rng.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_LOG_C = np.log(_rng.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
_BETA = _rng.random(1 << 16, dtype=np.float32)
_LOW = np.uint64(0xFFFF)
_SECOND = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)


def df_bin(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)


def idf_table(df: np.ndarray, n_docs: int) -> np.ndarray:
    """Weight per bin, between 1 and 2: sums of it stay comparable when a group of copies is large."""
    return (1.0 + np.log((n_docs + 1.0) / (np.minimum(df, n_docs) + 1.0)) / np.log(n_docs + 2.0)).astype(np.float32)


def weighted(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in order, and their TF-IDF weights."""
    distinct, tf = np.unique(hashes, return_counts=True)
    return distinct, tf.astype(np.float32) * idf[df_bin(distinct)]


def band_keys(distinct: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """BANDS keys of 64 bits; an empty text has none."""
    if not len(distinct):
        return np.zeros(0, np.uint64)
    best = np.full(BANDS * ROWS, np.inf, np.float32)
    sample = np.zeros(BANDS * ROWS, np.uint64)
    rows = np.arange(BANDS * ROWS)
    log_w = np.log(weights)
    for at in range(0, len(distinct), CHUNK):
        h = distinct[at:at + CHUNK]
        x = mix(h[None, :] ^ _SEEDS)
        r = _GAMMA[(x & _LOW).astype(np.int32)]
        beta = _BETA[(x >> np.uint64(16) & _LOW).astype(np.int32)]
        t = np.floor(log_w[None, at:at + CHUNK] / r + beta)
        a = _LOG_C[(x >> np.uint64(32) & _LOW).astype(np.int32)] - r * (t - beta + 1)
        k = np.argmin(a, axis=1)
        least, step = a[rows, k], t[rows, k].astype(np.int64).astype(np.uint64)
        better = least < best
        best[better] = least[better]
        sample[better] = mix(h[k] + step * np.uint64(0x9E3779B97F4A7C15))[better]
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in sample.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return keys


def similarity(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two lists of shingles (with repeats)."""
    (x, wx), (y, wy) = weighted(a, idf), weighted(b, idf)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = float(np.minimum(wx[i], wy[j]).sum(dtype=float))
    total = float(wx.sum(dtype=float)) + float(wy.sum(dtype=float)) - common
    return common / total if total else 0.0


def _count_bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df, n = np.zeros(DF_BINS, np.int64), 0
    for pdf in batches:
        n += len(pdf)
        for text in pdf["text"]:
            df[np.unique(df_bin(word_shingles(text, SHINGLE)))] += 1
    blocks = df.reshape(-1, DF_BLOCK)
    yield pd.DataFrame({"block": range(-1, len(blocks)), "counts": [np.array([n]).tobytes(), *(b.tobytes() for b in blocks)]})


def _sum_block(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "counts": [total.tobytes()]})


def frequencies(docs: DataFrame) -> np.ndarray:
    """The IDF table; its size does not depend on the corpus."""
    parts = doc_texts(docs).select("text").mapInPandas(_count_bins, "block int, counts binary")
    found = {r["block"]: np.frombuffer(bytes(r["counts"]), np.int64) for r in
             parts.groupBy("block").applyInPandas(_sum_block, "block int, counts binary").collect()}
    if not found:
        return idf_table(np.zeros(DF_BINS, np.int64), 0)
    return idf_table(np.concatenate([found[b] for b in range(DF_BINS // DF_BLOCK)]), int(found[-1][0]))


def signatures(docs: DataFrame, idf) -> DataFrame:
    """doc_id, word hash (h1, h2) and band keys of every row; ``idf`` is a broadcast variable."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h1, h2, keys = [], [], []
            for text in pdf["text"]:
                data = np.frombuffer(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"), np.uint8)
                ends = np.array([len(data)])
                for out, sums in ((h1, prefix_hashes(data)), (h2, prefix_hashes(data, _SECOND))):
                    out.append(int(span_hashes(sums, ends * 0, ends).view(np.int64)[0]))
                keys.append(band_keys(*weighted(word_shingles(text, SHINGLE), idf.value)).view(np.int64))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "h1": h1, "h2": h2, "keys": keys})

    texts = doc_texts(docs).filter("doc_id is not null").select("doc_id", "text")
    return texts.mapInPandas(run, "doc_id long, h1 long, h2 long, keys array<long>")


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"node": pdf["node"], "shingles": [np.sort(word_shingles(t, SHINGLE)).tobytes() for t in pdf["text"]]})


def _prefixes(idf, threshold: float):
    """The rarest shingles of a node, up to one minus the threshold of its weight.

    For each also the weight of the node's rarer shingles and its whole weight.
    Two nodes that reach the threshold share one of them: what is left weighs
    less than the threshold asks to be common.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [[], [], [], []]
            for node, data in zip(pdf["node"], pdf["shingles"]):
                distinct, weights = weighted(np.frombuffer(data, np.uint64), idf.value)
                order = np.lexsort((distinct, -idf.value[df_bin(distinct)]))
                before = np.cumsum(weights[order], dtype=float)
                total = before[-1] if len(before) else 0.0
                before = np.concatenate([[0.0], before[:-1]])
                n = int(np.searchsorted(before, (1 - threshold + SLACK) * total, "right")) if total else 0
                for column, values in zip(out, (np.full(n, node), distinct[order[:n]].view(np.int64), before[:n], np.full(n, total))):
                    column.append(values)
            yield pd.DataFrame(dict(zip(("node", "shingle", "before", "total"), map(np.concatenate, out))))

    return run


def compare(pairs: DataFrame, features: DataFrame, idf) -> DataFrame:
    """``pairs`` (a, b) with their ``similarity``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sims = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), idf.value)
                    for x, y in zip(pdf["left"], pdf["right"])]
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "similarity": sims})

    left = features.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = features.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(right, "b").join(left, "a").mapInPandas(run, "a long, b long, similarity double")


def _outside(buckets: DataFrame, second: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, node, second) of the nodes in a bucket whose class is not that of the second pivot."""
    of_second = second.join(classes.withColumnRenamed("node", "second"), "second", "left").select(
        "key", "second", F.coalesce("class_id", "second").alias("second_class"))
    placed = buckets.select("key", "node").join(classes, "node", "left").select(
        "key", "node", F.coalesce("class_id", "node").alias("class_id"))
    return placed.join(of_second, "key").filter("class_id <> second_class").select("key", "node", "second")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) of every row: the smallest id that it is linked with, over any number of links."""
    context = docs.sparkSession.sparkContext
    idf = context.broadcast(frequencies(docs))
    signed = stored(signatures(docs, idf), "signatures")

    # Nodes: documents with the same words, under their smallest id.
    nodes = stored(signed.groupBy("h1", "h2").agg(F.min("doc_id").alias("node")), "nodes")
    members = stored(
        signed.join(nodes, ["h1", "h2"]).select(
            "doc_id", "node",
            F.when(F.col("doc_id") == F.col("node"), F.col("keys")).alias("keys")),
        "members")
    same_id = members.groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("others"))
    same_id = same_id.filter(F.size("others") > 1).select("a", F.explode("others").alias("b")).filter("a <> b")

    # Buckets of two nodes or more, each with its pivot.
    keyed = stored(members.select(F.explode("keys").alias("key"), "node").distinct(), "keyed")
    pivots = stored(
        keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .filter("pivot < last").select("key", "pivot"), "pivots")
    buckets = stored(keyed.join(pivots, "key"), "buckets")

    wanted = buckets.select("node").distinct()
    features = stored(
        doc_texts(docs).select(F.col("doc_id").alias("node"), "text").join(wanted, "node")
        .groupBy("node").agg(F.min("text").alias("text"))
        .mapInPandas(_features, "node long, shingles binary"), "features")

    star = buckets.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    compared = stored(compare(star, features, idf), "compared")
    links = stored(compared.filter(F.col("similarity") >= threshold).select("a", "b").union(same_id), "links")
    classes = connected(links)

    # A second pivot: the node nearest to the first one, which in a group of edited
    # copies is a little edited one.
    distances = buckets.filter("node <> pivot").join(
        compared.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "similarity"), ["pivot", "node"])
    second = stored(distances.groupBy("key").agg(F.max_by("node", F.struct("similarity", -F.col("node"))).alias("second")), "second")
    outside = stored(_outside(buckets, second, classes), "outside")
    star = outside.select(F.least("node", "second").alias("a"), F.greatest("node", "second").alias("b")).distinct()
    near = stored(compare(star, features, idf).filter(F.col("similarity") >= threshold).select("a", "b"), "near")
    links = stored(links.union(near), "links")
    classes = connected(links)

    # What is still outside is compared with whatever shares a shingle of its prefix.
    outside = stored(_outside(buckets, second, classes), "outside")
    crowd = buckets.join(outside.select("key").distinct(), "key", "left_semi").select("node").distinct()
    prefixes = stored(
        features.join(crowd, "node", "left_semi").mapInPandas(_prefixes(idf, threshold), "node long, shingle long, before double, total double")
        .join(classes, "node", "left").select("node", "shingle", "before", "total", F.coalesce("class_id", "node").alias("class_id")), "prefixes")
    few = prefixes.join(outside.select("node").distinct(), "node", "left_semi").select(
        "shingle", *[F.col(c).alias(f"o_{c}") for c in ("node", "before", "total", "class_id")])
    # At the first shingle that both share, what follows must weigh enough to be common.
    left_over = F.least(F.col("total") - F.col("before"), F.col("o_total") - F.col("o_before"))
    needed = (threshold / (1 + threshold) - SLACK) * (F.col("total") + F.col("o_total"))
    rest = few.join(prefixes, "shingle").filter((F.col("o_class_id") != F.col("class_id")) & (left_over >= needed)).select(
        F.least("o_node", "node").alias("a"), F.greatest("o_node", "node").alias("b")).distinct()
    late = stored(compare(rest, features, idf).filter(F.col("similarity") >= threshold).select("a", "b"), "late")
    if not late.isEmpty():
        classes = connected(links.union(late))

    found = members.select("doc_id", "node").join(classes, "node", "left").select(
        "doc_id", F.coalesce("class_id", "node").alias("class_id"))
    alone = doc_texts(docs).filter("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return found.union(alone)


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, of the smallest id of every class."""
    gone = near_classes(docs, threshold).filter("class_id <> doc_id").select("doc_id").distinct()
    return doc_texts(docs).join(gone, "doc_id", "left_anti").select("row.*")
