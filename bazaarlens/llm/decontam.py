"""Benchmark decontamination: rare n-gram seeds joined to items, then Smith-Waterman alignment.

1. The pairs of neighbouring words of a benchmark item, and those with one word
   between, are its possible seeds. One pass over the documents counts those that
   hold each pair.
2. Of each item the rarest pairs become seeds: so many that no alignment of the
   threshold avoids them all. ``best_without`` proves that, as the best score of
   an alignment that avoids a set of pairs, so an edited copy is not lost
   wherever its edits fall.
3. A second pass finds the seeds in the documents; the hits are joined with the
   items by seed. Around a hit the words that an alignment of the threshold can
   reach form a window (MISMATCH and GAP bound the inserted words), and
   overlapping windows of an item are joined.
4. A window is left out if too few of the item's words occur in it for the
   threshold, were all of them in order.
5. The item is aligned with each window by Smith-Waterman over words. The score
   divided by that of a perfect match is the similarity; a document with
   THRESHOLD or more leaks the item.

Words are runs of letters and digits, lower-cased, and are compared by a 63-bit
hash. Both passes skip pairs by a Bloom filter of the benchmark's pairs, of MOST_BITS
at most; what it lets through in vain is dropped by the join. Documents are read
twice whatever the size of the benchmark, and only words near a hit are shuffled.

Items without a word match nothing; those of up to WHOLE_WORDS words (or so few that
one word reaches the threshold) are found only whole. Repeated items count once; an
item without an id is reported with a null id unless one with an id has the same
text. Null and empty texts leak nothing. Repeated rows and rows without an id are
reported each. Of equal alignments the first is reported. Very long texts are
searched whole. Other columns are carried along unread.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, stored

MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
WHOLE_WORDS = 3
MOST_BITS = 1 << 28
BITS_PER_PAIR = 128
PROBES = (0, 18, 36)  # shifts of a code, one bit of the bitmap each
BLOCK = 1 << 16  # bits
WINDOWS_AT_ONCE = 256
CHARACTERS_AT_ONCE = 1 << 18
POWER = 0x9E3779B97F4A7C15  # odd
ROWS_PER_TASK = 50_000
SLACK = 1e-9
WORD, NO_WORD = re.compile(r"[^\W_]+"), re.compile(r"[\W_]")
RESULT = "doc_id long, row_key long, item_id long, similarity double, start_word int, end_word int"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


@cache
def _letters() -> np.ndarray:
    """A 64-bit number for each code point that words consist of, 0 for the others; one table per Python worker."""
    code = np.arange(sys.maxunicode + 1, dtype=np.uint64) + np.uint64(1)
    code = (code ^ (code >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    code = (code ^ (code >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    code = (code ^ (code >> np.uint64(31))) | np.uint64(1)
    return code * np.fromiter((chr(c).isalnum() for c in range(sys.maxunicode + 1)), np.uint64, len(code))


@cache
def _powers(factor: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, factor, np.uint64)])


def _hashed(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and hash (positive, 63 bits) of the words of a lower-cased text.

    The numbers of a word's letters are summed with a power each; running sums over the
    text give those of all words at once.
    """
    letters = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    inside = np.zeros(len(letters) + 2, np.int8)
    inside[1:-1] = letters != 0
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    n = 1 << len(text).bit_length()
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * _powers(POWER, n)[: len(letters)], out=sums[1:])
    code = (sums[end] - sums[start]) * _powers(pow(POWER, -1, 1 << 64), n)[start]
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return start, np.maximum(code >> np.uint64(1), np.uint64(1)).view(np.int64)


def numbers_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, one after the other, and where each text begins and ends."""
    texts = [(t or "").lower() for t in texts]
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    whole, at, starts, codes = "\n".join(texts), 0, [], []
    while at < len(whole):
        cut = NO_WORD.search(whole, at + CHARACTERS_AT_ONCE)
        until = cut.start() if cut else len(whole)
        start, code = _hashed(whole[at:until])
        starts.append(start + at)
        codes.append(code)
        at = max(until, at + 1)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(len(firsts), np.int64)
    return np.concatenate(codes), np.searchsorted(np.concatenate(starts), firsts)


def numbers(text: str | None) -> np.ndarray:
    return numbers_of([text])[0]


def pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit number for each pair of words."""
    code = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)
    code = (code ^ (code >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (code ^ (code >> np.uint64(32))).view(np.int64)


def pairs_at(ids: np.ndarray, singles: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, place of the first word and span of all pairs; span 0 is a word by itself."""
    codes, places, spans = [], [], []
    for span in (0, 1, 2) if singles else (1, 2):
        n = max(len(ids) - span, 0)
        codes.append(pair_codes(ids[:n], ids[span:] if span else np.zeros(n, np.int64)))
        places.append(np.arange(n))
        spans.append(np.full(n, span))
    return np.concatenate(codes), np.concatenate(places), np.concatenate(spans)


def is_whole(length: int, threshold: float) -> bool:
    """Whether an item of so many words counts only if all of it is found."""
    return length <= WHOLE_WORDS or threshold * length <= 1 + SLACK


def room(length, threshold: float):
    """Words that an alignment of the threshold can have besides the item's: each one costs a GAP."""
    return (MATCH * length * max(1 - threshold, 0) / -GAP + SLACK).astype(np.int64)


def best_without(length: int, adjacent: np.ndarray, skipping: np.ndarray) -> int:
    """Best score of an alignment with an item that holds none of the marked pairs.

    ``adjacent[i]`` marks the words i and i + 1, ``skipping[i]`` i and i + 2. Matches
    that follow each other with a unmatched words of the item and b of the text
    between them cost max(a, b) at least; a and b of at most one make a pair.
    """
    best = [MATCH] * length
    far = 0
    for j in range(1, length):
        reach = best[j - 1] - (2 if adjacent[j - 1] else 0)
        if j >= 2:
            reach = max(reach, best[j - 2] - (2 if skipping[j - 2] else 1))
        if j >= 3:
            far = max(far - 1, best[j - 3] - 2)
            reach = max(reach, far)
        best[j] = MATCH + max(reach, 0)
    return max(best)


def choose(length: int, places: np.ndarray, spans: np.ndarray, codes: np.ndarray, weights: np.ndarray, threshold: float) -> np.ndarray:
    """Marks the places of the pairs that become seeds: the lightest, as many as the threshold needs."""
    order = np.lexsort((codes, weights))
    rank = np.zeros(len(codes), np.int64)
    rank[order] = np.cumsum(np.r_[False, codes[order][1:] != codes[order][:-1]])
    if is_whole(length, threshold):
        usable = spans == min(length - 1, 1)
        return usable & (rank == rank[usable].min())

    def enough(n: int) -> bool:
        used = {s: np.zeros(length, bool) for s in (1, 2)}
        for s, mark in used.items():
            mark[places[(spans == s) & (rank < n)]] = True
        return best_without(length, used[1], used[2]) < (threshold - SLACK) * MATCH * length

    low, high = 1, int(rank.max()) + 1
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle + 1, high)
    return rank < low


def align(item: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of ``item`` with each text, and the word at which it ends."""
    width = max(len(t) for t in texts)
    table = np.full((len(texts), width), -1, np.int64)
    for row, t in zip(table, texts):
        row[: len(t)] = t
    ramp = -GAP * np.arange(width)
    above = np.zeros((len(texts), width), np.int64)
    best, where = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for word in item:
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        h = np.maximum(np.maximum(diagonal + np.where(table == word, MATCH, MISMATCH), above + GAP), 0)
        # A run of gaps along the row costs its length: a running maximum over the slope.
        h = np.maximum.accumulate(h + ramp, axis=1) - ramp
        top = h.argmax(axis=1)
        score = h[np.arange(len(texts)), top]
        better = score > best
        best[better], where[better] = score[better], top[better]
        above = h
    return best, where


def _items(benchmark: DataFrame) -> DataFrame:
    """item_key, ids and words of the distinct texts that have a word."""
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    # Without nulls, so that a null id is left only where no item with an id has the text.
    texts = texts.dropna(subset=["text"]).groupBy("text").agg(F.collect_set("item_id").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["item_key", "ids"]].assign(item=[numbers(t) for t in pdf["text"]])

    texts = texts.select(F.xxhash64("text").alias("item_key"), "ids", "text")
    return texts.mapInPandas(run, "item_key long, ids array<long>, item array<long>").filter(F.size("item") > 0)


def _pairs(items: DataFrame) -> DataFrame:
    """item_key, length, place, span and pair of all possible seeds; a word itself only of an item of one word."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, item in zip(pdf["item_key"], pdf["item"]):
                pair, place, span = pairs_at(np.asarray(item, np.int64), len(item) == 1)
                yield pd.DataFrame({"item_key": key, "length": len(item), "place": place, "span": span, "pair": pair})

    return items.select("item_key", "item").mapInPandas(run, "item_key long, length int, place int, span int, pair long")


def _bitmap(pairs: DataFrame, most_bits: int) -> np.ndarray:
    """A Bloom filter of the pairs: a power of two of bits, most_bits at most."""
    n, bits = pairs.count(), BLOCK
    while bits < min(n * BITS_PER_PAIR, most_bits):
        bits *= 2
    bits = min(bits, most_bits)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blocks = []
            for held in pdf["held"]:
                block = np.zeros(BLOCK, np.uint8)
                block[np.asarray(held, np.int64)] = 1
                blocks.append(np.packbits(block).tobytes())
            yield pd.DataFrame({"block": pdf["block"], "bits": blocks})

    probes = F.explode(F.array(*[F.shiftrightunsigned("pair", p).bitwiseAND(F.lit(bits - 1)) for p in PROBES]))
    bit = F.col("bit")
    rows = pairs.select(probes.alias("bit")).select(F.shiftright(bit, BLOCK.bit_length() - 1).alias("block"), bit.bitwiseAND(F.lit(BLOCK - 1)).alias("bit"))
    rows = rows.groupBy("block").agg(F.collect_set("bit").alias("held")).mapInPandas(run, "block long, bits binary").collect()
    size = max(bits, BLOCK) // 8
    bitmap = np.zeros(size, np.uint8)
    for r in rows:
        at = r["block"] * (BLOCK // 8)
        bitmap[at:at + BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return bitmap[: max(bits // 8, 1)]


def _in_bitmap(bitmap: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions of the codes whose bits are all set."""
    at, mask = np.arange(len(codes)), np.uint64(len(bitmap) * 8 - 1)
    for p in PROBES:
        bit = ((codes[at].view(np.uint64) >> np.uint64(p)) & mask).view(np.int64)
        at = at[np.bitwise_and(bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8), 1) == 1]
    return at


def _found(texts: list[str], bitmap: np.ndarray, singles: bool) -> Iterator[tuple]:
    """Texts in chunks of about CHARACTERS_AT_ONCE: first text, words one after the other, where each text
    begins, and of the pairs in the bitmap the code, the place and the text."""
    first, n = 0, 0
    for k, text in enumerate(texts):
        n += len(text)
        if n < CHARACTERS_AT_ONCE and k < len(texts) - 1:
            continue
        ids, edges = numbers_of(texts[first:k + 1])
        parts = []
        for span in (0, 1, 2) if singles else (1, 2):
            size = max(len(ids) - span, 0)
            codes = pair_codes(ids[:size], ids[span:] if span else np.zeros(size, np.int64))
            at = _in_bitmap(bitmap, codes)
            owner = np.searchsorted(edges, at, "right") - 1
            own = at + span < edges[owner + 1]
            parts.append((codes[at[own]], at[own], owner[own]))
        yield first, ids, edges, *(np.concatenate(p) for p in zip(*parts))
        first, n = k + 1, 0


def _frequencies(texts: DataFrame, shared, singles: bool) -> DataFrame:
    """Documents that hold each pair of the bitmap, added up in each batch first."""

    def run(batches):
        for batch in batches:
            for _, _, _, codes, _, owner in _found(batch.column("text").to_pylist(), shared.value, singles):
                order = np.lexsort((owner, codes))
                codes, owner = codes[order], owner[order]
                new = np.r_[True, (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])][: len(codes)]
                pair, n = np.unique(codes[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    return texts.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def seeds(pairs: DataFrame, texts: DataFrame, threshold: float, singles: bool, most_bits: int) -> DataFrame:
    """pair, item_key, place and length of the seeds that some document holds."""
    held = pairs.groupBy("pair").agg(F.count_distinct("item_key").alias("items"))
    shared = texts.sparkSession.sparkContext.broadcast(_bitmap(held, most_bits))
    weights = held.join(_frequencies(texts, shared, singles), "pair", "left").select(
        "pair", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) * F.col("items")).alias("weight"))
    of_item = pairs.join(weights, "pair").groupBy("item_key", "length").agg(
        *[F.collect_list(c).alias(c) for c in ("place", "span", "pair", "weight", "n")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                place, span, pair, weight, n = (np.asarray(x, np.int64) for x in (r.place, r.span, r.pair, r.weight, r.n))
                used = choose(r.length, place, span, pair, weight, threshold) & (n > 0)
                yield pd.DataFrame({"pair": pair[used], "item_key": r.item_key, "place": place[used], "length": r.length})

    return of_item.mapInPandas(run, "pair long, item_key long, place int, length int")


def _suspects(texts: DataFrame, shared, reach: int, singles: bool) -> DataFrame:
    """row_key, doc_id, words (0 beyond the reach of all hits), and the pairs and places of the hits."""

    def lists(parts: list[np.ndarray], kind) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts), kind))

    def written(rows: list[tuple]) -> pa.RecordBatch:
        key, doc_id, words, pairs, places = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(doc_id, pa.int64()), lists(words, pa.int64()), lists(pairs, pa.int64()), lists(places, pa.int32())],
            ["row_key", "doc_id", "words", "pairs", "places"])

    def run(batches):
        for batch in batches:
            keys, doc_ids = batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist()
            for first, ids, edges, codes, places, owner in _found(batch.column("text").to_pylist(), shared.value, singles):
                order = np.argsort(owner, kind="stable")
                codes, places, owner = codes[order], places[order], owner[order]
                rows = []
                for k, a, b in zip(*np.unique(owner, return_index=True), [*np.flatnonzero(np.diff(owner)) + 1, len(owner)]):
                    own, at = ids[edges[k]:edges[k + 1]], places[a:b] - edges[k]
                    near = np.zeros(len(own) + 1, np.int64)
                    np.add.at(near, np.maximum(at - reach, 0), 1)
                    np.add.at(near, np.minimum(at + reach, len(own)), -1)
                    rows.append((keys[first + k], doc_ids[first + k], np.where(np.cumsum(near)[:-1] > 0, own, 0), codes[a:b], at.astype(np.int32)))
                if rows:
                    yield written(rows)

    return texts.mapInArrow(run, "row_key long, doc_id long, words array<long>, pairs array<long>, places array<int>")


def _windows(hits: DataFrame, threshold: float) -> DataFrame:
    """row_key, item_key and the joined windows (first word, number of words) around the hits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spare = room(pdf["length"].to_numpy(), threshold)
            starts, sizes = [], []
            for found, length, more in zip(pdf["found"], pdf["length"], spare):
                at = np.sort(np.asarray(found, np.int64))
                first, last = np.maximum(at - more, 0), at + length + more
                new = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
                starts.append(first[new])
                sizes.append(last[np.r_[new[1:], len(at)] - 1] - first[new])
            yield pd.DataFrame({"row_key": pdf["row_key"], "item_key": pdf["item_key"], "starts": starts, "sizes": sizes})

    grouped = hits.groupBy("row_key", "item_key").agg(F.first("length").alias("length"), F.collect_set("start").alias("found"))
    return grouped.mapInPandas(run, "row_key long, item_key long, starts array<int>, sizes array<int>")


def _aligned(candidates: DataFrame, threshold: float) -> DataFrame:
    """The candidates whose best window reaches the threshold."""

    def scored(pdf: pd.DataFrame) -> pd.DataFrame:
        work: dict[int, list[tuple]] = {}
        for row, (key, item, starts, parts) in enumerate(zip(pdf["item_key"], pdf["item"], pdf["starts"], pdf["parts"])):
            least = 1.0 if is_whole(len(item), threshold) else threshold
            for start, part in zip(starts, parts):
                if np.isin(item, part).sum() >= least * len(item) - SLACK:
                    work.setdefault(key, []).append((len(part), row, int(start), np.asarray(part, np.int64)))
        best: dict[int, tuple] = {}
        for found in work.values():
            found.sort(key=lambda x: x[:3])
            words = np.asarray(pdf["item"].iat[found[0][1]], np.int64)
            least = 1.0 if is_whole(len(words), threshold) else threshold
            for k in range(0, len(found), WINDOWS_AT_ONCE):
                group = found[k:k + WINDOWS_AT_ONCE]
                scores, ends = align(words, [g[3] for g in group])
                for (_, row, start, part), score, end in zip(group, scores, ends):
                    similarity = score / (MATCH * len(words))
                    last = best.get(row)
                    if similarity >= least - SLACK and (last is None or (similarity, -start) > (last[0], -last[1])):
                        # The same alignment backwards ends where this one begins.
                        _, back = align(words[::-1], [part[: end + 1][::-1]])
                        best[row] = similarity, start, start + int(end) - int(back[0]), start + int(end) + 1
        rows = pdf.iloc[list(best)][["doc_id", "row_key", "ids"]]
        return rows.assign(similarity=[round(float(b[0]), 6) for b in best.values()],
                           start_word=[b[2] for b in best.values()], end_word=[b[3] for b in best.values()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield scored(pdf)

    return candidates.mapInPandas(run, "doc_id long, row_key long, ids array<long>, similarity double, start_word int, end_word int")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, row_key, item_id, similarity, and the words [start_word, end_word) that match, per document and item."""
    spark = docs.sparkSession
    texts = doc_texts(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    items = stored(_items(benchmark), "items")
    longest, shortest = items.agg(F.max(F.size("item")), F.min(F.size("item"))).first()
    if longest is None:
        return spark.createDataFrame([], RESULT)
    singles = shortest == 1
    used = stored(seeds(stored(_pairs(items), "pairs"), texts, threshold, singles, most_bits), "seeds")
    shared = spark.sparkContext.broadcast(_bitmap(used.select("pair").distinct(), most_bits))
    reach = longest + int(room(np.array(longest), threshold))
    suspects = stored(_suspects(texts, shared, reach, singles), "suspects")
    hits = suspects.select("row_key", F.explode(F.arrays_zip("pairs", "places")).alias("hit")).select(
        "row_key", F.col("hit.pairs").alias("pair"), F.col("hit.places").alias("at"))
    hits = hits.join(used, "pair").select("row_key", "item_key", "length", (F.col("at") - F.col("place")).alias("start"))
    windows = stored(_windows(hits, threshold), "windows")
    parts = F.transform(F.arrays_zip("starts", "sizes"), lambda s: F.slice("words", s["starts"] + 1, s["sizes"]))
    candidates = suspects.select("row_key", "doc_id", "words").join(windows, "row_key").select(
        "row_key", "doc_id", "item_key", "starts", parts.alias("parts")).join(items, "item_key")
    # A stated number of tasks: few bytes may hold much work.
    tasks = max(spark.sparkContext.defaultParallelism, -(-windows.count() // ROWS_PER_TASK))
    found = _aligned(candidates.repartition(tasks, "row_key", "item_key"), threshold)
    return found.select("doc_id", "row_key", F.explode_outer("ids").alias("item_id"), "similarity", "start_word", "end_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    gone = stored(leaks(docs, benchmark, threshold).select("row_key").distinct(), "leaks")
    rows = doc_texts(docs).withColumn("row_key", F.xxhash64("doc_id", "text"))
    return rows.join(gone, "row_key", "left_anti").select("row.*")
