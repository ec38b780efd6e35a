"""Repeated byte strings: enhanced suffix arrays, cut into buckets by content.

Whatever is repeated for MIN_LEN bytes has the same smallest KEY_LEN-byte hash
(minimizer) among its first MIN_LEN bytes. So suffixes are dealt out by the
minimizer of their first MIN_LEN bytes:

1. A pass over the texts finds the windows: runs of neighbouring positions with
   the same minimizer. Only hashes are written. A minimizer that occurs in one
   window proves all its positions unique.
2. Windows of equal content are one segment with a number of copies. One copy of
   each segment is cut from its text: its positions and MIN_LEN - 1 bytes more.
3. Suffix arrays with LCP values are built over whole buckets of segments. A
   stack scan visits the tree of common-prefix intervals of at least MIN_LEN
   bytes; an interval whose members are preceded by different bytes cannot be
   extended to the left and is output as a repeat group with all its places. The
   first position of a segment always counts as preceded by another byte, and a
   repeat longer than a window comes as a chain of groups that overlap.
4. A bucket of more than MAX_SEGMENTS segments (a common short passage in ever
   other surroundings) is not gathered. Its positions are grouped by a 128-bit hash
   of their MIN_LEN bytes instead, pre-aggregated; a group of two is a repeat.

A document's repeated bytes are the union of the groups' places in it. Beside
them it is told how much of it lies in passages of words (``passages``), which may
be shorter than MIN_LEN bytes. Words are runs of other characters than blanks; rows
are compared with rows of another text, or with all of their copies.

Null and empty texts and those shorter than MIN_LEN have no repeat. Identical
rows are repeats of each other, with or without an id. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, stored
from .passages import RUN_WORDS, passages, run_hashes, shared_windows
from .shingles import POWERS, mix, prefix_hashes, span_hashes

MIN_LEN = 400
KEY_LEN = 100
MAX_SEGMENTS = 1024
CHUNK = 1 << 21  # positions of a text looked at together
ARRAY_BYTES = 1 << 19  # bytes of segments per suffix array
TAILS_AT_ONCE = 1 << 14
_PLACE = np.uint64((1 << 22) - 1)
_OTHER = np.random.Generator(np.random.Philox(23)).integers(1, 1 << 63, 256, dtype=np.uint64)

ROW = ["k1", "k2"]  # hashes that identify a row by id and text
SEGMENT = ["key", "h1", "h2"]
PLACE = "repeat long, length int, key long, h1 long, h2 long, pos int"


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima within blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def text_windows(data: np.ndarray, min_len: int = MIN_LEN, key_len: int = KEY_LEN):
    """start, number of positions, minimizer and two content hashes of each window of a text."""
    out = [[], [], [], [], []]
    for at in range(0, len(data) - min_len + 1, CHUNK):
        part = data[at:at + CHUNK + min_len - 1]
        sums, other = prefix_hashes(part), prefix_hashes(part, _OTHER)
        _, down = POWERS.get(len(part) + 1)
        keys = mix((sums[key_len:] - sums[:-key_len]) * down[: len(part) - key_len + 1])
        # The place fills the low bits: of equal hashes the leftmost is taken, so that
        # a window ends where its minimizer does, also in periodic text.
        least = smallest(keys & ~_PLACE | np.arange(len(keys), dtype=np.uint64), min_len - key_len + 1)
        start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        count = np.diff(np.append(start, len(least)))
        minimizer = keys[(least[start] & _PLACE).astype(np.int64)]
        end = start + count - 1 + min_len
        for column, values in zip(out, (
            start + at, count, minimizer.view(np.int64),
            span_hashes(sums, start, end).view(np.int64), span_hashes(other, start, end).view(np.int64),
        )):
            column.append(values)
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def _data(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def _find_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [text_windows(_data(t)) for t in pdf["text"]]
        n = [len(f[0]) for f in found]
        start, count, key, h1, h2 = (np.concatenate([f[i] for f in found]) for i in range(5))
        yield pd.DataFrame({
            "k1": np.repeat(pdf["k1"].to_numpy(), n), "k2": np.repeat(pdf["k2"].to_numpy(), n),
            "start": start, "count": count.astype(np.int32), "key": key, "h1": h1, "h2": h2})


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row per segment, and one per text with runs of words that may be shared."""
    for pdf in batches:
        rows = []
        for text, wanted, t, windows in zip(pdf["text"], pdf["wanted"], pdf["t"], pdf["windows"]):
            data = _data(text)
            for w in (wanted if wanted is not None else ()):
                piece = data[w["start"]: w["start"] + w["count"] - 1 + MIN_LEN].tobytes()
                rows.append((w["key"], w["h1"], w["h2"], w["copies"], piece, None, None, None))
            if windows is not None:
                rows.append((None, None, None, None, None, t, *run_hashes(text, windows)))
        columns = list(zip(*rows)) or [()] * 8
        numbers = (*SEGMENT, "copies", "t")  # as Int64 from the start: with nulls they would turn into floats
        yield pd.DataFrame({
            name: pd.array(values, "Int64") if name in numbers else pd.Series(values, dtype=object)
            for name, values in zip([*SEGMENT, "copies", "bytes", "t", "at", "run"], columns)})


class SuffixArray:
    """Suffixes of several segments in order, with the common prefix of neighbours.

    Suffixes end with their segment. Only those are kept that share their first
    ``min_len`` bytes with another one, or begin a segment with copies. They are
    ordered by those bytes (as a hash: which group comes first does not matter)
    and within a group by what follows.
    """

    def __init__(self, segments: list[bytes], copies: np.ndarray, min_len: int):
        sizes = np.array([len(s) for s in segments])
        text = np.frombuffer(b"".join(segments), np.uint8)
        ends = np.cumsum(sizes)
        counts = sizes - min_len + 1
        segment = np.repeat(np.arange(len(segments)), counts)
        pos = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = (ends - sizes)[segment] + pos
        prefix = span_hashes(prefix_hashes(text), start, start + min_len)
        _, group, members = np.unique(prefix, return_inverse=True, return_counts=True)
        kept = np.flatnonzero((members[group] > 1) | ((pos == 0) & (copies[segment] > 1)))
        start, group, segment, pos = start[kept], group[kept], segment[kept], pos[kept]
        rest = ends[segment] - start - min_len  # bytes after the prefix
        width = int(rest.max()) if len(rest) else 0
        order = np.argsort(group, kind="stable")
        if width:
            padded = np.concatenate([text, np.zeros(width, np.uint8)])
            tails = np.lib.stride_tricks.sliding_window_view(padded, width)[start + min_len]
            for at in range(0, len(tails), TAILS_AT_ONCE):
                part = tails[at:at + TAILS_AT_ONCE]
                part[np.arange(width) >= rest[at:at + TAILS_AT_ONCE, None]] = 0
            by_tail = np.argsort(tails.view(f"S{width}").ravel(), kind="stable")
            order = by_tail[np.argsort(group[by_tail], kind="stable")]
        self.segment, self.pos = segment[order], pos[order]
        self.left = rest[order] + min_len
        # Byte before each suffix; -1 at the start of a segment.
        self.before = np.where(self.pos > 0, text[start[order] - 1].astype(np.int64), -1)
        # Common prefix of each suffix with the one before it; 0 for the first of a group.
        self.lcp = np.zeros(len(order), np.int64)
        grouped = group[order]
        for at in range(1, len(order), TAILS_AT_ONCE):
            here = order[at:at + TAILS_AT_ONCE]
            there = order[at - 1:at - 1 + len(here)]
            common = np.full(len(here), min_len)
            if width:
                differs = tails[here] != tails[there]
                first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
                common = min_len + np.minimum(first, np.minimum(rest[here], rest[there]))
            self.lcp[at:at + len(here)] = np.where(grouped[at:at + len(here)] == grouped[at - 1:at - 1 + len(here)], common, 0)


def repeat_groups(array: SuffixArray, copies: np.ndarray, min_len: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) in the suffix array of every repeat that no common left byte extends."""
    n = len(array.segment)
    opens = array.before < 0
    differs = np.zeros(n, np.int64)
    differs[1:] = array.before[1:] != array.before[:-1]
    changes = np.cumsum(differs)
    starts = np.cumsum(opens)

    def diverse(first: int, last: int) -> bool:
        return changes[last] > changes[first] or starts[last] > starts[first] or opens[first]

    # A segment that occurs several times is a repeat by itself.
    for i in np.flatnonzero(opens & (copies[array.segment] > 1)):
        yield int(i), int(i), int(array.left[i])
    stack: list[tuple[int, int]] = []  # (length, first)
    relevant = np.flatnonzero(array.lcp >= min_len)
    previous = -1
    for i in relevant.tolist():
        if i != previous + 1:  # the common prefix in between was too short
            while stack:
                length, first = stack.pop()
                if diverse(first, previous):
                    yield first, previous, length
        length, first = int(array.lcp[i]), i - 1
        while stack and stack[-1][0] > length:
            deeper, first = stack.pop()
            if diverse(first, i - 1):
                yield first, i - 1, deeper
        if not stack or stack[-1][0] < length:
            stack.append((length, first))
        previous = i
    while stack:
        length, first = stack.pop()
        if diverse(first, previous):
            yield first, previous, length


def _names(pieces: list[bytes], array: SuffixArray, members: np.ndarray, lengths: np.ndarray) -> list[int]:
    """A 64-bit name of each repeated string."""
    contents = (pieces[s][p:p + n] for s, p, n in zip(array.segment[members].tolist(), array.pos[members].tolist(), lengths.tolist()))
    return [int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little", signed=True) for c in contents]


def _array_places(rows: pd.DataFrame, every_group: bool) -> pd.DataFrame:
    """All places of all repeat groups, or only those that add to what is covered of a segment."""
    pieces, copies = list(rows["bytes"]), rows["copies"].to_numpy()
    array = SuffixArray(pieces, copies, MIN_LEN)
    longest = np.zeros(len(array.segment), np.int64)
    members, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for first, last, length in repeat_groups(array, copies, MIN_LEN):
        if every_group:
            members.append(np.arange(first, last + 1))
            lengths.append(np.full(last - first + 1, length))
        else:
            own = longest[first:last + 1]
            np.maximum(own, length, out=own)
    if not every_group:
        found = np.flatnonzero(longest)
        found = found[np.lexsort((array.pos[found], array.segment[found]))]
        segment, end = array.segment[found], array.pos[found] + longest[found]
        # Ends of later segments are larger, so one running maximum serves all.
        end = end + segment * (int(array.left.max(initial=0)) * 2 + 1)
        reached = np.maximum.accumulate(np.concatenate([[-1], end[:-1]])) if len(end) else end
        found = found[end > reached]
        members, lengths = [found], [longest[found]]
    at, length = np.concatenate(members), np.concatenate(lengths)
    own = rows.iloc[array.segment[at]]
    return pd.DataFrame({
        "repeat": np.array(_names(pieces, array, at, length), np.int64), "length": length.astype(np.int32),
        **{c: own[c].to_numpy() for c in SEGMENT}, "pos": array.pos[at].astype(np.int32)})


def _arrays(batches: Iterator[pd.DataFrame], every_group: bool) -> Iterator[pd.DataFrame]:
    """Rows arrive ordered by key; arrays end where a bucket ends."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        while len(pdf):
            size = sum(int(h["bytes"].str.len().sum()) for h in held)
            full = np.flatnonzero(size + pdf["bytes"].str.len().cumsum().to_numpy() >= ARRAY_BYTES)
            if not len(full):
                held.append(pdf)
                break
            keys = pdf["key"].to_numpy()
            last = int(np.searchsorted(keys, keys[full[0]], "right"))
            if last == len(pdf):  # the bucket may go on
                held.append(pdf)
                break
            yield _array_places(pd.concat([*held, pdf.iloc[:last]]), every_group)
            held, pdf = [], pdf.iloc[last:]
    if held:
        yield _array_places(pd.concat(held), every_group)


def _positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every position of a segment with a hash of its MIN_LEN bytes."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            data = np.frombuffer(row.bytes, np.uint8)
            at = np.arange(len(data) - MIN_LEN + 1)
            g = [span_hashes(prefix_hashes(data, *t), at, at + MIN_LEN).view(np.int64) for t in ((), (_OTHER,))]
            yield pd.DataFrame({"g1": g[0], "g2": g[1], "copies": row.copies, "key": row.key, "h1": row.h1, "h2": row.h2, "pos": at.astype(np.int32)})


def _with_keys(docs: DataFrame) -> DataFrame:
    return doc_texts(docs).select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit("row"), "text", "doc_id").alias("k2"),
        F.xxhash64("text").alias("t"))


def places(docs: DataFrame, every_group: bool = False, runs_wanted: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The windows (k1, k2, start, count, key, h1, h2) that may repeat, the repeat groups' places in their segments,
    and the hashes of the word runs in the windows that ``runs_wanted`` (k1, k2, t, windows) names."""
    texts = _with_keys(docs)
    windows = stored(texts.select("text", *ROW).mapInPandas(
        _find_windows, "k1 long, k2 long, start long, count int, key long, h1 long, h2 long"), "windows")
    shared = stored(windows.groupBy("key").count().filter("count > 1").select("key"), "keys")
    windows = stored(windows.join(shared, "key", "left_semi"), "shared-windows")
    segments = stored(
        windows.groupBy(*SEGMENT).agg(
            F.count("*").alias("copies"), F.min(F.struct(*ROW, "start", "count")).alias("one"))
        .select(*SEGMENT, "copies", "one.*"), "segments")
    wanted = segments.groupBy(*ROW).agg(F.collect_list(F.struct("start", "count", *SEGMENT, "copies")).alias("wanted"))
    if runs_wanted is None:
        wanted = wanted.selectExpr("*", "cast(null as long) as t", "cast(null as array<struct<start:int,count:int>>) as windows")
    else:
        wanted = wanted.join(runs_wanted, ROW, "full").withColumn("t", F.coalesce("t", F.lit(0)))
    both = stored(
        texts.drop("t").join(wanted, ROW).select("text", "wanted", "t", "windows")
        .mapInPandas(_cut, "key long, h1 long, h2 long, copies long, bytes binary, t long, at array<int>, run array<long>"), "cut")
    cut = both.filter("key is not null").select(*SEGMENT, "copies", "bytes")
    runs = both.filter("t is not null").select("t", F.explode(F.arrays_zip("at", "run")).alias("x")).select("t", "x.at", "x.run")
    crowded = stored(cut.groupBy("key").count().filter(F.col("count") > MAX_SEGMENTS).select("key"), "crowded")

    few = cut.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    found = few.mapInPandas(partial(_arrays, every_group=every_group), PLACE)

    positions = stored(cut.join(crowded, "key", "left_semi").mapInPandas(
        _positions, "g1 long, g2 long, copies long, key long, h1 long, h2 long, pos int"), "positions")
    again = stored(positions.groupBy("g1", "g2").agg(F.sum("copies").alias("n")).filter("n > 1").select("g1", "g2"), "again")
    crowd = positions.join(again, ["g1", "g2"]).select(
        F.col("g1").alias("repeat"), F.lit(MIN_LEN).alias("length"), *SEGMENT, "pos")
    return windows, stored(found.union(crowd), "places"), runs


def groups(docs: DataFrame) -> DataFrame:
    """Repeat groups by window: repeat, length, doc_id, start (in bytes).

    Groups are not maximal over whole texts. A repeat longer than a window (at
    most 2 * MIN_LEN - KEY_LEN bytes) comes as a chain of overlapping groups that
    nothing joins, and a group may begin where a window does although all its
    places could be extended to the left. In a bucket of more than MAX_SEGMENTS
    segments each repeated position is a group of MIN_LEN bytes, so the groups
    there depend on the size of the bucket. The bytes they cover do not.
    """
    windows, found, _ = places(docs, every_group=True)
    ids = _with_keys(docs).select("doc_id", *ROW)
    return found.join(windows, SEGMENT).join(ids, ROW).select(
        "repeat", "length", "doc_id", (F.col("start") + F.col("pos")).alias("start"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of [start, end) as maximal runs."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _join_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        spans = [[x for s in merged([(p["pos"], p["pos"] + p["length"]) for p in own]) for x in s] for own in pdf["own"]]
        yield pd.DataFrame({**{c: pdf[c] for c in SEGMENT}, "spans": spans})


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        columns = ("doc_id", "text", "found", "copies", "n_passages", "n_passage_words")
        for doc_id, text, found, copies, n_passages, n_passage_words in zip(*(pdf[c] for c in columns)):
            data = text.encode("utf-8", "surrogatepass")
            spans = merged([(f["start"] + a, f["start"] + b) for f in (found if found is not None else ())
                            for a, b in zip(f["spans"][::2], f["spans"][1::2])])
            edges = [0, *(x for s in spans for x in s), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
            # Of a text that comes twice, all is a passage.
            n = len(data.split()) if copies > 1 else 0
            passage = (1, n) if n >= RUN_WORDS else (int(n_passages or 0), int(n_passage_words or 0))
            rows.append((doc_id, len(data), len(data) - len(kept), len(spans), [x for s in spans for x in s], kept, *passage))
        out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "n_passages", "n_passage_words"])
        yield out.astype({"doc_id": "Int64"})


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the removed spans (start, end, start, ...) and the kept bytes of every row,
    with n_passages and n_passage_words: its runs of more than 50 words that another row holds, whatever their bytes."""
    keyed = _with_keys(docs)
    # One row stands for all with the same text.
    same = stored(keyed.groupBy("t").agg(F.min(F.struct(*ROW)).alias("one"), F.count("*").alias("copies")), "same-texts")
    wanted = shared_windows(keyed).join(same, "t").select("one.*", "t", "windows")
    windows, found, runs = places(docs, runs_wanted=wanted)
    passage = same.join(passages(runs), "t", "left").filter("copies > 1 or n_passages > 0")
    passage = keyed.select("t", *ROW).distinct().join(passage, "t").select(*ROW, "copies", "n_passages", "n_passage_words")
    spans = stored(
        found.groupBy(*SEGMENT).agg(F.collect_set(F.struct("pos", "length")).alias("own"))
        .mapInPandas(_join_spans, "key long, h1 long, h2 long, spans array<int>"), "spans")
    per_row = windows.join(spans, SEGMENT).groupBy(*ROW).agg(
        F.collect_set(F.struct("start", "spans")).alias("found"))
    per_row = per_row.join(passage, ROW, "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return keyed.join(per_row, ROW, "left").select("doc_id", "text", "found", *map(zero, ("copies", "n_passages", "n_passage_words"))).mapInPandas(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<long>, kept binary, n_passages long, n_passage_words long")
