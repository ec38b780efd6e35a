"""Token ids in packs of a fixed length: best-fit decreasing, written as binary rows.

Documents are encoded whole; one longer than a pack is split into pieces, none
lost. Pieces are dealt into groups by a hash, and each group of at most
``PIECES`` pieces is packed by itself: longest first, into the open pack with
the least room that suffices, found in a segment tree over the free room.

A row is one pack: the ids as 16-bit little-endian numbers padded to the pack
length, the cumulative segment lengths (0 first), for each segment its document
and the offset of its first token there, and the position of each token in its
segment as 32-bit little-endian numbers, 0 for the padding: positions restart at
every segment (``positions``). ``write`` puts the rows into a folder, ``unpack`` gives
the documents back.

Null and empty texts have no token and are in no pack. Repeated rows and rows
without an id are packed each. An empty table gives no pack. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_texts
from .token_counts import encoder, ranks_path

PACK = 2048
PAD = 50256  # free in the vocabulary
PIECES = 4096
BYTES_PER_TOKEN = 3  # only decides how many groups there are
ROW = ("pack_id long, n_tokens int, cu_seqlens array<int>, doc_ids array<long>, doc_offsets array<long>, ids binary, positions binary")


class FreeRoom:
    """Segment tree over the amounts of free room 0..size: how many packs have each."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.tree = [0] * (2 * self.leaves)
        self.packs: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += by
            node //= 2

    def put(self, room: int, pack: int) -> None:
        self.packs[room].append(pack)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, pack) with the smallest room of at least ``least``."""
        node = self.leaves + least
        if not self.tree[node]:
            # Up to the first ancestor whose right neighbour has packs, then down its left side.
            while node > 1 and (node % 2 or not self.tree[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        pack = self.packs[room].pop()
        self._add(room, -1)
        return room, pack


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Indices of the pieces in each pack; ``lengths`` come in falling order."""
    room, packs = FreeRoom(size), []
    for i, n in enumerate(lengths):
        found = room.take(n)
        if found is None:
            packs.append([])
            found = size, len(packs) - 1
        left, pack = found
        packs[pack].append(i)
        room.put(left - n, pack)
    return packs


def pieces(docs: DataFrame, size: int = PACK, path: str | None = None) -> DataFrame:
    """row_key, doc_id, offset of the first token, n and ids (16-bit) of every piece."""
    path = path or ranks_path()

    def run(batches):
        own = encoder(path)
        for batch in batches:
            keys, ids, offsets, counts, data = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("row_key", "doc_id", "text"))
            for key, doc_id, text in zip(*columns):
                tokens = np.array(own.encode_ordinary(text), np.uint16)
                for at in range(0, len(tokens), size):
                    keys.append(key)
                    ids.append(doc_id)
                    offsets.append(at)
                    counts.append(len(tokens[at:at + size]))
                    data.append(tokens[at:at + size].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()),
                 pa.array(counts, pa.int32()), pa.array(data, pa.binary())],
                ["row_key", "doc_id", "offset", "n", "ids"])

    texts = doc_texts(docs).select(F.xxhash64("doc_id", "text").alias("row_key"), "doc_id", "text")
    return texts.mapInArrow(run, "row_key long, doc_id long, offset long, n int, ids binary")


def _packed(rows: pd.DataFrame, group: int, part: int, size: int) -> pd.DataFrame:
    rows = rows.sort_values(["n", "row_key", "offset"], ascending=[False, True, True], kind="stable")
    n, data = rows["n"].tolist(), rows["ids"].tolist()
    ids, offsets = rows["doc_id"].tolist(), rows["offset"].tolist()
    out = []
    for k, members in enumerate(best_fit(n, size)):
        content = b"".join(data[i] for i in members)
        used = len(content) // 2
        edges = np.cumsum([0, *(n[i] for i in members)]).tolist()
        out.append((
            (group << 24) + (part << 12) + k, used, edges,
            [None if pd.isna(ids[i]) else int(ids[i]) for i in members], [offsets[i] for i in members],
            content + np.full(size - used, PAD, "<u2").tobytes(),
            np.pad(positions(edges), (0, size - used)).astype("<u4").tobytes()))
    return pd.DataFrame(out, columns=["pack_id", "n_tokens", "cu_seqlens", "doc_ids", "doc_offsets", "ids", "positions"])


def pack(docs: DataFrame, size: int = PACK, path: str | None = None) -> DataFrame:
    """One row per pack."""
    total = doc_texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_groups = max(1, -(-total // (BYTES_PER_TOKEN * size * PIECES // 4)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows arrive group by group; PIECES of them at most are held."""
        held: list[pd.DataFrame] = []
        n, group, part = 0, None, 0
        for pdf in batches:
            groups = pdf["group"].to_numpy()
            at = 0
            while at < len(pdf):
                if n and (groups[at] != group or n == PIECES):
                    yield _packed(pd.concat(held), group, part, size)
                    part = part + 1 if groups[at] == group else 0
                    held, n = [], 0
                group = int(groups[at])
                end = min(int(np.searchsorted(groups, group, "right")), at + PIECES - n)
                held.append(pdf.iloc[at:end])
                n, at = n + end - at, end
        if held:
            yield _packed(pd.concat(held), group, part, size)

    grouped = pieces(docs, size, path).withColumn("group", F.pmod(F.xxhash64("row_key", "offset"), F.lit(n_groups)))
    return grouped.repartition("group").sortWithinPartitions("group", "row_key", "offset").mapInPandas(run, ROW)


def positions(cu_seqlens: list[int]) -> np.ndarray:
    """Position of every token in its segment."""
    edges = np.asarray(cu_seqlens)
    return np.arange(edges[-1]) - np.repeat(edges[:-1], np.diff(edges))


def write(packs: DataFrame, folder: str) -> None:
    """The packs as Parquet: matrix rows of ids and of positions, and the segment lengths."""
    packs.write.parquet(folder)


def unpack(packs: DataFrame) -> DataFrame:
    """doc_id, offset and ids (array) of every segment."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                ids = np.frombuffer(r.ids, "<u2")
                rows += [(None if pd.isna(d) else int(d), o, ids[a:b].tolist())
                         for d, o, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:])]
            yield pd.DataFrame(rows, columns=["doc_id", "offset", "ids"]).astype({"doc_id": "Int64"})

    return packs.select("ids", "cu_seqlens", "doc_ids", "doc_offsets").mapInPandas(run, "doc_id long, offset long, ids array<int>")
