"""Passages: runs of RUN_WORDS words or more that another text holds, too.

A shared passage may be shorter than what a byte repeat needs, so it is looked for
by words. Every run of RUN_WORDS words is dealt out by the smallest hash among its
runs of KEY_WORDS words (its minimizer), which equal runs have in common:

1. Windows (neighbouring runs with one minimizer) are found in every text. Only
   minimizers of two or more different texts matter.
2. The runs of those windows are hashed, once per different text, and a run that
   two different texts hold is shared.

A text that occurs in several rows is a passage as a whole, if it is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .shingles import prefix_hashes, span_hashes

RUN_WORDS = 51
KEY_WORDS = 12
CHUNK = 1 << 20  # words of a text looked at together
_PLACE = np.uint64((1 << 21) - 1)


def word_edges(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words, joined by single blanks, with the first and last-but-one byte of each."""
    data = np.frombuffer(b" ".join(text.encode("utf-8", "surrogatepass").split()), np.uint8)
    blanks = np.flatnonzero(data == 32)
    if not len(data):
        return data, blanks, blanks
    return data, np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(data)]])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    return np.lib.stride_tricks.sliding_window_view(values, width).min(axis=1)


def passage_windows(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First run, number of runs and minimizer of each window."""
    data, starts, ends = word_edges(text)
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    if len(starts) >= RUN_WORDS:
        sums = prefix_hashes(data)
        for at in range(0, len(starts) - RUN_WORDS + 1, CHUNK):
            first, last = starts[at:at + CHUNK + RUN_WORDS - 1], ends[at:at + CHUNK + RUN_WORDS - 1]
            keys = span_hashes(sums, first[: len(first) - KEY_WORDS + 1], last[KEY_WORDS - 1:])
            # Of equal hashes the leftmost is taken, so that a window ends where its minimizer does.
            least = smallest(keys & ~_PLACE | np.arange(len(keys), dtype=np.uint64), RUN_WORDS - KEY_WORDS + 1)
            edge = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            out[0].append(edge + at)
            out[1].append(np.diff(np.append(edge, len(least))))
            out[2].append(keys[(least[edge] & _PLACE).astype(np.int64)].view(np.int64))
    return tuple(np.concatenate(c) for c in out)


def run_hashes(text: str, windows) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run in the windows (start, count)."""
    data, starts, ends = word_edges(text)
    at = np.unique(np.concatenate([np.arange(w["start"], w["start"] + w["count"]) for w in windows]))
    return at, span_hashes(prefix_hashes(data), starts[at], ends[at + RUN_WORDS - 1]).view(np.int64)


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [passage_windows(t) for t in pdf["text"]]
        start, count, key = (np.concatenate([f[i] for f in found]) for i in range(3))
        yield pd.DataFrame({"t": np.repeat(pdf["t"].to_numpy(), [len(f[0]) for f in found]), "start": start.astype(np.int32), "count": count.astype(np.int8), "key": key})


def shared_windows(texts: DataFrame) -> DataFrame:
    """t and its windows whose minimizers other texts have, too; ``texts`` has t (a hash of the text) and text."""
    windows = stored(texts.select("t", "text").mapInPandas(_find, "t long, start int, count tinyint, key long"), "passage-windows")
    # Written, so that both sides of the join come from a plain shuffle and a hot key is split.
    shared = stored(windows.groupBy("key").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter("a <> b").select("key"), "passage-keys")
    return windows.join(shared, "key", "left_semi").groupBy("t").agg(
        F.collect_set(F.struct("start", F.col("count").cast("int").alias("count"))).alias("windows"))


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for t, at in zip(pdf["t"], pdf["at"]):
            at = np.sort(np.asarray(at, np.int64))
            gaps = np.diff(at)
            rows.append((t, 1 + int((gaps > RUN_WORDS).sum()), int(np.minimum(gaps, RUN_WORDS).sum()) + RUN_WORDS))
        yield pd.DataFrame(rows, columns=["t", "n_passages", "n_passage_words"])


def passages(runs: DataFrame) -> DataFrame:
    """t, n_passages and n_passage_words from the runs (t, at, run) of different texts."""
    shared = stored(runs.groupBy("run").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter("a <> b").select("run"), "shared-runs")
    return runs.join(shared, "run", "left_semi").groupBy("t").agg(F.collect_set("at").alias("at")).mapInPandas(
        _spans, "t long, n_passages long, n_passage_words long")
