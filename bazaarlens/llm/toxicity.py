"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The n-grams are the first 3 to 6 characters of the words of the lower-cased text, so that
a stem is seen whatever ending it has, and the last 4 and 6 of longer words, so that the
end of a compound is seen too. Words of more than twice six characters also have n-grams
from the seventh on, and a word of one or two characters is an n-gram of its own. A run
of more than ``LONG`` characters without white space is no word (scripts without blanks,
glued text): there the n-grams begin at every character. So every character of a text
belongs to an n-gram. They are hashed into ``FEATURES`` bins and counted; a count weighs
the logarithm of itself and one. Each bin is scaled by the logarithm of its smoothed share
among toxic texts over that among the others, and a text by the length of the vector of
its scaled bins. A logistic regression on these values, in which a toxic text counts
``TOXIC_WEIGHT`` times, is trained by full-batch gradient steps.

The classifier learns from every labelled document outside the held out fold. The shares
of the bins are exact sums over all of them. The regression is fitted on shards of at
least ``SHARD`` documents (fewer where they are long), dealt by a hash, in parallel, and
the coefficients of the shards are averaged. Where a class has too few rows for all
shards, each of its rows is in several, and is weighed so that its class keeps the share
it has among all documents. Every document is scored, over its whole text, however long.

Null, empty and blank texts have no n-gram and get the score of the intercept. Without
labels the score is 0, with one class only it is that class. Repeated rows are learned
once and get the same score; different texts under one id are all learned; of
contradicting labels the toxic one counts. Rows without an id are scored and not held
out. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_texts, stored

BITS = 18
FEATURES = 1 << BITS
ORDERS = (3, 4, 5, 6)
ENDS = (4, 6)  # characters of what ends a word
STEPS, RATE, DECAY, ALPHA = 300, 0.3, 1e-4, 1.0
TOXIC_WEIGHT = 2.0
TOXIC_FROM = 0.3
LONG = 16  # characters of the longest word
CHUNK = 1 << 20  # characters hashed at once
SHARD, ENTRIES = 4500, 3 << 20  # documents, and bins of documents, fitted together
LEAST = 32  # rows of a class in a shard, if there are as many
BROADCAST_IDS = 250_000  # labelled ids that are broadcast; more are joined by a shuffle
UNIT = 2.0 ** 24  # sums over tasks are of whole parts of one, the same in every order
_BLANK = 32
_BEGIN, _MIDDLE, _END, _SHORT = 0x811C9DC5, 0x3C6EF372, 0x2F0B4C47, 0x5D1A93E1

Found = tuple[np.ndarray, np.ndarray]  # bins and their counts
Model = tuple[np.ndarray, np.ndarray, float]  # ratio and coefficient of every bin, intercept


def _hashed(
    codes: np.ndarray, starts: np.ndarray, room: np.ndarray, orders: tuple[int, ...] = ORDERS, seed: int = _BEGIN, step: int = 1,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and bins of as many characters as ``orders`` say that follow ``starts``, if there is room for them."""
    h = np.full(len(starts), seed, np.uint32)
    for j in range(1, max(orders) + 1):
        enough = room >= j
        starts, room, h = starts[enough], room[enough], h[enough]
        h = (h ^ codes[starts + step * j]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        if j in orders:
            yield starts, ((h + np.uint32(j)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _beginnings(codes: np.ndarray, before: np.ndarray, after: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The first characters of the runs between the blanks ``before`` and ``after``; of long runs, those from every character."""
    size = after - before - 1
    inner = np.where(size > LONG, size, 0)
    run = np.repeat(np.arange(len(size)), inner)
    inside = before[run] + 1 + np.arange(len(run)) - (np.cumsum(inner) - inner)[run]
    starts, room = np.concatenate([before, inside]), np.concatenate([size, after[run] - inside - 1])
    here = own[starts]
    yield from _hashed(codes, starts[here], room[here])


def _rests(codes: np.ndarray, before: np.ndarray, after: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What the beginnings do not hold of a word: its end, its middle, and words too short for a beginning."""
    size, head = after - before - 1, max(ORDERS)
    ends = (size > head) & (size <= LONG) & own[after]
    yield from _hashed(codes, after[ends], size[ends], ENDS, _END, -1)
    middles = (size > 2 * head) & (size <= LONG) & own[before]
    yield from _hashed(codes, before[middles] + head, size[middles] - head, ENDS, _MIDDLE)
    for n in range(1, min(ORDERS)):
        short = (size == n) & own[before]
        yield from _hashed(codes, before[short], size[short], (n,), _SHORT)


def _counted(texts: list[str], *views: Callable[..., Iterator[tuple[np.ndarray, np.ndarray]]]) -> list[Found]:
    """The bins that ``views`` see in each text, ascending, and how often it has each."""
    texts = [" ".join(["", *text.lower().split(), ""]) for text in texts]
    margin = LONG + max(ORDERS)  # enough to tell on either side whether a run is long
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, max(map(len, texts), default=0), CHUNK):
        before = min(start, margin)
        numbers = [i for i, text in enumerate(texts) if len(text) > start]
        pieces = [f" {texts[i][start - before:start + CHUNK + margin]} " for i in numbers]
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        codes = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        number = np.repeat(np.array(numbers, np.int64), sizes)
        place = np.arange(len(codes)) - np.repeat(ends - sizes, sizes)
        own = (place > before) & (place <= before + CHUNK)
        own[ends - 1] = False  # nor is the blank that begins a piece
        blanks = np.flatnonzero(codes == _BLANK)
        seen = [number[at] << BITS | bins for view in views for at, bins in view(codes, blanks[:-1], blanks[1:], own)]
        seen, times = np.unique(np.concatenate(seen), return_counts=True)
        if start:
            seen, at = np.unique(np.concatenate([found, seen]), return_inverse=True)
            times = np.bincount(at, np.concatenate([counts, times])).astype(np.int64)
        found, counts = seen, times
    cuts = np.searchsorted(found, np.arange(len(texts) + 1) << BITS)
    bins, counts = (found & ((1 << BITS) - 1)).astype(np.int32), counts.astype(np.int32)
    return [(bins[a:b], counts[a:b]) for a, b in zip(cuts, cuts[1:])]


def features(text: str) -> Found:
    """The word beginnings, and all of long runs."""
    return _counted([text], _beginnings)[0]


def whole_features(texts: list[str]) -> list[Found]:
    """What ``features`` finds and the rests of the words: every character is in one of the n-grams."""
    return _counted(texts, _beginnings, _rests)


def bunches(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in their order, ``CHUNK`` characters at once unless one has more."""
    bunch, size = [], 0
    for text in texts:
        if bunch and size + len(text) > CHUNK:
            yield bunch
            bunch, size = [], 0
        bunch.append(text)
        size += len(text)
    if bunch:
        yield bunch


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50.0, 50.0)))


def parts(amounts: np.ndarray) -> np.ndarray:
    return np.rint(amounts * UNIT).astype(np.int64)


def log_ratio(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Smoothed share of every bin among toxic texts over that among the others."""
    pos, neg = (ALPHA + sums / UNIT for sums in (toxic, other))
    return np.log((pos / pos.sum()) / (neg / neg.sum())).astype(np.float32)


def one_class(share: float) -> Model:
    return np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.float32), 50.0 if share else -50.0


def fit(found: list[Found], toxic: np.ndarray, ratio: np.ndarray | None = None, toxic_weight: float = TOXIC_WEIGHT) -> Model:
    """Log-count ratio (of these texts unless ``ratio`` is given) and coefficient of every bin, and the intercept."""
    n = len(found)
    share = float(toxic.mean()) if n else 0.0
    if share in (0.0, 1.0):
        return one_class(share)
    sizes = np.array([len(b) for b, _ in found])
    row = np.repeat(np.arange(n), sizes)
    bins, amount = np.concatenate([b for b, _ in found]), np.log1p(np.concatenate([c for _, c in found]))
    del found
    if ratio is None:
        ratio = log_ratio(*(np.bincount(bins[toxic[row] == k], parts(amount[toxic[row] == k]), FEATURES) for k in (1, 0)))
    value = amount * ratio[bins]
    del amount
    value /= np.sqrt(np.maximum(np.bincount(row, value * value, n), 1e-9))[row]
    weight = np.where(toxic == 1, toxic_weight, 1.0)
    weight /= weight.sum()
    # Sums over a text add neighbours; those over a bin do so in a second copy, in the order of the bins.
    some = np.flatnonzero(sizes)
    texts = (np.cumsum(sizes) - sizes)[some]
    order = np.argsort(bins, kind="stable")
    row, turned, ordered = row[order], value[order], bins[order]
    heads = np.flatnonzero(np.diff(ordered, prepend=-1))
    held = ordered[heads]  # the coefficients of other bins stay 0
    del order, ordered
    at = np.zeros(FEATURES, np.intp)
    at[held] = np.arange(len(held))
    at = at[bins]
    del bins
    w, b = np.zeros(len(held)), 0.0
    seen_w, seen_b = np.full(len(held), 1e-8), 1e-8
    z, each = np.zeros(n), np.empty(len(at))
    for _ in range(STEPS):  # AdaGrad on the whole shard
        np.take(w, at, out=each, mode="clip")
        z[some] = np.add.reduceat(np.multiply(each, value, out=each), texts)
        error = (sigmoid(z + b) - toxic) * weight
        np.take(error, row, out=each, mode="clip")
        grad = np.add.reduceat(np.multiply(each, turned, out=each), heads) + DECAY * w
        seen_w += grad * grad
        w -= RATE * grad / np.sqrt(seen_w)
        seen_b += error.sum() ** 2
        b -= RATE * error.sum() / np.sqrt(seen_b)
    weights = np.zeros(FEATURES, np.float32)
    weights[held] = w
    return ratio, weights, float(b)


def scores_of(found: list[Found], model: Model) -> np.ndarray:
    ratio, w, b = model
    row = np.repeat(np.arange(len(found)), [len(b) for b, _ in found])
    bins, counts = (np.concatenate([f[k] for f in found]) for k in (0, 1))
    value = np.log1p(counts) * ratio[bins]
    length = np.sqrt(np.maximum(np.bincount(row, value * value, len(found)), 1e-9))
    return np.round(sigmoid(np.bincount(row, value * w[bins], len(found)) / length + b), 6)


def score_of(found: Found, model: Model) -> float:
    return float(scores_of([found], model)[0])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_sample(labels: DataFrame, max_toxic: int | None = None, max_other: int | None = None) -> DataFrame:
    """(doc_id, toxic) of all labelled documents outside the held out fold, or of a bounded number of a class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.dropna().filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if max_toxic is None and max_other is None:
        return known.filter(F.col("toxic").isin(0, 1))
    of = lambda value: known.filter(F.col("toxic") == value)
    first = lambda value, n: of(value) if n is None else of(value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    return first(1, max_toxic).union(first(0, max_other))


def _packed(found: Found) -> bytes:
    """Gaps between the bins, then counts, byte by byte, so that they compress well."""
    bins, counts = found
    numbers = np.stack([np.diff(bins, prepend=np.int32(0)), counts]).astype("<i4")
    return numbers.view(np.uint8).reshape(2, len(bins), 4).transpose(0, 2, 1).tobytes()


def _unpacked(data: bytes) -> Found:
    planes = np.frombuffer(data, np.uint8).reshape(2, 4, len(data) // 8)
    gaps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i4")[:, :, 0]
    return np.cumsum(gaps, dtype=np.int32), counts


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        packed = [_packed(found) for bunch in bunches(pdf["text"]) for found in whole_features(bunch)]
        yield pd.DataFrame({"toxic": pdf["toxic"], "deal": pdf["deal"], "size": [len(p) // 8 for p in packed], "packed": packed})


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, FEATURES), np.int64)
    for batch in batches:
        for toxic, data in zip(batch.column("toxic").to_pylist(), batch.column("packed").to_pylist()):
            bins, counts = _unpacked(data)
            total[toxic, bins] += parts(np.log1p(counts))
    held = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[1, held]), pa.array(total[0, held])], ["bin", "toxic", "other"])


def ratios(rows: DataFrame) -> np.ndarray:
    """The log-count ratios over all rows."""
    sums = rows.select("toxic", "packed").mapInArrow(_sums, "bin long, toxic long, other long")
    sums = sums.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    total = np.zeros((2, FEATURES), np.int64)
    total[:, sums["bin"].to_numpy()] = [sums["toxic"].to_numpy(), sums["other"].to_numpy()]
    return log_ratio(*total)


def dealt(rows: DataFrame, n_toxic: int, n_other: int, shards: int) -> DataFrame:
    """Each row with its ``shard``, or its shards where its class has fewer than ``LEAST`` rows for each of them."""
    groups = [max(1, min(shards, n // LEAST)) for n in (n_other, n_toxic)]
    n = F.when(F.col("toxic") == 1, F.lit(groups[1])).otherwise(F.lit(groups[0]))
    return rows.withColumn("shard", F.explode(F.sequence(F.pmod("deal", n).cast("int"), F.lit(shards - 1), n)))


def _fitted(pdf: pd.DataFrame, ratio: np.ndarray, odds: float) -> pd.DataFrame:
    """Coefficients of a shard, the intercept behind them; ``odds`` are those of all documents to be toxic."""
    pdf = pdf.sort_values(["toxic", "packed"])  # the same sums whatever the order of arrival
    toxic = pdf["toxic"].to_numpy(float)
    n = toxic.sum()
    if n in (0, len(toxic)):  # next to impossible by LEAST; it tells nothing of the difference
        return pd.DataFrame({"bin": [], "weight": []}, dtype="int64")
    _, w, b = fit([_unpacked(p) for p in pdf["packed"]], toxic, ratio, TOXIC_WEIGHT * (odds / (n / (len(toxic) - n))))
    whole = parts(np.append(w.astype(float), b))
    held = np.append(np.flatnonzero(whole[:-1]), FEATURES)
    return pd.DataFrame({"bin": held, "weight": whole[held]})


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model: two numbers for each of ``FEATURES`` bins and an intercept, from all labelled documents outside the fold."""
    known = training_sample(labels)
    known = known.hint("broadcast" if known.count() <= BROADCAST_IDS else "shuffle_hash")
    texts = doc_texts(docs).filter(~held_out(F.col("doc_id"))).join(known, "doc_id")
    texts = texts.groupBy("doc_id", "text").agg(F.max("toxic").alias("toxic"))
    rows = stored(
        texts.select("toxic", F.xxhash64("doc_id", "text").alias("deal"), "text")
        .mapInPandas(_extract, "toxic int, deal long, size int, packed binary"), "toxic-features")
    n, n_toxic, entries = rows.agg(F.count("*"), F.sum("toxic"), F.sum("size")).first()
    if not n or n_toxic in (0, n):
        return one_class(n_toxic or 0)
    ratio = ratios(rows)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # one megabyte
    odds = n_toxic / (n - n_toxic)
    shards = dealt(rows, n_toxic, n - n_toxic, max(1, n // SHARD, entries // ENTRIES))
    fitted = shards.groupBy("shard").applyInPandas(lambda pdf: _fitted(pdf, shared.value, odds), "bin long, weight long")
    sums = fitted.groupBy("bin").agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).toArrow().to_pandas().set_index("bin")
    mean = np.zeros(FEATURES + 1)
    mean[sums.index] = sums["weight"] / UNIT / sums["n"].loc[FEATURES]  # every shard has an intercept
    return ratio, mean[:-1].astype(np.float32), float(mean[-1])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two megabytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = [scores_of(whole_features(bunch), shared.value) for bunch in bunches(pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": np.concatenate([[], *scores])})

    texts = doc_texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = texts.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))
