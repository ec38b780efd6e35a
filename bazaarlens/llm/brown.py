"""Brown class-based bigrams: exchange clustering, and the probability of texts.

A text is a sequence of words and one end. Each word belongs to one class, and

    P(text) = product of P(class | class before) * P(word | class),

where the end also stands before the first word.

1. Words of the training documents are counted exactly. The ``core`` most frequent
   ones (seen twice or more) are items of the clustering. All others, unseen words
   included, belong to one of ``types`` items by the hash of their last three
   bytes, so that every word has a class without being looked up.
2. Pairs of neighbouring items are counted over all training documents, per item
   with its neighbours on both sides. Rows of a hot item are merged by task first.
3. The most frequent items are clustered one after the other (their pairs are a
   matrix of ``seeds`` squared); then all items are assigned in rounds: each item
   goes to the class that raises the likelihood of the class bigrams most, the
   other items staying where the round before left them. A round moves every other
   item, so that neighbours do not jump at once, and does not depend on partitions.
4. Class transitions are smoothed by the classes' shares, emissions by add-one over
   the words of a class and one unseen word per type.
5. The ``dictionary`` most frequent words are broadcast with their counts. Rarer
   words of a text are joined with the counts; their number falls with frequency,
   so no key is hot.

What is sent to the driver or broadcast is bounded by ``core``, ``types``,
``classes`` and ``dictionary``, never by the corpus; all counts cover all of it.

Null and empty texts are one end. Repeated rows are documents of their own, in
training and scoring. A row without an id has the checksum 0 and trains. Very long
texts are read whole. Words with equal counts are ordered by their bytes. Without
training documents both scores are 0. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .words import TOKENS, byte_texts, byte_words

FOLDS, FOLD = 7, 2
CORE = 1 << 15
DICTIONARY = 1 << 18
TYPES = 256
CLASSES = 128
SEEDS = 768
SWEEPS = 2
SUFFIX = 3  # last bytes that make the type of a word
HELD_WORDS = 1 << 19  # counted words that a task holds before it hands them on
HELD_TOKENS = 1 << 21  # tokens whose pairs are counted together
HOT = 1000  # an item with more than one token in so many is merged by task first
SALTS = 64
PAIRS = "item int, salt int, others binary, counts binary"


def is_held_out() -> Column:
    """Whether the checksum of the id falls into the held-out fold."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == FOLD


def word_type(word: bytes, types: int) -> int:
    return crc32(word[-SUFFIX:]) % types


def _type_column(word: str, types: int) -> Column:
    last = F.when(F.octet_length(word) > SUFFIX, F.expr(f"substring({word}, octet_length({word}) - {SUFFIX - 1}, {SUFFIX})")).otherwise(F.col(word))
    return (F.crc32(last) % types).cast("int")


class Numbers(dict):
    """Number of a word: 0 for the end, then the dictionary, then one per type."""

    def __init__(self, words: list[bytes], types: int):
        super().__init__((w, i + 1) for i, w in enumerate(words))
        self.first, self.types = len(words) + 1, types

    def __missing__(self, word: bytes) -> int:
        return self.first + word_type(word, self.types)


class Lexicon:
    """The broadcast words and the item of every number."""

    def __init__(self, words: list[bytes], counts: list[int], ends: int, core: int, types: int):
        self.words, self.types, self.size = words, types, len(words)
        self.counts = np.array([ends, *counts, *[0] * types], np.int64)
        self.core = min(core, sum(1 for n in counts if n > 1))
        self.items = 1 + self.core + types
        of_type = [1 + self.core + word_type(w, types) for w in words[self.core:]]
        self.item_of = np.array([*range(1 + self.core), *of_type, *range(1 + self.core, self.items)], np.int32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "numbers"}

    def number(self, words: list[bytes]) -> np.ndarray:
        if "numbers" not in self.__dict__:
            self.numbers = Numbers(self.words, self.types)
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (bytes) and n over all rows of ``texts``."""

    def count(batches):
        held = Counter()

        def flush():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for data in batch.column("data").to_pylist():
                held.update(byte_words(data, TOKENS))
                if len(held) >= HELD_WORDS:
                    yield flush()
        yield flush()

    return texts.select("data").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_count(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach."""
    least, reached = 1 << 62, 0
    for r in words.groupBy("n").count().orderBy(F.desc("n")).limit(most).collect():
        reached += r["count"]
        if reached > most:
            break
        least = r["n"]
    return least


def _binaries(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary per stretch of ``data`` between ``edges``."""
    offsets = (edges * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _neighbours(lexicon, hot: np.ndarray):
    """Per item, its neighbours (item * 2, and 1 more for those that follow it) and their counts."""

    def run(batches):
        own = lexicon.value
        width, salt = 2 * own.items, TaskContext.get().partitionId() % SALTS
        held: list[np.ndarray] = []
        size = 0

        def flush():
            line = np.concatenate([np.zeros(1, np.int64), *held])
            before, after = line[:-1], line[1:]
            keys, counts = np.unique(np.concatenate([before * width + after * 2 + 1, after * width + before * 2]), return_counts=True)
            items = keys // width
            edges = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1], [True]]))
            which = items[edges[:-1]].astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(np.where(hot[which], salt, -1).astype(np.int32)),
                 _binaries((keys % width).astype(np.int32), edges), _binaries(counts, edges)], ["item", "salt", "others", "counts"])

        for batch in batches:
            for data in batch.column("data").to_pylist():
                numbers = own.number(byte_words(data, TOKENS))
                held.append(np.append(own.item_of[numbers].astype(np.int64), 0))
                size += len(held[-1])
                if size >= HELD_TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _merge(items: int):
    """One row per item from rows ordered by item."""

    def run(batches):
        total, item, out = np.zeros(2 * items, np.int64), None, []

        def close():
            at = np.flatnonzero(total)
            out.append((item, at.astype(np.int32).tobytes(), total[at].tobytes()))
            total[at] = 0

        for batch in batches:
            for new, others, counts in zip(*(batch.column(c).to_pylist() for c in ("item", "others", "counts"))):
                if item is not None and new != item:
                    close()
                item = new
                total[np.frombuffer(others, np.int32)] += np.frombuffer(counts, np.int64)
            if out:
                yield _rows(out)
                out = []
        if item is not None:
            close()
            yield _rows(out)

    return run


def _rows(out: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    item, others, counts = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(item, pa.int32()), pa.array([-1] * len(item), pa.int32()), pa.array(others, pa.binary()), pa.array(counts, pa.binary())],
        ["item", "salt", "others", "counts"])


def item_pairs(texts: DataFrame, lexicon, items: int, hot: np.ndarray) -> DataFrame:
    """One row per item that occurs: item, others, counts."""
    found = texts.select("data").mapInArrow(_neighbours(lexicon, hot), PAIRS)
    if hot.any():
        found = stored(found, "item-pairs")
        merged = found.filter("salt >= 0").repartition("item", "salt").sortWithinPartitions("item").mapInArrow(_merge(items), PAIRS)
        found = found.filter("salt < 0").unionByName(merged)
    found = found.repartition("item").sortWithinPartitions("item").mapInArrow(_merge(items), PAIRS)
    return stored(found.select("item", "others", "counts"), "items")


def phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def class_vectors(item: int, others: np.ndarray, counts: np.ndarray, classes: np.ndarray, n: int):
    """Tokens of each class before and after an item, and pairs of the item with itself.

    Neighbours without a class do not count.
    """
    other, after = others >> 1, (others & 1).astype(bool)
    known, itself = classes[other] >= 0, other == item
    sides = [known & ~itself & ~after, known & ~itself & after]
    left, right = (np.bincount(classes[other[s]], counts[s], n) for s in sides)
    return left, right, float(counts[itself & after].sum())


def best_class(pairs: np.ndarray, left: np.ndarray, right: np.ndarray, itself: float, now: int) -> int:
    """The class in which an item gives the class bigrams the highest likelihood.

    ``pairs`` counts class bigrams, with the item in class ``now`` (-1: nowhere).
    Among equal classes the present one is taken, then the first.
    """
    rest = pairs.copy()
    if now >= 0:
        rest[:, now] -= left
        rest[now, :] -= right
        rest[now, now] -= itself
    rows, columns = np.flatnonzero(left), np.flatnonzero(right)
    n = len(rest)
    # Cells above and beside each class, and the one in which both meet.
    above, beside = rest[rows, :], rest[:, columns]
    gain = (phi(above + left[rows, None]) - phi(above)).sum(axis=0) + (phi(beside + right[columns]) - phi(beside)).sum(axis=1)
    corner = rest[np.arange(n), np.arange(n)]
    gain -= phi(corner + left) - phi(corner) + phi(corner + right) - phi(corner)
    gain += phi(corner + left + right + itself) - phi(corner)
    # Pairs of other classes with the item count in their sums, wherever it goes.
    starts, ends = rest.sum(axis=1) + left, rest.sum(axis=0) + right
    gain -= phi(starts + right.sum() + itself) - phi(starts) + phi(ends + left.sum() + itself) - phi(ends)
    best = int(np.argmax(gain))
    return now if now >= 0 and gain[now] >= gain[best] - 1e-9 else best


def cluster_seeds(pairs: np.ndarray, n: int, sweeps: int) -> np.ndarray:
    """Classes of the most frequent items, first of them first, from their pair counts."""
    classes, table = np.full(len(pairs), -1), np.zeros((n, n))

    def vectors(i):
        some = (classes >= 0) & (np.arange(len(pairs)) != i)
        return np.bincount(classes[some], pairs[some, i], n), np.bincount(classes[some], pairs[i, some], n), pairs[i, i]

    def shift(i, to, left, right, itself, sign):
        table[:, to] += sign * left
        table[to, :] += sign * right
        table[to, to] += sign * itself
        classes[i] = to if sign > 0 else -1

    for sweep in range(1 + sweeps):
        for i in range(len(pairs)):
            own = vectors(i)
            to = i if sweep == 0 and i < n else best_class(table, *own, int(classes[i]))
            if classes[i] != to:
                if classes[i] >= 0:
                    shift(i, int(classes[i]), *own, -1)
                shift(i, to, *own, 1)
    return classes


def _read(batches):
    for batch in batches:
        for item, others, counts in zip(*(batch.column(c).to_pylist() for c in ("item", "others", "counts"))):
            yield item, np.frombuffer(others, np.int32), np.frombuffer(counts, np.int64)


def class_pairs(items: DataFrame, classes: np.ndarray, n: int) -> np.ndarray:
    """Counts of class bigrams, at most ``n`` squared rows."""

    def count(batches):
        table = np.zeros((n, n))
        for item, others, counts in _read(batches):
            if classes[item] >= 0:
                _, right, itself = class_vectors(item, others, counts, classes, n)
                table[classes[item]] += right
                table[classes[item], classes[item]] += itself
        at = np.flatnonzero(table.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table.ravel()[at].astype(np.int64))], ["cell", "n"])

    table = np.zeros(n * n)
    for r in items.mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table[r["cell"]] = r["n"]
    return table.reshape(n, n)


def moved(items: DataFrame, classes: np.ndarray, table: np.ndarray, part) -> np.ndarray:
    """Classes after all items of ``part`` (a condition on ``item``) went to their best class."""

    def move(batches):
        found = [(i, best_class(table, *class_vectors(i, o, c, classes, len(table)), int(classes[i]))) for i, o, c in _read(batches)]
        item, to = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(to, pa.int32())], ["item", "to"])

    out = classes.copy()
    for r in items.filter(part).mapInArrow(move, "item int, to int").collect():
        out[r["item"]] = r["to"]
    return out


def seed_pairs(items: DataFrame, seeds: np.ndarray, size: int) -> np.ndarray:
    """Pair counts among the seeds."""
    at = np.full(size, -1)
    at[seeds] = np.arange(len(seeds))

    def pick(batches):
        for item, others, counts in _read(batches):
            other = at[others >> 1]
            some = (others & 1).astype(bool) & (other >= 0)
            n = int(some.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(at[item])] * n, pa.int32()), pa.array(other[some], pa.int32()), pa.array(counts[some], pa.int64())], ["a", "b", "n"])

    out = np.zeros((len(seeds), len(seeds)))
    found = items.filter(F.col("item").isin([int(s) for s in seeds])).mapInArrow(pick, "a int, b int, n long").toArrow()
    out[found.column("a").to_numpy(), found.column("b").to_numpy()] = found.column("n").to_numpy()
    return out


def exchange(items: DataFrame, counts: np.ndarray, n: int, seeds: int = SEEDS, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of every item, 0 for those that never occur; ``counts`` are the items' tokens."""
    classes = np.full(len(counts), -1)
    first = np.argsort(-counts, kind="stable")[:seeds]
    first = first[counts[first] > 0]
    classes[first] = cluster_seeds(seed_pairs(items, first, len(counts)), n, sweeps)
    others = ~F.col("item").isin([int(i) for i in first])
    classes = moved(items, classes, class_pairs(items, classes, n), others)
    for half in list(range(2)) * sweeps:
        classes = moved(items, classes, class_pairs(items, classes, n), F.col("item") % 2 == half)
    return np.maximum(classes, 0)


@dataclass
class Model:
    lexicon: Lexicon
    classes: np.ndarray  # of every item
    pairs: np.ndarray  # class bigrams
    sizes: np.ndarray  # distinct words of each class, and one for each of its types
    tokens: int
    vocabulary: int
    words: DataFrame  # counts of the words beyond the dictionary

    def transitions(self) -> np.ndarray:
        """P(class | class before), by row."""
        n = len(self.pairs)
        share = (self.pairs.sum(axis=0) + 1) / (self.pairs.sum() + n)
        return (self.pairs + n * share) / (self.pairs.sum(axis=1, keepdims=True) + n)

    def spread(self) -> np.ndarray:
        """What an emission is divided by, per class."""
        return np.maximum(1, self.pairs.sum(axis=0) + self.sizes)


def train(
    docs: DataFrame, classes: int = CLASSES, core: int = CORE, dictionary: int = DICTIONARY, types: int = TYPES,
    seeds: int = SEEDS, sweeps: int = SWEEPS,
) -> Model:
    """The model of all rows of ``docs``."""
    texts = byte_texts(docs)
    ends = texts.count()
    words = stored(word_counts(texts), "word-counts")
    least = least_count(words, dictionary)
    known = sorted((-r["n"], bytes(r["word"])) for r in words.filter(F.col("n") >= least).collect())
    lexicon = Lexicon([w for _, w in known], [-n for n, _ in known], ends, core, types)
    beyond = words.filter(F.col("n") < least)
    rare = beyond.groupBy(_type_column("word", types).alias("type")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()

    counts = np.bincount(lexicon.item_of, lexicon.counts, lexicon.items).astype(np.int64)
    sizes = np.bincount(lexicon.item_of[:lexicon.size + 1], minlength=lexicon.items)
    for r in rare:
        counts[1 + lexicon.core + r["type"]] += r["n"]
        sizes[1 + lexicon.core + r["type"]] += r["words"]
    sizes[1 + lexicon.core:] += 1
    tokens, vocabulary = int(counts.sum()), lexicon.size + sum(r["words"] for r in rare) + (ends > 0)

    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    items = item_pairs(texts, sent, lexicon.items, counts * HOT > tokens)
    of_item = exchange(items, counts, classes, seeds, sweeps)
    # Types that never occurred go with the most frequent one.
    of_item[counts == 0] = of_item[1 + lexicon.core + int(np.argmax(counts[1 + lexicon.core:]))]
    return Model(lexicon, of_item, class_pairs(items, of_item, classes), np.bincount(of_item, sizes, classes), tokens, vocabulary, beyond)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every row."""
    own, total = model.lexicon, model.tokens + model.vocabulary + 1
    class_of = model.classes[own.item_of]
    base = np.log10((own.counts + 1) / total)
    if model.tokens:
        emission, step = np.log10((own.counts + 1) / model.spread()[class_of]), np.log10(model.transitions())
    else:
        emission, step = np.zeros(len(own.counts)), np.zeros_like(model.pairs)
    sent = docs.sparkSession.sparkContext.broadcast((own, class_of, base, emission, step, own.counts > 0))

    def run(batches):
        own, class_of, base, emission, step, known = sent.value
        for batch in batches:
            rows, rare, counts, edges = [], [], [], [0]
            for data in batch.column("data").to_pylist():
                words = byte_words(data, TOKENS)
                line = np.zeros(len(words) + 2, np.int64)  # an end before and after
                line[1:-1] = own.number(words)
                now, told = class_of[line], line[1:]
                rows.append((len(told), int(known[told].sum()), float(base[told].sum()), float(emission[told].sum() + step[now[:-1], now[1:]].sum())))
                beyond = Counter(words[i] for i in np.flatnonzero(line[1:-1] > own.size).tolist())
                rare += beyond
                counts += beyond.values()
                edges.append(len(rare))
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), v) for v in (pa.array(rare, pa.binary()), pa.array(counts, pa.int64()))]
            n, k, b, s = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(n, pa.int64()), pa.array(k, pa.int64()),
                 pa.array(b, pa.float64()), pa.array(s, pa.float64()), *lists],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare", "counts"])

    out = byte_texts(docs, is_held_out().alias("held_out")).mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, rare array<binary>, counts array<long>")
    out = stored(out.withColumn("_row", F.monotonically_increasing_id()), "partly-scored")
    # A word that is not found adds nothing: the logarithm of its count and one is 0.
    rare = (
        out.select("_row", F.explode(F.arrays_zip("rare", "counts")).alias("x")).select("_row", F.col("x.rare").alias("word"), F.col("x.counts").alias("times"))
        .join(model.words, "word").groupBy("_row")
        .agg(F.sum("times").alias("found"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")))
    more = F.coalesce("more", F.lit(0.0)) if model.tokens else F.lit(0.0)
    scored = out.drop("rare", "counts").join(rare, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(~is_held_out())
