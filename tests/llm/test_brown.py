"""The class model against direct versions: counts, clustering steps, probabilities, scores."""

import re
from collections import Counter
from math import log, log10
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import brown
from bazaarlens.llm.common import table
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import MEDIUM, SMALL
from tests.llm import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = b""


def tokens(text):
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall((text or "").translate(LOWER))]


def held_out(doc_id):
    return crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def direct_base(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of (doc_id, text) pairs."""
    counts = Counter(t for i, text in docs if not held_out(i) for t in [*tokens(text), END])
    total = sum(counts.values())
    out = []
    for i, text in docs:
        own = [*tokens(text), END]
        base = sum(log10((counts[t] + 1) / (total + len(counts) + 1)) for t in own)
        out.append((i, held_out(i), len(own), sum(counts[t] > 0 for t in own), total, base))
    return out


def same(got, expected):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 6))
    got, expected = sorted(got, key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert all(abs(a[5] - b[5]) <= 1e-9 * max(1, abs(b[5])) for a, b in zip(got, expected))


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]


def direct_score(model, counts, text):
    """Log probability of a text under the model's classes, from a dictionary of word counts."""
    lexicon, core = model.lexicon, model.lexicon.core
    rank = {w: i + 1 for i, w in enumerate(lexicon.words[:core])}
    item = lambda w: 0 if w == END else rank.get(w) or 1 + core + brown.word_type(w, lexicon.types)
    step, spread = model.transitions(), model.spread()
    now, total = model.classes[0], 0.0
    for w in [*tokens(text), END]:
        c = model.classes[item(w)]
        total += log10(step[now, c]) + log10((counts[w] + 1) / spread[c])
        now = c
    return total


@pytest.mark.parametrize("size", [{}, {"dictionary": 12, "core": 6, "classes": 4, "types": 3, "seeds": 5}])
def test_awkward_rows(spark, docs, monkeypatch, size):
    monkeypatch.setattr(brown, "HELD_TOKENS", 500)
    monkeypatch.setattr(brown, "HELD_WORDS", 100)
    pairs = [(r[0], r[1]) for r in awkward.rows()]
    model = brown.train(brown.training_rows(docs), **size)
    got = brown.score(docs, model).collect()
    same([tuple(r[c] for c in COLUMNS) for r in got], direct_base(pairs))
    counts = Counter(t for i, text in pairs if not held_out(i) for t in [*tokens(text), END])
    assert np.allclose(sorted(r["score"] for r in got), sorted(direct_score(model, counts, t) for _, t in pairs), rtol=1e-9)
    assert all(r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in got)
    # Bigrams of classes, counted directly.
    lexicon = model.lexicon
    rank = {w: i + 1 for i, w in enumerate(lexicon.words[:lexicon.core])}
    expected = np.zeros_like(model.pairs)
    for i, text in pairs:
        if not held_out(i):
            line = [0, *(rank.get(w) or 1 + lexicon.core + brown.word_type(w, lexicon.types) for w in tokens(text)), 0]
            for a, b in zip(line, line[1:]):
                expected[model.classes[a], model.classes[b]] += 1
    assert (model.pairs == expected).all()
    # Transitions, and the emissions of each class with one unseen word per type, are distributions.
    assert np.allclose(model.transitions().sum(axis=1), 1)
    mass = np.zeros(len(model.sizes))
    for w in counts:
        item = 0 if w == END else rank.get(w) or 1 + lexicon.core + brown.word_type(w, lexicon.types)
        mass[model.classes[item]] += counts[w] + 1
    for t in range(lexicon.types):
        mass[model.classes[1 + lexicon.core + t]] += 1
    assert np.allclose(mass[mass > 0] / model.spread()[mass > 0], 1)


def test_empty_tables(spark, docs, no_docs):
    assert brown.score(no_docs, brown.train(no_docs)).count() == 0
    blank = brown.score(docs, brown.train(no_docs)).collect()
    assert len(blank) == docs.count() and {(r["score"], r["n_known"], r["train_tokens"]) for r in blank} == {(0.0, 0, 0)}


def likelihood(sequence, classes, n):
    table = np.zeros((n, n))
    for a, b in zip(sequence, sequence[1:]):
        if classes[a] >= 0 and classes[b] >= 0:
            table[classes[a], classes[b]] += 1
    x = lambda t: sum(v * log(v) for v in np.ravel(t) if v)
    return x(table) - x(table.sum(axis=0)) - x(table.sum(axis=1)), table


@pytest.mark.parametrize("now", [-1, 2])
def test_best_class_is_that_of_the_highest_likelihood(now):
    rnd = np.random.default_rng(4)
    sequence = rnd.integers(0, 12, 600).tolist()
    for item in range(12):
        classes = rnd.integers(0, 4, 12)
        classes[item] = now
        _, table = likelihood(sequence, classes, 4)
        pairs = Counter(zip(sequence, sequence[1:]))
        others = [(o * 2 + 1, n) for (a, o), n in pairs.items() if a == item] + [(a * 2, n) for (a, o), n in pairs.items() if o == item]
        own = brown.class_vectors(item, np.array([o for o, _ in others]), np.array([n for _, n in others]), classes, 4)
        found = brown.best_class(table, *own, now)
        values = []
        for c in range(4):
            classes[item] = c
            values.append(likelihood(sequence, classes, 4)[0])
        assert values[found] == pytest.approx(max(values))


def test_clusters_follow_the_contexts(spark):
    """Articles, nouns and verbs of an invented grammar."""
    rnd = np.random.default_rng(1)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "anv"]
    texts = [" ".join(str(rnd.choice(kinds[j % 3])) for j in range(60)) for _ in range(120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    model = brown.train(frame, classes=4, types=2)
    of = {w: model.classes[i + 1] for i, w in enumerate(model.lexicon.words)}
    found = [{of[w.encode()] for w in words} for words in kinds]
    assert [len(f) for f in found] == [1, 1, 1] and len(set.union(*found)) == 3


def test_hot_items_are_merged_whole(spark, monkeypatch):
    frame = spark.createDataFrame([(i, "the " * 30 + f"w{i % 5} the cat") for i in range(200)], "doc_id long, text string").repartition(6)
    plain = brown.train(frame, classes=3).pairs.sum()
    monkeypatch.setattr(brown, "HOT", 0)  # no item is hot
    assert plain == brown.train(frame, classes=3).pairs.sum() == 200 * 34


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    same([tuple(r[c] for c in COLUMNS) for r in RUNNERS["op12_lm_scoring"](spark, SMALL).collect()], direct_base(rows))


def test_held_out_texts_are_likelier_than_under_single_words(spark):
    r = RUNNERS["op12_lm_scoring"](spark, MEDIUM).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert 10 ** (-r["s"] / r["n"]) < 0.7 * 10 ** (-r["b"] / r["n"])
