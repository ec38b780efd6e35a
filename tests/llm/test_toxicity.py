"""Held-out accuracy on planted insults, and the rules for awkward rows."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from bazaarlens.llm import toxicity as X
from bazaarlens.llm.common import ship_package, table
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL
from tests.llm import awkward

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    ship_package(spark)
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(800)]
    rows, labels = [], []
    for i in range(1200):
        text = [rnd.choice(words) for _ in range(rnd.randint(30, 200))]
        if i % 5 == 0:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(["idiotic", "worthless", "pathetic"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.score(docs, X.train(docs, marks)).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held]
    assert np.mean(right) > 0.97


def test_sample_is_bounded_and_outside_the_fold(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    sample = X.training_sample(labels, 20, 30).collect()
    assert len(sample) == 50 and not any(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in sample)
    assert sample == X.training_sample(labels, 20, 30).collect()


def test_awkward_rows(spark, docs, no_docs):
    ship_package(spark)
    labels = spark.createDataFrame([(6, 1), (10, 0), (11, 0), (None, 1)], "doc_id long, toxic int")
    got = X.score(docs, X.train(docs, labels)).collect()
    assert len(got) == len(awkward.rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= X.TOXIC_FROM) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1, 2, 3)}) == 1
    nobody = labels.limit(0)
    assert {r["predicted"] for r in X.score(docs, X.train(docs, nobody)).collect()} == {0}
    assert X.score(no_docs, X.train(no_docs, labels)).count() == 0


def test_chunks_do_not_change_the_features(monkeypatch):
    text = next(r[1] for r in awkward.rows() if r[1] and len(r[1]) > 50_000)
    whole = X.features(text)
    monkeypatch.setattr(X, "CHUNK", 1000)
    assert all((a == b).all() for a, b in zip(X.features(text), whole))


def test_features_are_word_beginnings():
    """Equal beginnings share bins, whatever follows; a word under three characters has none."""
    of = lambda t: set(X.features(t)[0].tolist())
    assert of("") == of(" a an ") == set()
    assert len(of("stupid")) == 4 and len(of("stu")) == 1 and of("stu") < of("STUPID") == of("stupidest")
    assert not of("stupid") & of("xstupid")
    assert X.features("abc abd abc")[1].sum() == 3 and X.features("abc abc")[1].tolist() == [2]


def test_texts_without_blanks_are_read_to_their_end(monkeypatch):
    """The end of a long run counts as well as its beginning, wherever a chunk ends."""
    of = lambda t: set(X.features(t)[0].tolist())
    neutral = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed\u6563\u6b65\u5427" * 4
    insult = "\u4f60\u662f\u4e2a\u767d\u75f4"
    assert of(neutral + insult) - of(neutral) and of(insult) <= of(neutral + insult)
    assert of("stupid") <= of("x" * 40 + "stupid") and of("stupid") == of("stupidest")
    text = ("a" * X.LONG + "b ") * 9 + ("cd" * X.LONG + " ef ") * 9 + neutral + insult
    whole = X.features(text)
    for chunk in (1, 5, X.LONG, X.LONG + 1, 50):
        monkeypatch.setattr(X, "CHUNK", chunk)
        assert all(np.array_equal(a, b) for a, b in zip(X.features(text), whole))


def test_a_toxic_end_without_blanks_is_seen(spark):
    ship_package(spark)
    rnd = random.Random(4)
    run = lambda: "".join(chr(0x4E00 + rnd.randrange(300)) for _ in range(60))
    rows = [(i, run() + ("\u9fa0\u9fa1\u9fa2\u9fa3" if i % 2 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = X.train(docs, spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int"))
    held = [r for r in X.score(docs, model).collect() if r["held_out"]]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.95


def test_every_character_of_a_text_counts(monkeypatch):
    """Another character anywhere gives other n-grams, in words of any length; so does one that goes."""
    of = lambda t: dict(zip(*(x.tolist() for x in X.whole_features([t])[0])))
    rnd = random.Random(8)
    for n in range(1, 40):
        word = "".join(rnd.choice("abcdefgh") for _ in range(n))
        for k in range(n):
            assert of(f"und {word} so") != of(f"und {word[:k]}x{word[k + 1:]} so")
            assert of(f"und {word} so") != of(f"und {word[:k]}{word[k + 1:]} so")
    assert of("") == of(" \n") == {} and of("ein vollidiot") != of("ein vollendet")


def test_many_texts_at_once_and_chunks(monkeypatch):
    """Texts read together, or in chunks, have the n-grams they have alone."""
    texts = [r[1] or "" for r in awkward.rows()] + ["", "\u4eca" * 70, "x", "vollidiotische menschenverachtende"]
    alone = [X.whole_features([t])[0] for t in texts]
    same = lambda got: all(np.array_equal(a, b) for f, g in zip(got, alone, strict=True) for a, b in zip(f, g))
    assert same([f for bunch in X.bunches(texts) for f in X.whole_features(bunch)])
    monkeypatch.setattr(X, "CHUNK", 1000)
    assert same(X.whole_features(texts)) and same([f for bunch in X.bunches(texts) for f in X.whole_features(bunch)])
    short = [t[:90] for t in texts]
    alone = [X.whole_features([t])[0] for t in short]
    for chunk in (1, 7, X.LONG, 50):
        monkeypatch.setattr(X, "CHUNK", chunk)
        assert same(X.whole_features(short))
    assert all(np.array_equal(a, b) for f in alone for a, b in zip(X._unpacked(X._packed(f)), f))


def test_all_labels_are_learned(spark):
    """No bound on the documents of either class; every text under an id counts."""
    ship_package(spark)
    labels = spark.range(8000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    outside = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sorted(r["doc_id"] for r in X.training_sample(labels).collect()) == outside
    assert X.training_sample(labels, 10).count() == 10 + sum(i % 2 == 0 for i in outside)
    a, b = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:2]
    docs = spark.createDataFrame([(a, "good"), (a, "nice"), (a, "nice"), (b, "nasty"), (b, "wretch")], "doc_id long, text string")
    ratio, _, _ = X.train(docs, spark.createDataFrame([(a, 0), (b, 1)], "doc_id long, toxic int"))
    plain, _, _ = X.fit(X.whole_features(["good", "nice", "nasty", "wretch"]), np.array([0, 0, 1, 1.0]))
    assert np.array_equal(ratio, plain)


def labelled(n, odd):
    """Ids outside the fold and texts, every ``odd``-th toxic by one of forty marks."""
    rnd = random.Random(odd)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    ids = [i for i in range(2 * n) if zlib.crc32(str(i).encode()) % 4 != 2][:n]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(25)) + (f" {'klmnopqr'[k % 8]}{'stuvw'[k % 5]}zzz" if k % odd == 0 else "")
    return [(i, text(k), int(k % odd == 0)) for k, i in enumerate(ids)]


def test_shards_together_see_every_row(spark, monkeypatch):
    """The ratios are those of one fit over all rows, the coefficients the mean of the shards'."""
    ship_package(spark)
    rows = labelled(600, 4)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    found, toxic = X.whole_features([r[1] for r in rows]), np.array([float(r[2]) for r in rows])
    whole = X.fit(found, toxic)
    one = X.train(docs, marks)
    assert np.array_equal(one[0], whole[0]) and np.allclose(one[1], whole[1], atol=1e-6) and abs(one[2] - whole[2]) < 1e-6
    monkeypatch.setattr(X, "SHARD", 150)
    several = X.train(docs.repartition(3), marks)
    assert np.array_equal(several[0], whole[0])
    deal = docs.join(marks, "doc_id").select("toxic", "text", F.xxhash64("doc_id", "text").alias("deal"))
    dealt = X.dealt(deal, 150, 450, 4).collect()
    assert sorted(r["text"] for r in dealt) == sorted(r[1] for r in rows)
    means, odds = np.zeros(X.FEATURES), 150 / 450
    for shard in range(4):
        part = sorted((r["toxic"], r["text"]) for r in dealt if r["shard"] == shard)
        n = sum(k for k, _ in part)
        weight = X.TOXIC_WEIGHT * odds / (n / (len(part) - n))
        means += X.fit(X.whole_features([t for _, t in part]), np.array([float(k) for k, _ in part]), whole[0], weight)[1] / 4
    assert np.allclose(several[1], means, atol=1e-5)
    assert all(np.array_equal(a, b) for a, b in zip(several, X.train(docs, marks)))


def test_a_rare_class_is_in_every_shard(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(X, "SHARD", 60)
    rows = [(i, f"{t} {i} {'horrid' if i % 60 == 0 else ''}", int(i % 60 == 0)) for i, t, _ in labelled(900, 7)]
    n = sum(r[2] for r in rows)
    frame = spark.createDataFrame([(r[2], r[0]) for r in rows], "toxic int, deal long")
    dealt = X.dealt(frame, n, len(rows) - n, 15).groupBy("shard", "toxic").count().collect()
    assert {r["shard"] for r in dealt} == set(range(15)) and [r["count"] for r in dealt if r["toxic"]] == [n] * 15
    assert sum(r["count"] for r in dealt if not r["toxic"]) == len(rows) - n
    docs = spark.createDataFrame([r[:2] for r in rows] + [(i, "plain horrid text" if i % 2 else "plain text") for i in range(5000, 5100)], "doc_id long, text string")
    got = X.score(docs, X.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"))).collect()
    high, low = ([r["score"] for r in got if r["doc_id"] >= 5000 and r["doc_id"] % 2 == k] for k in (1, 0))
    assert min(high) > max(low)


def test_joined_by_a_shuffle(spark, monkeypatch):
    ship_package(spark)
    rows = labelled(300, 3)
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "no id")], "doc_id long, text string")
    marks = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1)], "doc_id long, toxic int")
    model = X.train(docs, marks)
    monkeypatch.setattr(X, "BROADCAST_IDS", 0)
    assert all(np.array_equal(a, b) for a, b in zip(model, X.train(docs, marks)))


def test_fit_is_the_plain_regression(monkeypatch):
    """Against dense matrices."""
    monkeypatch.setattr(X, "FEATURES", 12)
    monkeypatch.setattr(X, "STEPS", 40)
    rnd = np.random.default_rng(3)
    counts = rnd.integers(0, 4, (30, 12)) * (rnd.random((30, 12)) < 0.5)
    toxic = (rnd.random(30) < 0.3).astype(float)
    found = [(np.flatnonzero(c).astype(np.int32), c[c > 0].astype(np.int32)) for c in counts]
    ratio, w, b = X.fit(found, toxic)
    amount = np.log1p(counts)
    shares = [(X.ALPHA + amount[toxic == k].sum(axis=0)) for k in (1, 0)]
    plain = np.log((shares[0] / shares[0].sum()) / (shares[1] / shares[1].sum()))
    assert np.allclose(ratio, plain, atol=1e-5)
    x = amount * ratio
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    weight = np.where(toxic == 1, X.TOXIC_WEIGHT, 1.0)
    weight = weight / weight.sum()
    v, c, gv, gc = np.zeros(12), 0.0, np.full(12, 1e-8), 1e-8
    for _ in range(40):
        error = (X.sigmoid(x @ v + c) - toxic) * weight
        g = x.T @ error + X.DECAY * v
        gv, gc = gv + g * g, gc + error.sum() ** 2
        v, c = v - X.RATE * g / np.sqrt(gv), c - X.RATE * error.sum() / np.sqrt(gc)
    assert np.allclose(w, v, atol=1e-4) and abs(b - c) < 1e-6
    assert np.allclose([X.score_of(f, (ratio, w, b)) for f in found], X.sigmoid(x @ v + c), atol=1e-4)


def test_contradicting_labels(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(i, "good words only" if i % 2 else "nasty words only") for i in range(40)], "doc_id long, text string")
    clean = [(i, 1 - i % 2) for i in range(40)]
    model = X.train(docs, spark.createDataFrame(clean, "doc_id long, toxic int"))
    again = X.train(docs, spark.createDataFrame([*clean, *((i, 0) for i in range(40))], "doc_id long, toxic int"))
    assert all(np.array_equal(a, b) for a, b in zip(model, again))


def test_held_out_labels(spark):
    """Nine of ten toxic documents of the held out fold, at most one in fifty of the others; every language."""
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, LARGE, "labels").collect()}
    langs = {r["doc_id"]: r["lang"] for r in table(spark, LARGE, "documents").select("doc_id", "lang").collect()}
    got = [r for r in RUNNERS["op10_toxicity"](spark, LARGE).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    rate = lambda rows: sum(r["predicted"] for r in rows) / len(rows)
    toxic, other = ([r for r in got if labels[r["doc_id"]] == k] for k in (1, 0))
    assert rate(toxic) >= 0.9 and rate(other) <= 0.02
    assert all(rate([r for r in toxic if langs[r["doc_id"]] == lang]) >= 0.85 for lang in set(langs.values()))


def test_runs_on_the_test_data(spark):
    got = RUNNERS["op10_toxicity"](spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 200
