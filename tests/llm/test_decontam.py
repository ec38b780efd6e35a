"""Seeds and alignments against plain versions."""

import random

import numpy as np
import pytest

from bazaarlens.llm import decontam as D
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL
from tests.llm import awkward


def plain_score(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, above[j - 1] + (D.MATCH if x == y else D.MISMATCH), above[j] + D.GAP, row[-1] + D.GAP))
            best = max(best, row[-1])
        above = row
    return best


def test_alignment_score():
    rnd = random.Random(1)
    for _ in range(200):
        item = np.array([rnd.randint(1, 5) for _ in range(rnd.randint(1, 12))])
        texts = [np.array([rnd.randint(0, 5) for _ in range(rnd.randint(1, 20))]) for _ in range(4)]
        scores, ends = D.align(item, texts)
        for t, s, e in zip(texts, scores, ends):
            assert s == plain_score(item, t) and (s == 0 or plain_score(item, t[:e + 1]) == s)


@pytest.fixture(scope="module")
def case(spark):
    ship_package(spark)
    rnd = random.Random(6)
    vocabulary = ["".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(2000)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(prose(30 + i))) for i in range(12)]
    docs, planted = [], set()
    for i in range(80):
        words = prose(200)
        if i % 4 == 0:
            item = items[i % 12]
            leak = item[1].split(" ")
            for _ in range(i % 3 * 2):  # edits, a missing and an added word
                leak[rnd.randrange(len(leak))] = "edited"
            del leak[5]
            leak.insert(11, "added")
            words[50:50] = " ".join(leak).upper().split(" ")
            planted.add((i, item[0]))
        docs.append((i, " , ".join(words)))
    return docs, items, planted


def frames(spark, case):
    docs, items, _ = case
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


@pytest.mark.parametrize("most_bits", [D.MOST_BITS, 64])
def test_planted_and_edited_items(spark, case, most_bits):
    docs, benchmark = frames(spark, case)
    got = D.leaks(docs, benchmark, most_bits=most_bits).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == case[2]
    texts, items = dict(case[0]), dict(case[1])
    for r in got:
        a, words = D.words_of(items[r["item_id"]]), D.words_of(texts[r["doc_id"]])
        assert r["similarity"] == round(plain_score(a, words) / (D.MATCH * len(a)), 6)
        assert plain_score(a, words[r["start_word"]:r["end_word"]]) == plain_score(a, words)


def test_item_in_every_document_keeps_its_seeds(spark, case):
    _, benchmark = frames(spark, case)
    rows = [(i, f"start {case[1][0][1]} end {i}") for i in range(50)]
    got = D.leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, 0) for i in range(50)}


def test_one_heavily_edited_copy_against_plain_alignment(spark):
    """Every document holds at most one copy of an item, and no other document holds its seeds."""
    ship_package(spark)
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    prose = lambda n: [word() for _ in range(n)]
    items, docs = [(i, " ".join(prose(40))) for i in range(9)], []
    for i, text in items:
        w = text.split(" ")
        if i < 3:  # every fifth word replaced
            w = [word() if k % 5 == 4 else x for k, x in enumerate(w)]
        elif i < 5:  # words inserted after every third one
            w = [y for k, x in enumerate(w) for y in ([x] + prose(2) if k % 3 == 2 else [x])]
        elif i < 7:  # one seed is left, and other documents hold it
            w = [word() if k > 2 and k % 4 == 3 else x for k, x in enumerate(w)]
            docs += [(100 * i + k, " ".join(prose(50) + w[:3] + prose(50))) for k in range(30)]
        else:  # all words inserted in one place
            w = w[:20] + prose(36) + w[20:]
        docs.append((i, " ".join(prose(60) + w + prose(60))))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    plain = {(d, i): plain_score(t.split(" "), u.split(" ")) / (D.MATCH * 40) for d, u in docs for i, t in items if d == i or d // 100 == i}
    assert got == {k: round(s, 6) for k, s in plain.items() if s >= D.THRESHOLD} and len(got) == 9


def test_whole_words_of_the_test_data(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    flat = lambda t: f" {' '.join(D.words_of(t))} "
    exact = {(d["doc_id"], b["item_id"]) for d in rows for b in items if flat(b["text"]) in flat(d["text"])}
    got = {(r["doc_id"], r["item_id"]) for r in RUNNERS["op5_benchmark_decontamination"](spark, SMALL).collect()}
    assert exact and exact <= got


def test_awkward_rows_and_items(spark, docs, no_docs):
    base = next(r[1] for r in awkward.rows() if r[0] == 6)
    benchmark = spark.createDataFrame([(1, base), (1, base), (2, None), (3, "too short"), (None, base)], "item_id long, text string")
    got = D.leaks(docs, benchmark).collect()
    assert {6, 7, 9, None} <= {r["doc_id"] for r in got} <= {6, 7, 8, 9, None} and {r["item_id"] for r in got} == {1}
    clean = D.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} & {6} == set()
    assert D.leaks(no_docs, benchmark).count() == 0 and D.leaks(docs, benchmark.limit(0)).count() == 0
    assert D.without_leaks(docs, benchmark.limit(0)).count() == docs.count()


def test_items_without_an_id_and_short_items(spark):
    ship_package(spark)
    text = " ".join(f"word{k}" for k in range(20))
    benchmark = spark.createDataFrame(
        [(None, text), (2**60 + 1, "Zebra stripes"), (3, "quokka"), (4, ""), (5, None), (6, "three small words")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"start {text} end"), (2, "the zebra, stripes and all"), (3, "a Quokka"), (4, "zebra and stripes"), (5, "three small words")],
        "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["similarity"]) for r in D.leaks(docs, benchmark).collect()}
    assert got == {(1, None, 1.0), (2, 2**60 + 1, 1.0), (3, 3, 1.0), (5, 6, 1.0)}
    assert {r["doc_id"] for r in D.without_leaks(docs, benchmark).collect()} == {4}


def edited(rnd, words, other):
    """A copy with edits of one kind: spread evenly, or anywhere."""
    w, step = list(words), rnd.randint(2, 5)
    kind = rnd.randrange(4)
    if kind == 0:
        return [y for k, x in enumerate(w) for y in ([x, other()] if k % step == step - 1 else [x])]
    if kind == 1:
        return [other() if k % step == step - 1 else x for k, x in enumerate(w)]
    if kind == 2:
        return [x for k, x in enumerate(w) if k % step]
    for _ in range(rnd.randint(0, len(w) // 2)):
        k = rnd.randrange(len(w))
        w[k:k + rnd.randint(0, 2)] = [other() for _ in range(rnd.randint(0, 2))]
        w = w or [other()]
    return w


def test_no_alignment_of_the_threshold_avoids_the_seeds():
    rnd = random.Random(3)
    for _ in range(400):
        vocabulary = rnd.choice([3, 8, 500])
        word = lambda: rnd.randint(1, vocabulary)
        item = np.array([word() for _ in range(rnd.randint(4, 40))], np.int64)
        codes, places, spans = D.pairs_at(item, False)
        weight = dict.fromkeys(codes.tolist(), 0) | {c: rnd.randint(0, 9) for c in codes.tolist()}
        weights = np.array([weight[c] for c in codes.tolist()])
        marked = D.choose(len(item), places, spans, codes, weights, 0.5)
        text = np.array([word() for _ in range(9)] + edited(rnd, item.tolist(), word) + [word() for _ in range(9)], np.int64)
        if plain_score(item, text) >= len(item):
            assert np.isin(D.pairs_at(text, False)[0], codes[marked]).any()


def test_edited_copies_against_plain_alignment(spark):
    """Every link of the threshold, with its similarity, among items and texts of few words."""
    ship_package(spark)
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randint(1, 60)}"
    items = [(i, " ".join(word() for _ in range(rnd.randint(4, 40)))) for i in range(40)]
    docs = []
    for d in range(200):
        copy = edited(rnd, rnd.choice(items)[1].split(), word)
        docs.append((d, " ".join([word() for _ in range(rnd.randint(0, 30))] + copy + [word() for _ in range(rnd.randint(0, 30))])))
    plain = {(d, i): plain_score(u.split(), t.split()) / (D.MATCH * len(u.split())) for d, t in docs for i, u in items}
    want = {k: round(s, 6) for k, s in plain.items() if s >= D.THRESHOLD}
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 100 and got == want


def test_a_word_after_every_second_one_and_seven_words(spark):
    ship_package(spark)
    long, short = [f"long{k}" for k in range(40)], [f"short{k}" for k in range(7)]
    spread = [y for k, x in enumerate(long) for y in ([x, f"new{k}"] if k % 2 else [x])]
    holes = [*short[:2], "other", *short[3:5], "another", short[6]]
    docs = [(1, " ".join(["before", *spread, "after"])), (2, " ".join(["before", *holes, "after"])), (3, "short1 and then long7 long9")]
    benchmark = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(short))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()}
    assert got == {(1, 1): round(plain_score(long, spread) / 80, 6), (2, 2): round(plain_score(short, holes) / 14, 6)}


def test_repeated_rows_are_reported_each(spark):
    ship_package(spark)
    text = " ".join(f"word{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"{text} x {text}")] * 3 + [(None, text)] * 2, "doc_id long, text string")
    got = D.leaks(docs, spark.createDataFrame([(5, text)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["start_word"], r["end_word"]) for r in got) == [(0, 0, 20)] * 2 + [(1, 0, 20)] * 3


def test_recall_on_every_hundredth_document(spark):
    """All links of ids divisible by 100 that plain alignment finds, whole texts."""
    rows = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r["doc_id"] % 100 == 0]
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]) for r in RUNNERS["op5_benchmark_decontamination"](spark, SMALL).collect()}
    texts = [(r["doc_id"], D.numbers(r["text"])) for r in rows]
    want = set()
    for item in items:
        ids = D.numbers(item["text"])
        scores, _ = D.align(ids, [t if len(t) else np.zeros(1, np.int64) for _, t in texts])
        want |= {(d, item["item_id"]) for (d, _), s in zip(texts, scores) if s >= len(ids)}
    assert want == {(d, i) for d, i in got if d % 100 == 0}
