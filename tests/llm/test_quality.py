"""Base counts and likelihood ratios against direct versions."""

import re
from math import log

from bazaarlens.llm import quality as Q
from bazaarlens.llm.common import table
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import MEDIUM, SMALL
from tests.llm import awkward

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def direct(text):
    text = text or ""
    words = WORD.findall(text)
    seen, n_dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            n_dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts(spark, docs):
    trusted = spark.createDataFrame([(6,), (6,), (None,), (99,)], "doc_id long")
    got = Q.judge(docs, trusted).collect()
    expected = sorted(str((r[0], *direct(r[1]))) for r in awkward.rows())
    assert sorted(str((r["doc_id"], *(r[c] for c in COLUMNS))) for r in got) == expected
    assert all(r["score"] is not None and not (r["kept"] and r["base_failed"]) for r in got)


def test_base_counts_of_the_test_data(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    for r in RUNNERS["op8_quality_rules"](spark, SMALL).collect():
        assert tuple(r[c] for c in COLUMNS) == direct(texts[r["doc_id"]])


def test_weights_are_smoothed_log_ratios(spark):
    rows = [(1, "a b"), (2, "a a c"), (3, None)]
    frame = awkward.table(spark, [(i, t, "en", "s", 1, "k", "r", 1) for i, t in rows])
    bins = 64
    weights = Q.log_ratios(frame, spark.createDataFrame([(1,)], "doc_id long"), bins)
    from pyspark.sql import functions as F

    own = {r["doc_id"]: r["b"] for r in frame.select("doc_id", Q.ngram_bins(Q.words(F.coalesce("text", F.lit(""))), bins).alias("b")).collect()}
    corpus = sum(own.values(), [])
    for b in range(bins):
        t, e = own[1].count(b), corpus.count(b) * len(own[1]) / len(corpus)
        assert abs(weights[b] - log((t + Q.SMOOTHING) / (e + Q.SMOOTHING))) < 1e-4


def test_labelled_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, MEDIUM, "labels").collect()}
    got = [(labels[r["doc_id"]], r["kept"], r["base_failed"]) for r in RUNNERS["op8_quality_rules"](spark, MEDIUM).collect() if r["doc_id"] in labels]
    good = [k for q, k, failed in got if q == 1 and not failed]
    bad = [k for q, k, _ in got if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.02 * len(bad)


def test_without_trusted_documents_or_rows(spark, docs, no_docs):
    nobody = spark.createDataFrame([], "doc_id long")
    assert {r["kept"] for r in Q.judge(docs, nobody).filter("not base_failed").collect()} == {True}
    assert Q.judge(no_docs, nobody).count() == 0
    kept = Q.keep_good(docs, nobody)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_no_python_and_no_shuffle_of_texts_in_the_plan(spark):
    text = RUNNERS["op8_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
