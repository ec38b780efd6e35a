"""Importance resampling against a direct version."""

import hashlib
import re
from collections import Counter
from math import floor, log
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import importance, regular_sort
from bazaarlens.llm.common import table
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import MEDIUM
from tests.llm import awkward

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))


def direct(docs, target, longest=1, buckets=10_000, percent=10):
    """Rows (doc_id, n_features, weight, score, rank) of (doc_id, text) pairs."""
    def features(text):
        w = words(text)
        return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: crc32(f.encode("utf-8", "surrogatepass")) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text)) for texts in ([x for _, x in docs], target))
    size_s, size_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        own = features(text)
        weight = sum(floor(1000 * log((t[b] + 1) * (size_s + buckets) / ((s[b] + 1) * (size_t + buckets)))) for b in map(bucket, own))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(own), weight, weight + floor(-1000 * log(-log((h + 0.5) / 4294967296))), None, len(words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_awkward_rows(spark, docs, no_docs):
    target = ["wir sind hier", None, "the one two", ""]
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, rank int")
    texts = [(r[0], r[1]) for r in awkward.rows()]
    for longest, percent in ((1, 50), (3, 50), (2, 100)):
        got = importance.resample(docs, bench, longest=longest, percent=percent)
        assert result(got) == direct(texts, target, longest, percent=percent)
    assert importance.resample(no_docs, bench).count() == 0
    assert result(importance.resample(docs, bench.limit(0))) == direct(texts, [])


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(regular_sort, "ROWS_A_PART", 60)  # many parts
    docs = [tuple(r) for r in table(spark, MEDIUM, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in table(spark, MEDIUM, "benchmark").collect()]
    assert result(RUNNERS["op11_importance_resampling"](spark, MEDIUM)) == direct(docs, target)


@pytest.mark.parametrize("rows,parts", [(0, 1), (1, 3), (500, 7)])
def test_ranks_with_ties(spark, monkeypatch, rows, parts):
    """A third of the rows share one key."""
    monkeypatch.setattr(regular_sort, "ROWS_A_PART", max(1, rows // parts))
    frame = spark.range(rows).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 101).cast("long").alias("k")).repartition(5)
    values = sorted(r["k"] for r in frame.collect())
    for wanted in (0, rows // 3, rows):
        got = [tuple(r) for r in regular_sort.first_ranks(frame, ["k"], wanted, rows).collect()]
        assert sorted(r[0] for r in got) == values
        assert [k for _, k in sorted((r[1], r[0]) for r in got if r[1])] == values[:wanted]
        assert sorted(r[1] for r in got if r[1]) == list(range(1, wanted + 1))


def test_parts_stay_even_on_equal_keys(spark):
    frame = spark.range(4000).select(F.lit(5).cast("long").alias("k")).repartition(8)
    runs = regular_sort.cut_runs(frame, ["k"], 8)
    dealt = regular_sort.deal(runs, ["k"], regular_sort.splitters(runs, ["k"], 8))
    counts = [r["count"] for r in dealt.groupBy("_part").count().collect()]
    assert len(counts) == 8 and max(counts) <= 2 * 4000 / 8
