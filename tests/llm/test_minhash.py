"""Near-duplicate classes against all pairs."""

import random
from collections import Counter

import numpy as np

from bazaarlens.llm import minhash as M
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.components import connected
from bazaarlens.llm.queries import RUNNERS
from bazaarlens.llm.shingles import word_shingles
from tests.conftest import SMALL
from tests.llm import awkward


def direct(rows, threshold=M.THRESHOLD):
    """Class of every (id, text) by comparing all pairs that share a shingle."""
    df = np.zeros(M.DF_BINS, np.int64)
    for _, text in rows:
        df[np.unique(M.df_bin(word_shingles(text, M.SHINGLE)))] += 1
    idf = M.idf_table(df, len(rows))
    words = lambda t: " ".join((t or "").lower().split())
    node = {}
    for i, t in rows:
        if i is not None:
            node[words(t)] = min(i, node.get(words(t), i))
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    smallest, holders = {}, {}
    for i, t in rows:
        if i is not None:
            join(i, node[words(t)])
            smallest[i] = min(t or "", smallest.get(i, t or ""))
    shingles = {n: word_shingles(smallest[n], M.SHINGLE) for n in set(node.values())}
    for n, own in shingles.items():
        for s in set(own.tolist()):
            holders.setdefault(s, []).append(n)
    common = Counter((a, b) for h in holders.values() for a in h for b in h if a < b)
    for a, b in common:
        if root(a) != root(b) and M.similarity(shingles[a], shingles[b], idf) >= threshold:
            join(a, b)
    return sorted(str((i, None if i is None else root(i))) for i, _ in rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = RUNNERS["op1_minhash_near_dedup"](spark, SMALL).collect()
    assert sorted(str(tuple(r)) for r in got) == direct(rows)


def test_awkward_rows(spark, docs, no_docs):
    ship_package(spark)
    rows = [(r[0], r[1]) for r in awkward.rows()]
    assert sorted(str(tuple(r)) for r in M.near_classes(docs).collect()) == direct(rows)
    kept = M.one_per_class(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, c in (eval(x) for x in direct(rows)) if i is None or i == c}
    assert M.near_classes(no_docs).count() == 0


def test_group_of_ever_more_edited_copies(spark):
    """Copies around the threshold, of which most pairs are not similar."""
    ship_package(spark)
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rnd.sample(range(200), rnd.randint(0, 14)):
            w[at] = word()
        rows.append((i, " ".join(w)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got, want = M.near_classes(frame).collect(), direct(rows)
    wrong = len(set(str(tuple(r)) for r in got) ^ set(want)) // 2
    assert len(set(want)) > 1 and wrong <= 1  # a pair at the threshold is a candidate with probability 0.996


def test_samples_agree_as_often_as_texts_do():
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    changed = words[:]
    changed[1000:1150] = words[:150]
    idf = M.idf_table(np.zeros(M.DF_BINS, np.int64), 1000)
    a, b = (word_shingles(" ".join(w), 5) for w in (words, changed))
    s = M.similarity(a, b, idf)
    equal = np.mean(M.band_keys(*M.weighted(a, idf)) == M.band_keys(*M.weighted(b, idf)))
    assert 0.85 < s < 0.97 and abs(equal - s**M.ROWS) < 0.35


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r["node"]: r["class_id"] for r in connected(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
