"""Repeated strings against a table of all strings of that length."""

import hashlib
import random
from collections import Counter

import numpy as np

from bazaarlens.llm import passages
from bazaarlens.llm import suffix_repeats as R
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL
from tests.llm import awkward


def direct(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    grams = [[hashlib.blake2b(t[k:k + 400], digest_size=12).digest() for k in range(len(t) - 399)] for _, t in texts]
    for own in grams:
        for g in own:
            seen[g] = seen.get(g, 0) + 1
    out = []
    for (i, t), own in zip(texts, grams):
        spans = R.merged([(k, k + 400) for k, g in enumerate(own) if seen[g] > 1])
        edges = [0, *(x for s in spans for x in s), len(t)]
        kept = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out.append((i, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def direct_passages(rows):
    """(id, maximal runs, words) of what lies in runs of 51 words that another row holds."""
    texts = [(i, (t or "").encode().split(), t or "") for i, t in rows]
    copies, holders = Counter(t for _, _, t in texts), {}
    for _, w, t in texts:
        for k in range(len(w) - 50):
            holders.setdefault(b" ".join(w[k:k + 51]), set()).add(t)
    out = []
    for i, w, t in texts:
        spans = R.merged([(k, k + 51) for k in range(len(w) - 50) if copies[t] > 1 or len(holders[b" ".join(w[k:k + 51])]) > 1])
        out.append((i, len(spans), sum(b - a for a, b in spans)))
    return sorted(map(str, out))


def passages_of(rows):
    return sorted(str((r["doc_id"], r["n_passages"], r["n_passage_words"])) for r in rows)


def found(df):
    return sorted(str((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()))
                  for r in R.without_repeats(df).collect())


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = RUNNERS["op3_suffix_array_dedup"](spark, SMALL).collect()
    assert sorted(str(tuple(r)[:5]) for r in got) == direct(rows)
    assert passages_of(got) == direct_passages(rows)


def test_awkward_rows(spark, docs, no_docs):
    ship_package(spark)
    assert found(docs) == direct([(r[0], r[1]) for r in awkward.rows()])
    assert passages_of(R.without_repeats(docs).collect()) == direct_passages([(r[0], r[1]) for r in awkward.rows()])
    assert R.without_repeats(no_docs).count() == 0


def rows_with_common_passages():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    base, passage, rows = prose(300), prose(90), []
    for i in range(120):
        w = base.split(" ")
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, [" ".join(w), prose(40) + passage + prose(40), "ab" * rnd.randint(150, 700),
                         passage[rnd.randint(0, 60):] + prose(70)][i % 4]))
    return rows


def test_crowded_buckets_give_the_same_result(spark, monkeypatch):
    ship_package(spark)
    rows = rows_with_common_passages()
    frame, want = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), direct(rows)
    for limit in (3, 10**6):
        monkeypatch.setattr(R, "MAX_SEGMENTS", limit)
        assert found(frame) == want


def test_groups_hold_all_occurrences(spark):
    ship_package(spark)
    rows = rows_with_common_passages()[:40]
    texts = {i: t.encode() for i, t in rows}
    members = {}
    for r in R.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        content = texts[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(content) == r["length"] >= 400
        members.setdefault((r["repeat"], content), set()).add((r["doc_id"], r["start"]))
    assert len(members) == len({name for name, _ in members})  # one string per name
    for (_, content), places in members.items():
        everywhere = {(i, k) for i, t in texts.items() for k in range(len(t)) if t.startswith(content, k)}
        assert places <= everywhere and len(everywhere) > 1


def test_windows_split_the_positions():
    data = np.random.default_rng(1).integers(0, 3, 5000).astype(np.uint8)
    start, count, key, h1, _ = R.text_windows(data)
    assert start[0] == 0 and (start[1:] == start[:-1] + count[:-1]).all() and start[-1] + count[-1] == 5000 - 399
    assert len(R.text_windows(data[:399])[0]) == 0


def test_array_order_and_common_prefixes():
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(6, 14))) for _ in range(30)]
    array = R.SuffixArray(pieces, np.ones(30, int), 4)
    suffixes = [pieces[s][p:] for s, p in zip(array.segment, array.pos)]
    heads = [x[:4] for x in suffixes]
    assert len(set(heads)) == sum(a != b for a, b in zip(heads, [None, *heads]))  # equal heads are neighbours
    for k in range(1, len(suffixes)):
        a, b = suffixes[k - 1:k + 1]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert array.lcp[k] == (n if n >= 4 else 0) and (n < 4 or a <= b)


def test_passages_shorter_than_a_byte_repeat(spark, monkeypatch):
    """Shared runs of 45 to 60 short words in other surroundings; very long texts in pieces."""
    ship_package(spark)
    rnd = random.Random(9)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 5))) for _ in range(n))
    rows, i = [], 0
    for n in range(45, 61):
        shared = prose(n)
        for blank in (" ", "\n"):
            rows.append((i := i + 1, f"{prose(rnd.randint(0, 70))}{blank}{shared.replace(' ', blank)} {prose(30)}"))
    rows += [(900, prose(400) + " " + rows[4][1]), (901, rows[9][1]), (902, "a a " * 80), (903, "a a " * 90), (904, None), (905, prose(51))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert passages_of(R.without_repeats(frame).collect()) == direct_passages(rows)
    monkeypatch.setattr(passages, "CHUNK", 20)
    for _, text in rows:
        whole = passages.passage_windows(text or "")
        assert whole[1].sum() == max(0, len((text or "").split()) - 50)
