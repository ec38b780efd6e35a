"""The recount against a direct version, with all, some and none of the terms broadcast."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from bazaarlens.llm import divergence, perfect_hash
from bazaarlens.llm.common import table
from bazaarlens.llm.queries import RUNNERS, SQL
from tests.compare import connect, difference
from tests.conftest import SMALL

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BILLION = 10**9


def direct(docs, min_docs=3, top=200):
    """Rows of (lang, source, text) triples."""
    rows = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for lang, source, text in docs]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        held = Counter(t for _, _, terms in own for t in set(terms))
        kept = sorted((t for t, n in held.items() if n >= min_docs), key=str.encode)
        counts = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            counts[s].update(t for t in terms if held[t] >= min_docs)
        chance = lambda c: {t: 1 + BILLION * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: chance(c) for s, c in counts.items()}, chance(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def mixed():
    """Languages with many, few and no kept terms, nulls, ties, and one group with a third of the rows."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdéßИ") for _ in range(rnd.randint(1, 5))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(words[: rnd.choice((20, 300))]) for _ in range(n))
    rows = [("en", "hot", prose(30)) for _ in range(60)]
    rows += [(rnd.choice(["en", "de", None, ""]), rnd.choice(["hot", "b", "c", None]), prose(rnd.randint(0, 40))) for _ in range(100)]
    rows += [("xx", s, t) for s, t in (("a", "one"), ("b", "two"), ("a", None), (None, ""), ("c", "123 456"))]
    rows += [("yy", "only", "same SAME Same sAmé")] * 4 + [("fr", "d", prose(4000)), ("en", "never", None), ("en", "hot", "9Abc1aBC_d")]
    return rows


@pytest.mark.parametrize("limit", [64 << 20, 1500, 0])
def test_against_direct(spark, monkeypatch, limit):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 16)
    monkeypatch.setattr(divergence, "HELD_TERMS", 50)
    frame = spark.createDataFrame([(i, *r, "t") for i, r in enumerate(mixed())], "doc_id long, lang string, source string, text string, term string").repartition(4)
    got = divergence.audit(frame, limit=limit, top=7)
    assert sorted(tuple(r) for r in got.collect()) == direct(mixed(), top=7)
    hot = {r["hot"] for r in divergence.shards_of(divergence.kept_terms(divergence.group_texts(frame)), limit, 16).select("hot").collect()}
    assert hot == ({True} if limit > 1500 else {True, False} if limit else {False})


def test_awkward_and_empty(spark, docs, no_docs):
    triples = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == direct(triples)
    assert divergence.audit(no_docs).collect() == []


def test_whole_table(spark):
    triples = [(r["lang"], r["source"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    got = RUNNERS["op13_source_divergence"](spark, SMALL)
    assert sorted(tuple(r) for r in got.collect()) == direct(triples)
    assert difference(got, connect(SMALL), SQL["op13_source_divergence"]) is None


def test_hash_is_minimal_and_checks_its_keys(spark):
    keys = [f"{i}-".encode() * (1 + i % 3) for i in range(3000)]
    first, _ = perfect_hash.key_hashes(keys)
    shard = perfect_hash.shard_of(first, 5)
    named = spark.createDataFrame([(k,) for k in keys], "k binary").selectExpr("cast(pmod(xxhash64(k), 5) as int) s").collect()
    assert [r["s"] for r in named] == shard.tolist()
    parts = []
    for s in range(5):
        own = [k for k, at in zip(keys, shard) if at == s]
        sizes, bits, number = perfect_hash.build(own)
        assert sorted(number.tolist()) == list(range(len(own)))
        parts.append((sizes, bits, [own[i] for i in np.argsort(number)]))
    whole = perfect_hash.ShardedHash(parts)
    found = whole.numbers(keys)
    assert sorted(found.tolist()) == list(range(len(keys)))
    assert whole.keys.take(found).to_pylist() == keys
    assert (whole.numbers([b"x" + k for k in keys] + [b""]) == -1).all()
    assert (perfect_hash.ShardedHash([([], b"", [])]).numbers([b"a"]) == -1).all()


def test_counts_of_any_size():
    counts = np.array([[0, 5, 10**10, 4 * 10**14]])
    total = np.array([[5 * 10**14]])
    assert divergence.billionths(counts, total).tolist() == [[1 + BILLION * (c + 1) // (5 * 10**14) for c in counts[0].tolist()]]
