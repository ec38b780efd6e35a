"""Best fit against a plain search, and an exact round trip of the ids."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlens.llm import packing as P
from bazaarlens.llm import token_counts
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.queries import RUNNERS
from bazaarlens.sources.durable import scratch_path
from tests.conftest import SMALL
from tests.llm import awkward


def plain_best_fit(lengths, size):
    room = []
    for n in lengths:
        fitting = [(left, k) for k, left in enumerate(room) if left >= n]
        if fitting:
            room[min(fitting)[1]] -= n
        else:
            room.append(size - n)
    return sorted(room)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(40, 70))
def test_best_fit(lengths, size):
    lengths = sorted(lengths, reverse=True)
    packs = P.best_fit(lengths, size)
    assert sorted(i for p in packs for i in p) == list(range(len(lengths)))
    assert sorted(size - sum(lengths[i] for i in p) for p in packs) == plain_best_fit(lengths, size)


def ids_of(text):
    return token_counts.encoder(token_counts.ranks_path()).encode_ordinary(text or "")


def check(packs, rows, size):
    segments = {}
    for r in P.unpack(packs).collect():
        segments.setdefault(r["doc_id"], []).append((r["offset"], r["ids"]))
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(ids_of(t))
    for i, wanted in texts.items():
        got = sorted(segments.get(i, []))
        want = sorted((k, ids[k:k + size]) for ids in wanted for k in range(0, len(ids), size))
        assert got == want
    found = packs.collect()
    assert len({r["pack_id"] for r in found}) == len(found)
    for r in found:
        assert len(r["ids"]) == 2 * size and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= size
        assert len(P.positions(r["cu_seqlens"])) == r["n_tokens"]


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(RUNNERS["op7_token_packing"](spark, SMALL), rows, P.PACK)


def test_awkward_rows_small_groups_and_files(spark, docs, no_docs, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(P, "PIECES", 16)
    folder = scratch_path(spark, "packs")
    P.write(P.pack(docs, 128), folder)
    check(spark.read.parquet(folder), [(r[0], r[1]) for r in awkward.rows()], 128)
    assert P.pack(no_docs).count() == 0


def test_positions_restart():
    assert P.positions([0, 3, 5]).tolist() == [0, 1, 2, 0, 1]


def test_positions_are_written_with_each_pack(spark, docs):
    ship_package(spark)
    folder = scratch_path(spark, "packs-positions")
    P.write(P.pack(docs, 128), folder)
    rows = spark.read.parquet(folder).collect()
    assert any(len(r["cu_seqlens"]) > 2 for r in rows) and any(r["n_tokens"] < 128 for r in rows)
    for r in rows:
        want = [k for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:]) for k in range(b - a)]
        assert np.frombuffer(r["positions"], "<u4").tolist() == want + [0] * (128 - r["n_tokens"])
