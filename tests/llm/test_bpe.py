"""Encoding against the rank library, decoding as an exact round trip."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaarlens.llm import bpe, token_counts
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL
from tests.llm import awkward


def ranks():
    return token_counts.encoder(token_counts.ranks_path())


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("ab '\n\t  é日😀1_sd!")), max_size=60))
def test_any_text(text):
    own = bpe.codec(bpe.vocabulary_path())
    ids = own.encode(text)
    assert ids == ranks().encode_ordinary(text) and own.decode(ids) == text.encode()
    starts, ends = own.offsets(text)
    for i, a, b in zip(ids, starts, ends):
        assert own.bytes_of[i] in text[a:b].encode()
    assert len(ids) == len(starts) and (not ids or (starts[0] == 0 and ends[-1] == len(text)))


def test_special_tokens_are_text():
    assert bpe.codec(bpe.vocabulary_path()).encode("<|endoftext|>") == ranks().encode_ordinary("<|endoftext|>")


def expected(i, text):
    ids = ranks().encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_awkward_rows(spark, docs, no_docs):
    ship_package(spark)
    assert sorted(map(str, map(tuple, bpe.digests(docs).collect()))) == sorted(str(expected(r[0], r[1])) for r in awkward.rows())
    assert bpe.digests(no_docs).count() == 0


def test_encode_and_decode(spark, docs):
    ship_package(spark)
    back = [(r["doc_id"], bytes(r["data"]).decode()) for r in bpe.decode(bpe.encode(docs)).collect()]
    assert sorted(map(str, back)) == sorted(str((r[0], r[1] or "")) for r in awkward.rows())


def test_whole_table(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = RUNNERS["op6_byte_bpe"](spark, SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(expected(*r) for r in texts)


def test_cache_may_be_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = bpe.Codec(bpe.vocabulary_path())
    text = "several different words that do not fit"
    assert own.encode(text) == ranks().encode_ordinary(text) and len(own.known) <= 3


@pytest.mark.parametrize("byte", range(256))
def test_every_byte_has_one_character(byte):
    assert sum(b == byte for b in bpe.byte_characters().values()) == 1
