from bazaarlens.llm import token_counts as T
from bazaarlens.llm.common import ship_package
from bazaarlens.llm.queries import RUNNERS
from tests.conftest import SMALL
from tests.llm import awkward


def lengths(texts):
    encoder = T.encoder(T.ranks_path())
    return sorted(len(encoder.encode_ordinary(t or "")) for t in texts)


def check(rows, n):
    assert sorted(r["context_limit"] for r in rows) == sorted(set(n))
    for r in rows:
        limit = r["context_limit"]
        assert r["n_docs"] == n.count(limit)
        assert r["docs_over"] == sum(x > limit for x in n) and r["docs_fitting"] == sum(x <= limit for x in n)
        assert r["tokens_total"] == sum(n)
        assert r["tokens_truncated"] == sum(min(x, limit) for x in n)
        assert r["tokens_lost"] == sum(max(x - limit, 0) for x in n)
        assert r["quantile"] == round(sum(x <= limit for x in n) / len(n), 9)


def test_whole_table(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(RUNNERS["op2_token_counts"](spark, SMALL).collect(), lengths(texts))


def test_awkward_rows_and_blocks(spark, docs, no_docs, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(T, "BLOCK", 16)
    n = lengths([r[1] for r in awkward.rows()])
    found = T.length_table(docs)
    check(found.collect(), n)
    for limit in (0, 1, 7, 500, 10**7):
        row = T.totals_at(found, limit).first()
        assert row["tokens_truncated"] == sum(min(x, limit) for x in n)
        assert row["docs_fitting"] == sum(x <= limit for x in n)
    for q in (0.01, 0.5, 0.9, 1.0):
        assert T.quantile(found, q).first()["length"] == next(x for x in n if sum(y <= x for y in n) >= q * len(n))
    assert T.length_table(no_docs).count() == 0


def test_limit_below_every_length(spark):
    found = T.answers(spark.createDataFrame([(5, 2), (9, 1)], "n_tokens long, n_docs long"))
    assert tuple(T.totals_at(found, 3).first()) == (3, 0, 3, 9)
