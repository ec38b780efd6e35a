"""The stages in their order, each against its operator's own result."""

import corpus_pipeline as C
from bazaarlens.llm import bpe, decontam, minhash, quality
from bazaarlens.llm.common import stored, table
from tests.conftest import SMALL


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    columns, inputs = docs.columns, []
    for k, (name, stage) in enumerate(C.STAGES):
        inputs.append(docs)
        docs = stored(stage(spark, docs, SMALL), name)
        if k + 1 < len(C.STAGES):
            assert docs.columns == columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in [*inputs, docs]]
    judged = quality.judge(inputs[0], quality.trusted_ids(table(spark, SMALL, "labels")))
    assert ids[1] == {r["doc_id"] for r in judged.filter("kept").collect()} != ids[0]
    assert ids[2] == ids[1]
    assert ids[3] == {r["doc_id"] for r in minhash.near_classes(inputs[2]).filter("doc_id = class_id").collect()}
    leaked = {r["doc_id"] for r in decontam.leaks(inputs[3], table(spark, SMALL, "benchmark")).collect()}
    assert leaked and ids[4] == ids[3] - leaked
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, bpe.digests(inputs[4]).collect()))


def test_run_has_the_last_stage_s_columns(spark):
    assert C.run(spark, SMALL).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
