"""The named queries of this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, brown, decontam, divergence, importance, licenses, line_dedup, minhash, packing, quality, suffix_repeats, token_counts, toxicity
from .common import table

RUNNERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build):
    RUNNERS[build.__name__] = build
    return build


@query
def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_classes(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.length_table(table(spark, sf_dir, "documents"))


@query
def op3_suffix_array_dedup(spark, sf_dir):
    return suffix_repeats.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passages", "n_passage_words")


@query
def op4_license_scan(spark, sf_dir):
    """Each document is a file: its source is the top directory, then its language and the thousands of its id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


@query
def op5_benchmark_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


@query
def op6_byte_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op7_token_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), quality.trusted_ids(table(spark, sf_dir, "labels")))


@query
def op9_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op9_line_dedup"] = """
    with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    lines as (
        select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos from texts),
    keyed as (
        select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
        from lines),
    owners as (
        select key, min(doc_id) as owner from keyed where length(key) >= 10
        group by key having count(distinct doc_id) >= 2),
    judged as (select k.*, o.owner is not null and o.owner <> k.doc_id as gone
               from keyed k left join owners o on o.key = k.key)
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
    from judged group by doc_id"""


@query
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op11_importance_resampling(spark, sf_dir):
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


SQL["op13_source_divergence"] = r"""
    with texts as (
        select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents),
    used as (select row, lang, source, unnest(terms) as term from texts),
    kept as (select lang, term from used group by lang, term having count(distinct row) >= 3),
    groups as (select distinct lang, source from texts),
    found as (
        select u.lang, u.source, u.term, count(*) as n
        from used u join kept k on k.lang = u.lang and k.term = u.term group by u.lang, u.source, u.term),
    cells as (
        select g.lang, g.source, k.term, coalesce(f.n, 0) as n
        from groups g join kept k on k.lang = g.lang
        left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term),
    sized as (
        select *, sum(n) over (partition by lang, source)::hugeint + count(*) over (partition by lang, source) as size
        from cells),
    p as (select lang, source, term, n, 1 + (1000000000::hugeint * (n + 1)) // size as p from sized),
    whole as (select lang, term, sum(n)::hugeint as n from cells group by lang, term),
    q as (
        select lang, term, 1 + (1000000000::hugeint * (n + 1)) //
               (sum(n) over (partition by lang) + count(*) over (partition by lang))::hugeint as q
        from whole),
    pair_sums as (
        select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
        from p a join p b on b.lang = a.lang and b.term = a.term and b.source <> a.source
        group by a.lang, a.source, b.source),
    pairs as (
        select a.lang, a.source, b.source as item, coalesce(s.value, 0) as value
        from groups a join groups b on b.lang = a.lang and b.source <> a.source
        left join pair_sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
    leading_terms as (
        select p.lang, p.source, p.term as item, ((p - q) * (p - q)) // q as value
        from p join q on q.lang = p.lang and q.term = p.term where n > 0 and p > q),
    parts as (
        select lang, source, 'pair' as part, item, value from pairs
        union all select lang, source, 'term', item, value from leading_terms),
    ranked as (
        select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from parts)
    select lang, source, part, item, value::bigint as value, rank::int as rank
    from ranked where part = 'pair' or rank <= 200"""


@query
def op12_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return brown.score(docs, brown.train(brown.training_rows(docs)))
