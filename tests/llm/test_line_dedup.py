"""Line deduplication against SQL and a direct version."""

from collections import Counter

from pyspark.sql import functions as F

from bazaarlens.llm import line_dedup as L
from bazaarlens.llm.queries import RUNNERS, SQL
from tests.compare import connect, difference
from tests.conftest import SMALL
from tests.llm import awkward

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def direct(rows):
    owners, holders = {}, {}
    for i, text in rows:
        if i is not None:
            for k in map(key, (text or "").split("\n")):
                if len(k) >= L.MIN_CHARS:
                    holders.setdefault(k, set()).add(i)
    owners = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or owners.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_against_sql(spark):
    import duckdb  # noqa: F401

    assert difference(RUNNERS["op9_line_dedup"](spark, SMALL), connect(SMALL), SQL["op9_line_dedup"]) is None


def test_awkward_rows(docs):
    got = L.dedup_lines(docs, batches=3).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, got)) == direct([(r[0], r[1]) for r in awkward.rows()])


def test_batches_and_merging_do_not_matter(spark):
    rows = [(i, "\n".join(f"common line number {(i * k) % 17}" for k in range(9))) for i in range(60)]
    frame = awkward.table(spark, [(i, t, "en", "s", 1, "k", "r", 1) for i, t in rows])
    for batches, fan_in in ((1, 2), (7, 2), (5, 3)):
        got = L.dedup_lines(frame, batches, fan_in).select("doc_id", "n_lines", "n_dropped", "kept").collect()
        assert Counter(map(tuple, got)) == direct(rows)


def test_columns_stay_and_length_follows(docs, no_docs):
    out = L.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter(F.col("n_chars") != F.char_length("text")).isEmpty()
    assert L.without_repeats(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    text = L.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "SortMergeJoin" in text
