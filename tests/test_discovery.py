import random
from itertools import combinations

import pytest

from bazaarlens.plans import discovery as D


def plain_keys(rows, columns):
    usable = [c for k, c in enumerate(columns) if all(r[k] is not None for r in rows)]
    found = []
    for width in range(1, len(usable) + 1):
        for s in combinations(usable, width):
            values = [tuple(r[columns.index(c)] for c in s) for r in rows]
            if len(set(values)) == len(values) and not any(set(k) <= set(s) for k in found):
                found.append(s)
    return found


@pytest.mark.parametrize("seed", [0, 3])
def test_minimal_keys_against_all_sets(spark, seed):
    rnd = random.Random(seed)
    columns = ["a", "b", "c", "odd name", "e"]
    spread = [rnd.choice([3, 8, 40]) for _ in columns]
    # A hot value of the first column holds a third of the rows.
    rows = list({tuple(0 if k == 0 and rnd.random() < 0.3 else rnd.randrange(n) for k, n in enumerate(spread)) for _ in range(60)})
    rows = [(*r[:4], None if seed == 3 and r[4] == 0 else r[4]) for r in rows]
    frame = spark.createDataFrame(rows, "a int, b int, c int, `odd name` int, e int")
    want = plain_keys(rows, columns)
    assert D.minimal_keys(frame) == want
    assert D.minimal_keys(frame, 2) == [k for k in want if len(k) <= 2]


def test_tables_without_a_key_and_tiny_tables(spark):
    twice = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    assert D.minimal_keys(twice) == []
    assert D.minimal_keys(twice.limit(0)) == [()] and D.minimal_keys(twice.limit(1)) == [()]
    assert D.minimal_keys(spark.createDataFrame([(None,), (1,)], "a int")) == []


def test_profile_of_all_columns(spark):
    rows = [(i, 7 if i % 3 else i, None if i % 4 == 0 else f"v{i % 5}") for i in range(900)]
    got = {r["column_name"]: r for r in D.column_profile("t", spark.createDataFrame(rows, "id long, hot int, `odd name` string")).collect()}
    assert list(got) == ["id", "hot", "odd name"]
    for k, (c, r) in enumerate(got.items()):
        held = [x[k] for x in rows if x[k] is not None]
        assert (r["row_count"], r["null_count"]) == (900, 900 - len(held))
        assert (r["min_value"], r["max_value"]) == (str(min(held)), str(max(held)))
        assert abs(r["distinct_estimate"] - len(set(held))) <= 5 * D.RSD * len(set(held)) + 1
    assert [(h["value"], h["n"]) for h in got["hot"]["heavy_hitters"]][0] == ("7", 600)
    assert all(abs(q - 900 * p) <= 9 for q, p in zip(got["id"]["quantiles"], D.QUANTILES))
    assert got["odd name"]["quantiles"] is None and len(got["odd name"]["heavy_hitters"]) == 3


def test_profile_reads_the_table_once(spark, tables):
    plan = D.column_profile("orders", tables.by_name("sellers"))._jdf.queryExecution().executedPlan().toString()
    scans = D.column_profile("items", spark.range(10).toDF("id"))._jdf.queryExecution().executedPlan().toString()
    assert scans.count("Range (") == 1 and "approx_top_k" in plan


def test_profile_of_an_empty_table(spark):
    r = D.column_profile("t", spark.createDataFrame([], "a int")).first()
    assert (r["row_count"], r["null_count"], r["min_value"], r["heavy_hitters"]) == (0, 0, None, [])
