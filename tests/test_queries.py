"""Every named query against DuckDB: reports at sf0.01, the others at sf0.001."""

import pytest

import __spark_entry__ as entry
from bazaarlens import catalog
from tests.compare import connect, difference
from tests.conftest import MEDIUM, SMALL

QUERIES, SQL = catalog.runners(), catalog.oracle_texts()


@pytest.fixture(scope="module")
def duck():
    return {folder: connect(folder) for folder in (SMALL, MEDIUM)}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    folder = MEDIUM if name.startswith("r") else SMALL
    assert difference(QUERIES[name](spark, folder), duck[folder], SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "customer_state", "top_category", "category_revenue_brl", "state_revenue_brl", "pct_of_state"]
    assert result.count() == 12
