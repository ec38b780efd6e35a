"""All reports on a store that was loaded from nine CSV files."""

import re

import pytest

from bazaarlens.catalog import ingest, reports
from bazaarlens.plans import delivery, running, trend
from bazaarlens.sources import store
from bazaarlens.sources.durable import scratch_path
from bazaarlens.sources.tables import open_star
from tests.conftest import MEDIUM

REPORTS = {name: getattr(reports, name) for name in dir(reports) if re.fullmatch(r"r\d\d\w*", name)}


@pytest.fixture(scope="module")
def both(spark):
    star, root = open_star(spark, MEDIUM), scratch_path(spark, "store")
    counts, specs = ingest.load_views(star, root)
    counted = {r["table_name"]: r["row_count"] for r in counts.collect()}
    assert counted["orders"] == star.orders.count() and counted["order_items"] == star.order_items.count()
    return star, store.open_store(spark, root, specs)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_equals_that_of_the_views(both, name):
    star, stored = (sorted((str(tuple(r)) for r in REPORTS[name](t).collect())) for t in both)
    assert stored == star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_ranges_skip_month_folders(both):
    stored = both[1]
    for df in (running.cumulative_by_state(stored, "2000-01-01", "2000-09-01", reports.STATES),
               trend.month_over_month(stored, "1995-01-01", "1995-12-01"),
               trend.category_momentum(stored, "1995-04-01", "1996-04-01")):
        found = re.findall(r"PartitionFilters: \[([^\]]*order_month[^\]]*)\]", plan(df))
        assert found and any(">=" in f and "<=" in f for f in found)


def test_no_report_of_distances_reads_raw_points(both):
    stored = both[1]
    for df in (delivery.lateness_by_distance(stored), delivery.unmapped_orders(stored)):
        files = " ".join(df.inputFiles())
        assert "/geolocation/" not in files
    assert "/zip_distances/" in " ".join(delivery.lateness_by_distance(stored).inputFiles())


def test_customers_are_sorted_by_person(both):
    files = both[1].customers.selectExpr("input_file_name() f", "customer_unique_id k").groupBy("f").agg({"k": "min"}).collect()
    lows = sorted(r["min(k)"] for r in files)
    assert len(lows) > 1 and lows == sorted(set(lows))
