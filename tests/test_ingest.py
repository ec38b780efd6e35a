"""CSV cases: byte order mark, misspelt headers, quoted text, empty fields, missing columns."""

import datetime as dt
import decimal

import pytest

from bazaarlens.sources import csv_ingest, schemas, store
from bazaarlens.sources.durable import scratch_path

HEADERS = {name: [spec.header_of(c) for c, _, _ in spec.columns] for name, spec in schemas.TABLES.items()}
ROWS = {
    "customers": ["c1,p1,01001,sao paulo,SP", "c2,p1,22000,rio,RJ"],
    "sellers": ["s1,09000,sao paulo,SP"],
    "product_category_translation": ["telefonia,telephony"],
    "products": ["i1,telefonia,10,20,1,100,1,2,3", "i2,,,,,,,,"],
    "orders": ["o1,c1,delivered,2017-01-05 10:00:00,,,2017-01-10 09:00:00,2017-01-10 00:00:00",
               "o2,c2,shipped,2017-01-06 10:00:00,,,,2017-01-20 00:00:00"],
    "order_items": ["o1,1,i1,s1,2017-01-07 00:00:00,9.90,1.10"],
    "order_payments": ["o1,1,card,1,11.00"],
    "order_reviews": ['r1,o1,5,,"line one\nline two with ""quotes"", a\ttab and a \\ backslash",2017-01-11 00:00:00,2017-01-12 00:00:00'],
    "geolocation": ["01001,-23.5,-46.6,sao paulo,SP", "01001,-23.7,-46.8,sao paulo,SP"],
}


def write_csvs(folder, skip=None):
    paths = {}
    for name, header in HEADERS.items():
        kept = [h for h in header if h != skip]
        text = ",".join(kept) + "\n" + "\n".join(ROWS[name]) + "\n"
        path = folder / f"{name}.csv"
        path.write_bytes((b"\xef\xbb\xbf" if name == "product_category_translation" else b"") + text.encode())
        paths[name] = str(path)
    return paths


def test_load_and_read_back(spark, tmp_path):
    root = scratch_path(spark, "load")
    counts = {r["table_name"]: r["row_count"] for r in store.load_tables(spark, write_csvs(tmp_path), root).collect()}
    assert counts["products"] == 2 and counts["geolocation"] == 2 and counts["TOTAL"] == 13
    t = store.open_store(spark, root)
    assert t.customers.orderBy("customer_id").first()["customer_zip_code_prefix"] == "01001"
    assert t.translation.columns[0] == "product_category_name"
    assert t.translation.first()["product_category_name_english"] == "telephony"
    empty = t.products.filter("product_id = 'i2'").first()
    assert empty["product_category_name"] is None and empty["product_name_length"] is None
    order = t.orders.filter("order_id = 'o2'").first()
    assert order["order_delivered_customer_date"] is None and order["order_purchase_timestamp"] == dt.datetime(2017, 1, 6, 10)
    assert t.order_items.first()["price"] == decimal.Decimal("9.90")
    assert t.order_reviews.first()["review_comment_message"] == 'line one\nline two with "quotes", a\ttab and a \\ backslash'
    assert t.geolocation_centroid.first()["source_rows"] == 2


def test_reports_run_on_stored_tables(spark, tmp_path):
    from bazaarlens.plans import ranking

    root = scratch_path(spark, "load")
    store.load_tables(spark, write_csvs(tmp_path), root)
    rows = ranking.leading_category_per_state(store.open_store(spark, root)).collect()
    assert [tuple(r) for r in rows] == [("SP", "telephony", 9.9, 9.9, 100.0)]


def test_missing_column_stops_before_any_write(spark, tmp_path):
    root = scratch_path(spark, "load")
    paths = write_csvs(tmp_path, skip="geolocation_state")
    with pytest.raises(csv_ingest.MissingColumns, match="geolocation_state"):
        store.load_tables(spark, paths, root)
    with pytest.raises(Exception):
        store.open_store(spark, root)


def test_failed_load_keeps_the_old_version(spark, tmp_path):
    root = scratch_path(spark, "load")
    paths = write_csvs(tmp_path)
    store.load_tables(spark, paths, root)
    before = store.current_version(spark, root)
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(HEADERS["order_items"]) + "\no1,1,i1,s1,2017-01-07 00:00:00,cheap,1.10\n")
    with pytest.raises(Exception):
        store.load_tables(spark, {**paths, "order_items": str(bad)}, root)
    assert store.current_version(spark, root) == before
    assert store.open_store(spark, root).order_items.count() == 1


@pytest.mark.parametrize("table, row", [
    ("sellers", "s2,09000,rio, extra,RJ"),  # surplus field
    ("sellers", "s2,09000"),  # short row
    ("sellers", 's2,"09000,rio,RJ'),  # quote left open
    ("sellers", "s1,09000,rio,RJ"),  # duplicate key
    ("sellers", "s2,09000,,RJ"),  # required column empty
    ("order_items", "o1,2,nothing,s1,2017-01-07 00:00:00,9.90,1.10"),  # orphan
    ("order_reviews", "r2,o1,6,,,2017-01-11 00:00:00,2017-01-12 00:00:00"),  # score out of range
    ("order_items", "o1,2,i1,s1,2017-01-07 00:00:00,cheap,1.10"),  # not a number
])
def test_bad_rows_leave_the_old_version(spark, tmp_path, table, row):
    root = scratch_path(spark, "load")
    paths = write_csvs(tmp_path)
    store.load_tables(spark, paths, root)
    before = store.current_version(spark, root)
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(HEADERS[table]) + "\n" + "\n".join([*ROWS[table], row]) + "\n")
    with pytest.raises(Exception):
        store.load_tables(spark, {**paths, table: str(bad)}, root)
    assert store.current_version(spark, root) == before


def test_wrong_count_leaves_no_version(spark, tmp_path):
    root = scratch_path(spark, "load")
    with pytest.raises(ValueError, match="sellers"):
        store.load_tables(spark, write_csvs(tmp_path), root, {"sellers": 2})
    with pytest.raises(Exception):
        store.open_store(spark, root)


def test_refresh_switches_versions(spark, tmp_path):
    root = scratch_path(spark, "centroid")
    points = [("01001", 1.0, 2.0), ("01001", 3.0, 4.0)]
    schema = "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double"
    store.refresh_centroids(spark, spark.createDataFrame(points[:1], schema), root)
    first = store.current_version(spark, root)
    rows = store.refresh_centroids(spark, spark.createDataFrame(points, schema), root).collect()
    assert store.current_version(spark, root) != first
    assert [tuple(r) for r in rows] == [("01001", 2.0, 3.0, 2)]


def test_required_and_headers():
    assert "product_category_name" not in schemas.PRODUCTS.required
    assert schemas.PRODUCTS.header_of("product_name_length") == "product_name_lenght"
    assert set(schemas.PUBLISHED_ROWS) == set(schemas.TABLES)


def test_sorted_files_spread_a_hot_key(spark):
    path = scratch_path(spark, "sorted")
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, 5, id % 50) AS k", "id AS v")
    store.write_sorted(rows, "k", path, partitions=8)
    stored = spark.read.parquet(path)
    files = stored.filter("k = 5").selectExpr("input_file_name() AS f").distinct().count()
    assert files >= 3 and stored.exceptAll(rows).isEmpty() and stored.count() == 20_000


def test_month_folders_hold_everything(spark):
    path = scratch_path(spark, "months")
    rows = spark.range(1000).selectExpr("id", "timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ'2000-01-01 08:00:00') AS ts")
    store.write_by_month(rows, "ts", path)
    stored = spark.read.parquet(path)
    assert stored.count() == 1000
    assert stored.filter("order_month = '2000-02'").count() == 29


def test_settings_of_the_caller_are_kept(spark):
    from bazaarlens.session import configure

    key = "spark.sql.sources.fileCompressionFactor"
    before = spark.conf.get(key)
    spark.conf.set(key, "2.5")
    try:
        configure(spark)
        assert spark.conf.get(key) == "2.5"
    finally:
        spark.conf.set(key, before)
