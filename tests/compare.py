"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def kind(dtype) -> str:
    name = str(dtype).lower()
    for word in ("bigint", "hugeint", "integer", "double", "decimal", "varchar", "date", "boolean", "timestamp"):
        if name.startswith(word):
            return word
    return name


SPARK_KIND = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "date": "date",
              "boolean": "boolean", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in names) for r in df.collect()]
    kinds = {c: SPARK_KIND.get(t, t) for c, t in df.dtypes}
    return names, rows, kinds


def duck_rows(con, sql: str):
    rel = con.sql(sql)
    columns = list(rel.columns)
    kinds = {c: kind(t) for c, t in zip(columns, rel.types)}
    names = sorted(columns)
    at = [columns.index(c) for c in names]
    return names, [tuple(plain(r[i]) for i in at) for r in rel.fetchall()], kinds


def sort_key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0) for v in row)


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description."""
    left, right = spark_rows(df), duck_rows(con, sql)
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    kinds = {c: (left[2][c], right[2][c]) for c in left[0] if left[2][c] != right[2][c]}
    a, b = sorted(left[1], key=sort_key), sorted(right[1], key=sort_key)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{left[0]}: {x} != {y}"
    if kinds:
        return f"types differ: {kinds}"
    return None
