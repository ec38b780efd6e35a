"""Compare named queries with DuckDB: ``python tests/check_queries.py SF_DIR [prefix ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from bazaarlens.session import local_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                rows = ""
            else:
                problem, rows = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.perf_counter() - start:6.2f}s {name} {problem or rows}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
