"""Runs registered queries in Spark and their expected SQL in DuckDB, and compares the rows.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def difference(spark, connection, build, sql: str, sf_dir: str) -> str | None:
    """None when both sides hold the same rows under the same column names."""
    ours = build(spark, sf_dir)
    theirs = connection.sql(sql)
    columns = sorted(ours.columns)
    if columns != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    a = Counter(tuple(_plain(r[c]) for c in columns) for r in ours.collect())
    order = [theirs.columns.index(c) for c in columns]
    b = Counter(tuple(_plain(r[i]) for i in order) for r in theirs.fetchall())
    if a == b:
        return None if a else "no rows on either side"
    return f"{sum(a.values())} and {sum(b.values())} rows; only here {list((a - b).items())[:2]}; only there {list((b - a).items())[:2]}; {columns}"


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as registry
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, connection = session(), duck(sf_dir)
    expected = registry.oracle_sql()
    failed = 0
    for name, build in registry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in expected:
                problem = difference(spark, connection, build, expected[name], sf_dir)
            else:
                problem = None if build(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
