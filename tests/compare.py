"""Run registered queries next to their SQL in DuckDB and compare the rows as bags.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("lineitem", "orders", "events", "supplier")


def bag(rows, columns: list[str]) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(repr(row[at]) for at in order) for row in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def compare(spark, connection, sf_dir: str, run, sql: str) -> str:
    """"" when both give the same bag of rows, else what differs."""
    result = run(spark, sf_dir)
    found = bag(result.collect(), result.columns)
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    wanted = bag(cursor.fetchall(), columns)
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(columns)}"
    if not wanted:
        return "no rows"
    if found != wanted:
        return (f"{sum(found.values())} rows, {sum(wanted.values())} wanted; "
                f"extra {list((found - wanted).items())[:2]}; missing {list((wanted - found).items())[:2]}")
    return ""


if __name__ == "__main__":
    from conftest import make_session

    from metermill.workload.catalog import ORACLE, QUERIES

    sf_dir, *names = sys.argv[1:] or ["/root/testdata/sf0.01"]
    spark, connection, failed = make_session(), connect(sf_dir), 0
    for name in names or QUERIES:
        began = time.time()
        try:
            difference = compare(spark, connection, sf_dir, QUERIES[name], ORACLE[name])
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name} {time.time() - began:.1f}s {difference}", flush=True)
    print(f"{failed} failed")
