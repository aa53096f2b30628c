"""Compare registered queries with their SQL twins, row for row."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET threads = 8")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    return f"{type(value).__name__}:{value}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, connection, name, query, sql, sf_dir) -> str | None:
    """What differs, or nothing."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    if sql is None:
        return None if got[1] else "no rows"
    cursor = connection.execute(sql)
    expected = rows([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    if not got[1]:
        return "no rows on either side"
    for a, b in zip(got[1], expected[1]):
        if a != b:
            return f"{got[0]}\n  spark {a}\n  sql   {b}"[:1500]
    return None


def main() -> int:
    import __spark_entry__ as entry
    from conftest import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, connection = build_session(), duck(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    chosen = sys.argv[1:]
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            problem = compare(spark, connection, name, query, oracles.get(name), sf_dir)
        except Exception as error:  # a query that fails is a finding like any other
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name}"
              f"{'' if name in oracles else ' (rows only)'} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
