"""Run registered queries on Spark and their oracles on DuckDB and compare."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _cell(value: object) -> object:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, (int, str)):
        return value if isinstance(value, str) else repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(key: str, build, sql: str, spark, sf_dir: str, connection) -> tuple[bool, str]:
    started = time.time()
    frame = build(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    mid = time.time()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    timing = f"{len(ours)} rows spark {mid - started:.1f}s oracle {time.time() - mid:.1f}s"
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} vs {sorted(names)}"
    if ours == theirs:
        return True, timing
    extra = sorted(set(ours) - set(theirs))[:3]
    missing = sorted(set(theirs) - set(ours))[:3]
    return False, f"{timing} vs {len(theirs)} rows\n   cols   {sorted(names)}\n   spark  {extra}\n   oracle {missing}"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from agrolume.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    connection = connect(sf_dir)
    builds, sqls = entry.queries(), entry.oracle_sql()
    keys = [k for k in builds if not argv or any(a in k for a in argv)]
    failures = 0
    for key in keys:
        try:
            if key not in sqls:
                started = time.time()
                frame = builds[key](spark, sf_dir)
                print(f"rows {key}: {len(frame.collect())} in {time.time() - started:.1f}s", flush=True)
                continue
            ok, detail = compare(key, builds[key], sqls[key], spark, sf_dir, connection)
        except Exception as error:  # noqa: BLE001
            ok, detail = False, f"{type(error).__name__}: {str(error)[:700]}"
        failures += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {key}: {detail}", flush=True)
    print(f"{len(keys)} keys, {failures} failures")
    return failures


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
