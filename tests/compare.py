"""Run registered queries in Spark and their SQL in DuckDB and compare all rows.

    python tests/compare.py [sf_dir] [query ...]
"""

import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TESTDATA = Path("/root/testdata")


def connect(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def canonical(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def bag(frame):
    return as_bag(frame.columns, frame.collect())


def spark_bag(frame):
    return sorted(frame.columns), bag(frame)


def sql_bag(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), as_bag(columns, result.fetchall())


def main():
    from __spark_entry__ import oracle_sql, queries
    from arenalake.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else str(TESTDATA / "sf0.01")
    chosen = args[1:] or list(queries())
    spark = local_session("compare")
    connection = connect(sf_dir)
    bad = []
    for name in chosen:
        start = time.time()
        try:
            columns, got = spark_bag(queries()[name](spark, sf_dir))
        except Exception as error:  # report and go on with the next query
            bad.append(name)
            print(f"{name}: ERROR {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        sql = oracle_sql().get(name)
        if sql is None:
            print(f"{name}: {got.total()} rows, no SQL, {took:.1f}s", flush=True)
            continue
        want_columns, want = sql_bag(connection, sql)
        same = columns == want_columns and got == want
        if not same:
            bad.append(name)
            print(columns, want_columns)
            print(" only in Spark:", list((got - want).items())[:3])
            print(" only in SQL:  ", list((want - got).items())[:3])
        verdict = "ok" if same else "DIFFERS"
        print(f"{name}: {verdict} {got.total()}/{want.total()} {took:.1f}s", flush=True)
    print("all equal" if not bad else f"bad: {bad}")


if __name__ == "__main__":
    main()
