"""Run registered queries and their SQL texts side by side.

    python -m tests.compare [directory of tables] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries
from tests.session import session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value: object) -> str:
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else f"{float(value):.6f}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(tuple(plain(row[n]) for n in order) for row in rows)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str,
            name: str) -> tuple[bool, str]:
    started = time.time()
    frame = queries()[name](spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - started
    if name not in oracle_sql():
        return True, f"{len(ours)} rows, no SQL, {spent:.1f}s"
    started = time.time()
    cursor = connection.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    note = f"{len(ours)}/{len(theirs)} rows, {spent:.1f}s, SQL {time.time() - started:.1f}s"
    if sorted(columns) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} and {sorted(columns)}"
    if ours != theirs:
        only = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        return False, f"{note}\n  ours   {only[0]}\n  theirs {only[1]}"[:3000]
    return True, note


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark, connection, bad = session(), connect(sf_dir), 0
    for name in names:
        try:
            same, note = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            same, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not same
        print("ok  " if same else "BAD ", name, note, flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
