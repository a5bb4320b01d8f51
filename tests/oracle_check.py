"""Run queries and their SQL side by side: ``python tests/oracle_check.py <folder> [names]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from lodgegrid.session import create_session  # noqa: E402

TABLES = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region"]


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark, connection, folder: str, name: str) -> list[str]:
    """What differs between a query and its SQL; empty when they agree."""
    result = entry.queries()[name](spark, folder)
    mine = _rows(result.columns, [tuple(r) for r in result.collect()])
    answer = connection.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    theirs = _rows(columns, answer.fetchall())
    found = []
    if sorted(result.columns) != sorted(columns):
        found.append(f"columns {sorted(result.columns)} against {sorted(columns)}")
    if mine != theirs:
        found.append(
            f"{mine.total()} rows against {theirs.total()}; only here {list((mine - theirs))[:2]}, "
            f"only there {list((theirs - mine))[:2]}"
        )
    if not mine:
        found.append("no rows")
    return found


def main(folder: str, names: list[str]) -> int:
    spark = create_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    failed = 0
    for name in names or entry.queries():
        started = time.time()
        try:
            found = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{name}: {'; '.join(found) or 'ok'} ({time.time() - started:.1f} s)", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
