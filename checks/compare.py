"""Run the registered queries against their SQL twins: python -m checks.compare [dir] [names...]"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle
from checks.queries import registry


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(directory).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal | int):
        return repr(float(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a result and its SQL twin, or None."""
    cursor = connection.execute(sql)
    expected_columns = [c[0] for c in cursor.description]
    expected = _sorted_rows(expected_columns, cursor.fetchall())
    actual = _sorted_rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} and {sorted(expected_columns)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows and {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected, strict=True) if a != e]
    return f"{len(wrong)} rows, first {wrong[0]}" if wrong else None


def main(directory: str, names: list[str]) -> int:
    from clickmart.session import local_session

    spark: SparkSession = local_session()
    connection = connect(directory)
    texts = oracle()
    failed = 0
    for name, run in registry().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = differences(run(spark, directory), connection, texts[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.1f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    raise SystemExit(main(folder, sys.argv[2:]))
