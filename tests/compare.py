"""Run each query and its SQL statement on the same files and compare names, types and values.

``python -m tests.compare /root/testdata/sf0.01 [query ...]``
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

import __spark_entry__ as entry_points

SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(directory)):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{directory}/{file}')")
    return connection


def differences(frame: DataFrame, name: str, connection: duckdb.DuckDBPyConnection) -> str | None:
    """What differs between the result of the query and its statement, or nothing."""
    columns = sorted(frame.columns)
    rows = Counter(tuple(row) for row in frame.select(*columns).collect())
    result = connection.execute(entry_points.oracle_sql()[name])
    described = {column[0]: str(column[1]) for column in result.description}
    if sorted(described) != columns:
        return f"columns {columns} against {sorted(described)}"
    types = {column: SQL_TYPES[data_type] for column, data_type in frame.dtypes}
    if types != described:
        return f"types {types} against {described}"
    places = [list(described).index(column) for column in columns]
    expected = Counter(tuple(row[place] for place in places) for row in result.fetchall())
    if rows != expected:
        return f"only here {list((rows - expected).items())[:3]}, only there {list((expected - rows).items())[:3]}"
    return None


def main(directory: str, names: list[str]) -> int:
    from tallyward.session import build_session, local_sizes

    spark = build_session("compare", master="local[8]", **local_sizes(8))
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    failed = 0
    for name in names or entry_points.oracle_sql():
        started = time.perf_counter()
        difference = differences(entry_points.queries()[name](spark, directory), name, connection)
        failed += difference is not None
        print(f"{name:28s} {time.perf_counter() - started:6.2f}s {difference or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
