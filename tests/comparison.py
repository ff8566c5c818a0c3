"""Row-set comparison of a Spark result with a DuckDB query."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def rows_of_spark(frame) -> tuple[list[str], Counter]:
    names = sorted(frame.columns)
    return names, Counter(
        tuple(_plain(row[name]) for name in names) for row in frame.select(*names).collect()
    )


def rows_of_duck(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in result.fetchall()
    )
