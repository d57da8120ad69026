"""Run a registered query and its DuckDB text on the same folder and compare the rows."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def differences(connection, text, frame, limit=5):
    """Human-readable differences; empty when both sides agree in columns, types and rows."""
    found = frame.collect()
    result = connection.execute(text)
    names = [column[0] for column in result.description]
    expected = result.fetchall()
    left_names, left = _table(frame.columns, found)
    right_names, right = _table(names, expected)
    if left_names != right_names:
        return [f"columns {left_names} / {right_names}"]
    problems = []
    kinds = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
        "DATE": "date", "BOOLEAN": "boolean",
    }
    spark_kinds = dict(frame.dtypes)
    for column in result.description:
        kind = kinds.get(str(column[1]), str(column[1]))
        if spark_kinds[column[0]] != kind:
            problems.append(f"type of {column[0]}: {spark_kinds[column[0]]} / {kind}")
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    for a, b in zip(left, right):
        if a != b:
            cells = {n: (x, y) for n, x, y in zip(left_names, a, b) if x != y}
            problems.append(f"row {a[:3]}: {cells}")
            if len(problems) >= limit:
                break
    return problems
