"""Comparing a Spark result with DuckDB's on the same parquet tables."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(frame, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    ours = rows_of(frame.columns, frame.collect())
    theirs = rows_of(relation.columns, relation.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} against {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"{len(ours[1])} rows against {len(theirs[1])}"]
    return [f"{a} against {b}" for a, b in zip(ours[1], theirs[1]) if a != b][:3]
