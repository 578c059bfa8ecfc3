"""Run a query and its SQL twin and compare columns, types and rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

from salesmart.sources.schemas import TABLES

KIND = {bool: "bool", int: "int", float: "float", str: "str", dt.date: "date", dt.datetime: "timestamp", Decimal: "decimal"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), [tuple(row[i] for i in order) for row in rows]


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return v


def problems(spark, con, build, sql: str | None, sf_dir: str) -> list[str]:
    """Differences between a Spark query and its SQL, as text; empty when they agree."""
    df = build(spark, sf_dir)
    columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return []
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted_columns, wanted = _rows(names, cursor.fetchall())
    found = []
    if columns != wanted_columns:
        return [f"columns {columns} != {wanted_columns}"]
    for i, c in enumerate(columns):
        a = {KIND.get(type(r[i]), type(r[i]).__name__) for r in got if r[i] is not None}
        b = {KIND.get(type(r[i]), type(r[i]).__name__) for r in wanted if r[i] is not None}
        if a != b:
            found.append(f"type of {c}: {a} != {b}")
    left, right = (Counter(tuple(_cell(v) for v in r) for r in rows) for rows in (got, wanted))
    if left != right:
        only_a, only_b = list((left - right).items()), list((right - left).items())
        found.append(f"rows {len(got)} vs {len(wanted)}; {len(only_a)} only in Spark e.g. {only_a[:2]}; "
                     f"{len(only_b)} only in SQL e.g. {only_b[:2]}")
    if not wanted:
        found.append("empty result")
    return found
