"""Run a query and its SQL check on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _kind(value) -> str:
    return "null" if value is None else type(value).__name__


def compare(frame, connection, sql: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    rows = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    order = sorted(names)
    positions = [names.index(name) for name in order]
    theirs = [tuple(_cell(row[i]) for i in positions) for row in rows]
    ours = [tuple(_cell(row[name]) for name in order) for row in frame.collect()]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    left, right = Counter(ours), Counter(theirs)
    if left != right:
        only_ours, only_theirs = list((left - right))[:2], list((right - left))[:2]
        return f"rows differ ({sum((left - right).values())}): {dict(zip(order, only_ours[0]))} against {dict(zip(order, only_theirs[0]))}"
    for i, name in enumerate(order):
        kinds = ({_kind(r[i]) for r in ours} - {"null"}, {_kind(r[i]) for r in theirs} - {"null"})
        if kinds[0] != kinds[1]:
            return f"types of {name}: {kinds[0]} against {kinds[1]}"
    return None
