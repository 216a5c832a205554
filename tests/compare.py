"""Runs registered queries and their DuckDB statements and compares rows."""

from __future__ import annotations

import math
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (value + 0.0 if value else 0.0)
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, sf_dir, query, statement) -> tuple[str, int, float]:
    """Empty text when equal; also the row count and the seconds Spark took."""
    started = time.monotonic()
    df = query(spark, sf_dir)
    got = df.collect()
    seconds = time.monotonic() - started
    if statement is None:
        return "", len(got), seconds
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", len(got), seconds
    ours, theirs = _rows(df.columns, got), _rows(names, result.fetchall())
    if ours == theirs:
        return "", len(got), seconds
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(only_ours.values())} rows only in Spark, {sum(only_theirs.values())} only in SQL "
        f"({sorted(names)}): {list(only_ours)[:2]} vs {list(only_theirs)[:2]}"
    ), len(got), seconds
