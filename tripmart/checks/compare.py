"""Runs a registered query on Spark and its SQL on DuckDB and compares all rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

from tripmart.checks.registry import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(_value(row[at]) for at in order) for row in rows), key=repr)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """What differs between both engines, or None. Types count: 1 and 1.0 are not the same."""
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    if not ours:
        return "no rows on either side"
    for our, their in zip(ours, theirs):
        if our != their or list(map(type, our)) != list(map(type, their)):
            return f"{our} against {their}"
    return None
