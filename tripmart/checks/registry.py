"""Queries by name, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.checks.adapters import portable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query. ``sql`` runs on the plain tables; without it only rows can be compared."""

    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(query(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def half_up(value: str, digits: int) -> str:
    """SQL rounding on the decimal text of a double, as Spark rounds."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 15)), {digits}) as double)"


def day_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
