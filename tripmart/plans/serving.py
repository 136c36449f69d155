"""Serving queries over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmart.sources.tables import GOLD_TABLES, Lakehouse

# Tables shown in a preview, all but the monthly one.
PREVIEW_TABLES = GOLD_TABLES[:-1]
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def largest(table: DataFrame, measure: str, *keys: str, limit: int | None = None) -> DataFrame:
    """Rows by a measure, largest first, ties by their keys; each task keeps ``limit`` rows at most."""
    ordered = table.orderBy(F.desc(measure), *keys)
    return ordered if limit is None else ordered.limit(limit)


def top_days(daily: DataFrame, limit: int = 10) -> DataFrame:
    return largest(daily, "total_rides", "ride_date", limit=limit)


def peak_hours(hourly: DataFrame, limit: int = 10) -> DataFrame:
    return largest(hourly, "total_rides", "day_of_week", "start_hour", limit=limit)


def top_start_stations(stations: DataFrame, limit: int = 20) -> DataFrame:
    return largest(stations, "total_starts", "start_station_name", limit=limit)


def top_end_stations(stations: DataFrame, limit: int = 20) -> DataFrame:
    return largest(stations, "total_ends", "end_station_name", limit=limit)


def user_behavior(users: DataFrame) -> DataFrame:
    return largest(users, "total_rides", "member_casual")


def weekend_share(users: DataFrame) -> DataFrame:
    share = F.col("weekend_rides") * 100.0 / F.nullif(F.col("total_rides"), F.lit(0))
    return users.withColumn("weekend_share_pct", F.round(share, 2).cast("double"))


def bike_usage(bikes: DataFrame) -> DataFrame:
    return largest(bikes, "total_rides", "rideable_type")


def top_od_pairs(pairs: DataFrame, limit: int = 20) -> DataFrame:
    return largest(pairs, "total_rides", "start_station_name", "end_station_name", limit=limit)


def preview(name: str, table: DataFrame, rows: int = 20) -> DataFrame:
    """First rows of a Gold table in the order it is built in."""
    if name == "gold_hourly_demand":
        weekday = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.col("day_of_week"))
        return table.orderBy(weekday, "start_hour").limit(rows)
    if name == "gold_daily_rides":
        return table.orderBy("ride_date").limit(rows)
    measure = next(column for column in table.columns if column.startswith("total_"))
    keys = [column for column in table.columns if column.endswith(("_name", "_casual", "_type"))]
    return largest(table, measure, *keys, limit=rows)


def preview_gold(lakehouse: Lakehouse, rows: int = 20) -> dict[str, DataFrame]:
    return {name: preview(name, lakehouse.read(name), rows) for name in PREVIEW_TABLES}
