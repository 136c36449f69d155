"""Silver: named, typed and valid trips with duration, calendar parts and distance."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, functions as F

from tripmart.functions import trips
from tripmart.functions.geo import haversine_km
from tripmart.functions.naming import TRIP_COLUMNS, merge_spellings
from tripmart.operators.quality import observed_summary, rule_counts
from tripmart.sources.tables import Lakehouse

# What the input must have, what may be missing, and the order of the result.
REQUIRED_COLUMNS = ("ride_id", "started_at", "ended_at", "start_lat", "start_lng", "end_lat", "end_lng")
OPTIONAL_COLUMNS = ("rideable_type", "member_casual", "start_station_name", "end_station_name")
SILVER_COLUMNS = (
    *TRIP_COLUMNS,
    "trip_duration_minutes",
    "start_date",
    "start_hour",
    "day_of_week",
    "day_of_week_num",
    "month",
    "is_weekend",
    "distance_km",
    "ingestion_timestamp",
    "source_file",
    "data_layer",
)


def require_columns(df: DataFrame) -> DataFrame:
    missing = [column for column in REQUIRED_COLUMNS if column not in df.columns]
    if missing:
        raise ValueError(f"Missing required trip columns after normalization: {missing}")
    return df


def fill_optional_columns(df: DataFrame) -> DataFrame:
    missing = [column for column in OPTIONAL_COLUMNS if column not in df.columns]
    return df.withColumns({column: F.lit(None).cast("string") for column in missing}) if missing else df


def cast_types(df: DataFrame) -> DataFrame:
    """Timestamps and coordinates from text; what does not parse becomes NULL."""
    times = {column: trips.as_timestamp(column) for column in ("started_at", "ended_at")}
    places = {
        column: trips.as_double(column) for column in ("start_lat", "start_lng", "end_lat", "end_lng")
    }
    return df.withColumns(times | places)


def normalize_values(df: DataFrame) -> DataFrame:
    return df.withColumns({"member_casual": trips.rider_type(), "rideable_type": F.lower("rideable_type")})


def keep_valid_trips(df: DataFrame) -> DataFrame:
    """An id, both times, and an end after the start; coordinates may be missing."""
    # A comparison with NULL is not true, so it also drops trips that lack either time.
    return df.where(F.col("ride_id").isNotNull() & (F.col("ended_at") > F.col("started_at")))


def add_duration(df: DataFrame) -> DataFrame:
    """Adds the duration and drops trips that start and end within the same second."""
    timed = df.withColumn("trip_duration_minutes", trips.duration_minutes())
    return timed.where(F.col("trip_duration_minutes") > 0)


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(trips.calendar_columns())


def add_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_km", haversine_km("start_lat", "start_lng", "end_lat", "end_lng"))


def silver_projection(df: DataFrame) -> DataFrame:
    """Silver columns in their order; ones the source never had are left out."""
    return df.select(*[column for column in SILVER_COLUMNS if column in df.columns])


def typed_trips(df: DataFrame) -> DataFrame:
    """Raw or Bronze rows, named and typed; none is left out."""
    for step in (merge_spellings, require_columns, fill_optional_columns, cast_types, normalize_values):
        df = df.transform(step)
    return df


def valid_trips(typed: DataFrame) -> DataFrame:
    """Typed rows to Silver."""
    for step in (keep_valid_trips, add_duration, add_calendar, add_distance):
        typed = typed.transform(step)
    return silver_projection(typed.withColumn("data_layer", F.lit("silver")))


def transform_to_silver(df: DataFrame) -> DataFrame:
    """Raw or Bronze rows to Silver: projections and filters only, so no shuffle at any size."""
    return df.transform(typed_trips).transform(valid_trips)


class SilverRun(NamedTuple):
    """``rows`` stored, their quality summary, and ``found``: what the Bronze rows were like before cleaning."""

    rows: int
    quality: DataFrame
    found: dict[str, int]


def write_silver(lakehouse: Lakehouse, rebalance: bool = False, only_landed_months: bool = False) -> SilverRun:
    """Bronze table to Silver table, by month, in one pass over Bronze.

    The write itself gathers the rule counts of all Bronze rows and of those kept; only the exact distinct count of ids
    takes a pass of its own, over that column of the stored table, when the summary is asked for.

    Landed files hold a month each, so every task writes to one or two months and no shuffle is
    needed. ``rebalance`` evens out file sizes when the input mixes months: rows are shuffled by
    month, and adaptive execution splits the big months over as many tasks as their size asks for.
    ``only_landed_months`` replaces the months that Bronze has rows of and leaves the others as they are; the
    summary's rule counts are then those of the rows written.
    """
    found, kept = Observation(), Observation()
    typed = typed_trips(lakehouse.read("bronze")).observe(found, *rule_counts())
    silver = valid_trips(typed).observe(kept, *rule_counts())
    if rebalance:
        silver = silver.hint("rebalance", "month")
    store = lakehouse.replace_partitions if only_landed_months else lakehouse.write
    rows = store(silver, "silver", partition_by=("month",), needed_for="Silver trip table")
    return SilverRun(rows, observed_summary(lakehouse.read("silver"), kept.get), found.get)
