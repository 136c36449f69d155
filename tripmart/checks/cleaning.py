"""Checks of column names, typing, filters, derived columns and data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmart.checks.adapters import RAW_SQL, SILVER_SQL, TYPED_SQL, raw_trips, silver_trips
from tripmart.checks.registry import check, day_text, time_text
from tripmart.functions import trips
from tripmart.functions.naming import normalize_columns
from tripmart.operators import silver
from tripmart.operators.quality import quality_summary, require_non_empty

# Spellings of older and hand-made files.
SOURCE_SPELLINGS = {
    "ride_id": "Ride ID",
    "rideable_type": "rideableType",
    "started_at": "starttime",
    "ended_at": "Stop Time",
    "start_station_name": " Start Station Name ",
    "start_station_id": "START-STATION-ID",
    "end_station_name": "endStationName",
    "start_lng": "Start Lon",
    "end_lng": "endlon",
    "member_casual": "User Type",
}

SILVER_SELECT = f"""
  ride_id, rideable_type, {time_text("started_at")} as started_at, {time_text("ended_at")} as ended_at,
  start_station_name, start_station_id, end_station_name, end_station_id,
  start_lat, start_lng, end_lat, end_lng, member_casual, trip_duration_minutes,
  {day_text("start_date")} as start_date, start_hour, day_of_week, day_of_week_num, month, is_weekend,
  round(distance_km, 9) as distance_km, 'silver' as data_layer"""


def typed_trips(spark, sf_dir) -> DataFrame:
    return silver.normalize_values(silver.cast_types(raw_trips(spark, sf_dir)))


def nano_distance(df: DataFrame) -> DataFrame:
    """Sines differ between engines in the last bit; distances are compared to nine digits."""
    return df.withColumn("distance_km", F.round("distance_km", 9))


def message_of(step, df: DataFrame) -> str:
    try:
        step(df)
    except ValueError as error:
        return str(error)
    return "accepted"


@check(
    "normalize_columns",
    f"with {RAW_SQL} select *, started_at as started_at_1, '1' as trip_no from raw",
)
def normalize_columns_check(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    repeated = raw.withColumns({"Started At": F.col("started_at"), "Trip (no.)": F.lit("1")})
    return normalize_columns(repeated.withColumnsRenamed(SOURCE_SPELLINGS))


@check(
    "require_columns",
    f"""with {RAW_SQL} select count(*) as rows, 'accepted' as whole,
    'Missing required trip columns after normalization: [''started_at'', ''end_lat'']' as reduced
    from raw""",
)
def require_columns_check(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    reduced = raw.drop("started_at", "end_lat", "member_casual")
    return raw.agg(
        F.count("*").alias("rows"),
        F.lit(message_of(silver.require_columns, raw)).alias("whole"),
        F.lit(message_of(silver.require_columns, reduced)).alias("reduced"),
    )


@check(
    "fill_optional_columns",
    f"""with {RAW_SQL} select ride_id, coalesce(rideable_type, 'none') as rideable_type,
    'none' as member_casual, 'none' as start_station_name, 'none' as end_station_name from raw""",
)
def fill_optional_columns_check(spark, sf_dir):
    reduced = raw_trips(spark, sf_dir).drop("member_casual", "start_station_name", "end_station_name")
    filled = silver.fill_optional_columns(reduced)
    return filled.select("ride_id", *silver.OPTIONAL_COLUMNS).fillna("none", list(silver.OPTIONAL_COLUMNS))


@check(
    "typed_casts",
    f"""with {TYPED_SQL} select ride_id, {time_text("started_at")} as started_at,
    {time_text("ended_at")} as ended_at, start_lat, start_lng, end_lat, end_lng from typed""",
)
def typed_casts_check(spark, sf_dir):
    typed = silver.cast_types(raw_trips(spark, sf_dir))
    return typed.select("ride_id", "started_at", "ended_at", "start_lat", "start_lng", "end_lat", "end_lng")


@check(
    "silver_projection",
    f"""with {TYPED_SQL} select ride_id, rideable_type, start_station_name, end_station_name, start_lat,
    member_casual, 'silver' as data_layer from typed""",
)
def silver_projection_check(spark, sf_dir):
    """Columns in mixed order, some unknown and some never there."""
    mixed = typed_trips(spark, sf_dir).select(
        F.lit("silver").alias("data_layer"),
        "member_casual",
        F.lit(1).alias("not_a_silver_column"),
        "start_lat",
        "end_station_name",
        "start_station_name",
        "rideable_type",
        "ride_id",
    )
    return silver.silver_projection(mixed)


@check(
    "filter_valid_trips",
    f"""with {TYPED_SQL} select ride_id, {time_text("started_at")} as started_at,
    {time_text("ended_at")} as ended_at from typed where ride_id is not null and started_at is not null
    and ended_at is not null and ended_at > started_at""",
)
def filter_valid_trips_check(spark, sf_dir):
    valid = silver.keep_valid_trips(typed_trips(spark, sf_dir))
    return valid.select("ride_id", "started_at", "ended_at")


@check("trip_duration", f"with {SILVER_SQL} select ride_id, trip_duration_minutes from silver")
def trip_duration_check(spark, sf_dir):
    timed = silver.add_duration(silver.keep_valid_trips(typed_trips(spark, sf_dir)))
    return timed.select("ride_id", "trip_duration_minutes")


@check(
    "normalize_user_type",
    f"""with {TYPED_SQL} select member_casual, count(*) as rides from typed group by member_casual""",
)
def normalize_user_type_check(spark, sf_dir):
    riders = raw_trips(spark, sf_dir).select(trips.rider_type().alias("member_casual"))
    return riders.groupBy("member_casual").agg(F.count("*").alias("rides"))


@check(
    "lower_bike_type",
    f"""with {RAW_SQL} select lower(rideable_type) as rideable_type, count(*) as rides
    from raw group by lower(rideable_type)""",
)
def lower_bike_type_check(spark, sf_dir):
    bikes = silver.normalize_values(raw_trips(spark, sf_dir))
    return bikes.groupBy("rideable_type").agg(F.count("*").alias("rides"))


@check(
    "date_parts",
    f"""with {SILVER_SQL} select ride_id, {day_text("start_date")} as start_date, start_hour, day_of_week,
    day_of_week_num, month, is_weekend from silver""",
)
def date_parts_check(spark, sf_dir):
    dated = silver.add_calendar(silver.add_duration(silver.keep_valid_trips(typed_trips(spark, sf_dir))))
    return dated.select("ride_id", *trips.calendar_columns())


@check("haversine_km", f"with {SILVER_SQL} select ride_id, round(distance_km, 9) as distance_km from silver")
def haversine_km_check(spark, sf_dir):
    return nano_distance(silver_trips(spark, sf_dir)).select("ride_id", "distance_km")


@check("silver_transform", f"with {SILVER_SQL} select {SILVER_SELECT} from silver")
def silver_transform_check(spark, sf_dir):
    return nano_distance(silver_trips(spark, sf_dir))


@check(
    "quality_summary",
    f"""with {TYPED_SQL}, both_layers as (
      select 'typed' as layer, ride_id, started_at, ended_at from typed
      union all select 'silver', ride_id, started_at, ended_at from typed
      where ride_id is not null and ended_at > started_at
        and floor(epoch(ended_at)) > floor(epoch(started_at)))
    select layer, count(*) as rows, count(distinct ride_id) as distinct_ride_ids,
      count(*) filter (ride_id is null) as null_ride_id,
      count(*) filter (started_at is null) as null_started_at,
      count(*) filter (ended_at is null) as null_ended_at,
      count(*) filter (ended_at <= started_at) as non_positive_time_rows
    from both_layers group by layer""",
)
def quality_summary_check(spark, sf_dir):
    before = quality_summary(typed_trips(spark, sf_dir)).withColumn("layer", F.lit("typed"))
    after = quality_summary(silver_trips(spark, sf_dir)).withColumn("layer", F.lit("silver"))
    return before.unionByName(after)


@check(
    "require_non_empty",
    f"""with {RAW_SQL} select count(*) as rows, 'accepted' as filled,
    'no trips is empty. Check input paths and data filters.' as emptied from raw""",
)
def require_non_empty_check(spark, sf_dir):
    raw = raw_trips(spark, sf_dir)
    emptied = silver.keep_valid_trips(typed_trips(spark, sf_dir)).where(F.col("started_at") < "1900-01-01")
    return raw.agg(
        F.count("*").alias("rows"),
        F.lit(message_of(lambda df: require_non_empty(df, "trips"), raw)).alias("filled"),
        F.lit(message_of(lambda df: require_non_empty(df, "no trips"), emptied)).alias("emptied"),
    )
