"""Trips derived from the ``events`` table, as Spark DataFrames and as SQL text.

The test data has no trips. Every event becomes one raw trip, all text as in a landed file, with the
faults the cleaning step must cope with: missing ids and names, times that do not parse, ends before
or at starts or within the same second, missing coordinates, unknown riders. A third of all trips
start at one station. Event times of one month are spread over seven. Coordinates are whole
micro-degrees with an exponent, a text that both engines read as the same double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripmart.operators.silver import transform_to_silver

HUB = "Central Hub, Pier 1"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    began = "unix_micros(cast(ts as timestamp)) + (user_id % 6) * 2678400000000"
    lasted = """case when event_id % 61 = 0 then 1000L
        else (floor(value * 10) - case when event_id % 50 = 0 then 600 else 0 end) * 1000000 end"""
    derived = events(spark, sf_dir).selectExpr(
        "event_id",
        "user_id",
        "event_type",
        f"{began} as began",
        f"{lasted} as lasted",
        "cast(get_json_object(props, '$.k') as bigint) as k",
    )
    return derived.selectExpr(
        "case when event_id % 97 <> 0 then concat('r', event_id) end as ride_id",
        """case when event_type in ('click', 'view') then 'Classic_Bike'
           when event_type <> 'error' then 'electric_bike' end as rideable_type""",
        """case when event_id % 89 = 0 then 'garbage'
           else cast(timestamp_micros(began) as string) end as started_at""",
        """case when event_id % 83 = 0 then 'no time'
           else cast(timestamp_micros(began + lasted) as string) end as ended_at""",
        f"""case when event_id % 31 = 0 then null when event_id % 3 = 0 then '{HUB}'
            else concat('Station ', user_id % 40) end as start_station_name""",
        "case when event_id % 31 <> 0 then concat(user_id % 40, '.10') end as start_station_id",
        "case when event_id % 29 <> 0 then concat('Station ', k % 40) end as end_station_name",
        "case when event_id % 29 <> 0 then concat(k % 40, '.20') end as end_station_id",
        """case when event_id % 41 = 0 then 'n/a'
           else concat(40700000 + (user_id % 40) * 3700, 'e-6') end as start_lat""",
        "concat(-74020000 + (user_id % 7) * 11300, 'e-6') as start_lng",
        "concat(40700000 + (k % 40) * 3700, 'e-6') as end_lat",
        "concat(-74020000 + (k % 7) * 11300, 'e-6') as end_lng",
        """case event_id % 7 when 0 then 'Subscriber' when 1 then 'Customer' when 2 then 'casual'
           when 3 then 'Guest' when 4 then null else 'Member' end as member_casual""",
    )


RAW_SQL = f"""
raw_events as (
  select *,
    cast(json_extract_string(props, '$.k') as bigint) as k,
    ts + to_days(cast(31 * (user_id % 6) as int)) as begins,
    case when event_id % 61 = 0 then to_microseconds(1000)
         else to_seconds(cast(floor(value * 10) as bigint) - case when event_id % 50 = 0 then 600 else 0 end)
    end as lasts
  from events
),
raw as (
  select
    case when event_id % 97 <> 0 then concat('r', cast(event_id as varchar)) end as ride_id,
    case when event_type in ('click', 'view') then 'Classic_Bike'
         when event_type <> 'error' then 'electric_bike' end as rideable_type,
    case when event_id % 89 = 0 then 'garbage' else cast(begins as varchar) end as started_at,
    case when event_id % 83 = 0 then 'no time' else cast(begins + lasts as varchar) end as ended_at,
    case when event_id % 31 = 0 then null when event_id % 3 = 0 then '{HUB}'
         else concat('Station ', user_id % 40) end as start_station_name,
    case when event_id % 31 <> 0 then concat(user_id % 40, '.10') end as start_station_id,
    case when event_id % 29 <> 0 then concat('Station ', k % 40) end as end_station_name,
    case when event_id % 29 <> 0 then concat(k % 40, '.20') end as end_station_id,
    case when event_id % 41 = 0 then 'n/a'
         else concat(40700000 + (user_id % 40) * 3700, 'e-6') end as start_lat,
    concat(-74020000 + (user_id % 7) * 11300, 'e-6') as start_lng,
    concat(40700000 + (k % 40) * 3700, 'e-6') as end_lat,
    concat(-74020000 + (k % 7) * 11300, 'e-6') as end_lng,
    case event_id % 7 when 0 then 'Subscriber' when 1 then 'Customer' when 2 then 'casual'
         when 3 then 'Guest' when 4 then null else 'Member' end as member_casual
  from raw_events
)"""

TYPED_SQL = f"""{RAW_SQL},
typed as (
  select ride_id, lower(rideable_type) as rideable_type,
    try_cast(started_at as timestamp) as started_at, try_cast(ended_at as timestamp) as ended_at,
    start_station_name, start_station_id, end_station_name, end_station_id,
    try_cast(start_lat as double) as start_lat, try_cast(start_lng as double) as start_lng,
    try_cast(end_lat as double) as end_lat, try_cast(end_lng as double) as end_lng,
    case when lower(member_casual) in ('member', 'subscriber') then 'member'
         when lower(member_casual) in ('casual', 'customer') then 'casual'
         else lower(member_casual) end as member_casual
  from raw
)"""

SILVER_SQL = f"""{TYPED_SQL},
valid as (
  select *,
    cast(floor(epoch(ended_at)) as bigint) - cast(floor(epoch(started_at)) as bigint) as seconds,
    sin((radians(end_lat) - radians(start_lat)) / 2) as sp,
    sin((radians(end_lng) - radians(start_lng)) / 2) as sl
  from typed
  where ride_id is not null and started_at is not null and ended_at is not null
    and ended_at > started_at
),
silver as (
  select ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id,
    end_station_name, end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual,
    seconds / 60.0e0 as trip_duration_minutes,
    cast(started_at as date) as start_date, cast(hour(started_at) as integer) as start_hour,
    dayname(started_at) as day_of_week, cast(dayofweek(started_at) + 1 as integer) as day_of_week_num,
    strftime(started_at, '%Y-%m') as month, dayofweek(started_at) in (0, 6) as is_weekend,
    case when sp * sp + cos(radians(start_lat)) * cos(radians(end_lat)) * sl * sl is not null then
      2 * 6371.0088e0 * asin(sqrt(least(1.0e0,
        sp * sp + cos(radians(start_lat)) * cos(radians(end_lat)) * sl * sl))) end as distance_km,
    seconds
  from valid where seconds > 0
)"""


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_to_silver(raw_trips(spark, sf_dir))


def demand_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip starts in six grid areas within the original month: busy enough for rush hours. One trip
    in 37 has no place, and its hour still counts."""
    lat = F.lit(40.705) + (F.col("user_id") % 6) * F.lit(0.01)
    return events(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("started_at"),
        F.when(F.col("event_id") % 37 != 0, lat).alias("start_lat"),
        F.lit(-73.995).alias("start_lng"),
    )


DEMAND_SQL = """
demand_trips as (
  select ts as started_at,
    case when event_id % 37 <> 0
         then cast(40.705 as double) + cast(user_id % 6 as double) * cast(0.01 as double) end as start_lat,
    cast(-73.995 as double) as start_lng
  from events
)"""


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, which every engine and driver compares alike."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return df.select(
        *[
            F.date_format(name, formats[kind]).alias(name) if kind in formats else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )
