"""Data behind the dashboard: charts, filters, headline numbers and month-on-month growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.functions.trips import ratio
from tripmart.operators.gold import average_km, average_minutes, trip_facts
from tripmart.plans.serving import largest

FILTER_COLUMNS = ("month", "member_casual", "rideable_type", "start_station_name")
LABEL_FROM_PCT = 5


def sum_of(column: str) -> Column:
    return F.sum(column).alias(column)


def avg_of(column: str) -> Column:
    return F.avg(column).alias(column)


def chart_daily_total(daily: DataFrame) -> DataFrame:
    day = F.to_date(F.date_trunc("day", "ride_date")).alias("ride_date")
    return daily.groupBy(day).agg(sum_of("total_rides")).orderBy("ride_date")


def chart_daily_member_casual(daily: DataFrame) -> DataFrame:
    sums = daily.groupBy("ride_date").agg(sum_of("member_rides"), sum_of("casual_rides"))
    return sums.orderBy("ride_date")


def chart_hour_dow_heatmap(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("start_hour", "day_of_week").agg(sum_of("total_rides"))


def chart_top_start(stations: DataFrame, limit: int = 20) -> DataFrame:
    sums = stations.groupBy("start_station_name").agg(sum_of("total_starts"))
    return largest(sums, "total_starts", "start_station_name", limit=limit)


def chart_top_end(stations: DataFrame, limit: int = 20) -> DataFrame:
    sums = stations.groupBy("end_station_name").agg(sum_of("total_ends"))
    return largest(sums, "total_ends", "end_station_name", limit=limit)


def chart_member_share(users: DataFrame) -> DataFrame:
    """Rides per rider type, their percentage of all, and whether the slice gets a label."""
    sums = users.groupBy("member_casual").agg(sum_of("total_rides"))
    everything = users.agg(F.sum("total_rides").alias("rides")).scalar()
    percent = F.col("total_rides") * 100.0 / everything
    return sums.withColumns(
        {
            "share_pct": F.round(percent, 2).cast("double"),
            "label_shown": percent >= LABEL_FROM_PCT,
        }
    )


def chart_user_table(users: DataFrame) -> DataFrame:
    table = users.groupBy("member_casual").agg(
        sum_of("total_rides"), avg_of("avg_duration_minutes"), avg_of("avg_distance_km")
    )
    return largest(table, "total_rides", "member_casual")


def chart_bike_type(bikes: DataFrame, limit: int = 10) -> DataFrame:
    sums = bikes.groupBy("rideable_type").agg(sum_of("total_rides"))
    return largest(sums, "total_rides", "rideable_type", limit=limit)


def chart_od_table(pairs: DataFrame, limit: int = 30) -> DataFrame:
    keys = ("start_station_name", "end_station_name")
    table = pairs.groupBy(*keys).agg(sum_of("total_rides"), avg_of("avg_duration_minutes"))
    return largest(table, "total_rides", *keys, limit=limit)


def chart_monthly_total(monthly: DataFrame, limit: int | None = 12) -> DataFrame:
    """Months with the fewest rides first.

    The chart shows ``limit`` rows, of a longer history those with the fewest rides; ``None`` gives all months.
    """
    sums = monthly.groupBy("month").agg(sum_of("total_rides")).orderBy("total_rides", "month")
    return sums if limit is None else sums.limit(limit)


def chart_monthly_table(monthly: DataFrame) -> DataFrame:
    table = monthly.groupBy("month").agg(
        sum_of("total_rides"),
        sum_of("member_rides"),
        sum_of("casual_rides"),
        avg_of("avg_duration_minutes"),
        avg_of("avg_distance_km"),
    )
    return table.orderBy("total_rides", "month")


def filter_trips(
    silver: DataFrame,
    first_date: str | None = None,
    last_date: str | None = None,
    **chosen: str | Sequence[str],
) -> DataFrame:
    """Silver limited to the dashboard filters; build Gold tables from it.

    Dates are ``yyyy-MM-dd``, both included; the other filters take one value or several. The Gold
    tables lack most filter columns. On a stored Silver table ``month`` and the dates read only the
    partitions asked for.
    """
    if first_date is not None:
        silver = silver.where((F.col("month") >= first_date[:7]) & (F.col("start_date") >= first_date))
    if last_date is not None:
        silver = silver.where((F.col("month") <= last_date[:7]) & (F.col("start_date") <= last_date))
    for column, values in chosen.items():
        if column not in FILTER_COLUMNS:
            raise ValueError(f"No filter on {column}; choose from {FILTER_COLUMNS}")
        values = [values] if isinstance(values, str) else list(values)
        silver = silver.where(F.col(column).isin(*values))
    return silver


def headline_numbers(silver: DataFrame) -> DataFrame:
    """One row of totals; averages are over rides, not over the averages of groups."""
    monthly = (
        trip_facts(silver)
        .groupBy("month")
        .agg(*[sum_of(name) for name in ("rides", "member_rides", "casual_rides", "seconds", "km", "km_rides")])
    )
    rides, months = F.sum("rides"), F.count("*")
    return monthly.agg(
        F.coalesce(rides, F.lit(0)).alias("total_rides"),
        months.alias("total_months"),
        F.round(ratio(rides, months), 2).alias("rides_per_month"),
        average_minutes(),
        average_km(),
        F.round(ratio(F.sum("member_rides"), F.sum("casual_rides")), 4).alias("member_casual_ratio"),
    )


def month_growth(monthly: DataFrame) -> DataFrame:
    """Change against the calendar month before; NULL where the table has no such month."""
    following = F.date_format(F.add_months(F.to_date(F.concat("month", F.lit("-01"))), 1), "yyyy-MM")
    before = monthly.select(following.alias("month"), F.col("total_rides").alias("previous_rides"))
    change = F.col("total_rides") - F.col("previous_rides")
    percent = change * 100.0 / F.nullif(F.col("previous_rides"), F.lit(0))
    return (
        monthly.select("month", "total_rides")
        .join(before, "month", "left")
        .withColumns({"rides_change": change, "change_pct": F.round(percent, 2).cast("double")})
        .orderBy("month")
    )
