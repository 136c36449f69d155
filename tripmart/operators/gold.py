"""Gold: the eight aggregate tables.

Every table is a sum over additive measures, so it can be built from single trips or from a table
that already sums them by finer keys. ``build_gold`` uses two such tables and scans Silver twice in
all; a single table asked for on its own is one aggregate straight over Silver.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tripmart.functions.trips import ratio, whole_seconds
from tripmart.operators.quality import require_non_empty
from tripmart.session import Stage
from tripmart.sources.tables import GOLD_TABLES, Lakehouse

MEASURES = ("rides", "member_rides", "casual_rides", "seconds", "km", "km_rides")
CALENDAR_KEYS = (
    "start_date",
    "day_of_week",
    "day_of_week_num",
    "start_hour",
    "is_weekend",
    "member_casual",
    "rideable_type",
)
ROUTE_KEYS = ("month", "start_station_name", "end_station_name")


def trip_facts(silver: DataFrame) -> DataFrame:
    """Silver with one column per measure, each to be summed."""

    def one_if(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("long")

    return silver.withColumns(
        {
            "rides": F.lit(1).cast("long"),
            "member_rides": one_if(F.col("member_casual") == "member"),
            "casual_rides": one_if(F.col("member_casual") == "casual"),
            "seconds": whole_seconds(),
            "km": F.col("distance_km"),
            "km_rides": one_if(F.col("distance_km").isNotNull()),
        }
    )


def roll_up(facts: DataFrame, *keys: str) -> DataFrame:
    """The same measures by fewer keys. Spark sums within each task before it shuffles."""
    return facts.groupBy(*keys).agg(*[F.sum(measure).alias(measure) for measure in MEASURES])


def total(measure: str, name: str) -> Column:
    return F.sum(measure).alias(name)


def average_minutes() -> Column:
    """From whole seconds: exact, and so the same however rows are spread."""
    return F.round(F.sum("seconds") / (F.sum("rides") * 60.0), 2).alias("avg_duration_minutes")


def average_km() -> Column:
    return F.round(ratio(F.sum("km"), F.sum("km_rides")), 3).alias("avg_distance_km")


def daily_rides(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.col("start_date").alias("ride_date")).agg(
        total("rides", "total_rides"),
        total("member_rides", "member_rides"),
        total("casual_rides", "casual_rides"),
        average_minutes(),
        average_km(),
    )


def hourly_demand(facts: DataFrame) -> DataFrame:
    return facts.groupBy("day_of_week", "day_of_week_num", "start_hour").agg(
        total("rides", "total_rides"), average_minutes()
    )


def top_stations(facts: DataFrame, station: str, name: str) -> DataFrame:
    named = facts.where(F.col(station).isNotNull())
    return named.groupBy(station).agg(total("rides", name), average_minutes())


def top_start_stations(facts: DataFrame) -> DataFrame:
    return top_stations(facts, "start_station_name", "total_starts")


def top_end_stations(facts: DataFrame) -> DataFrame:
    return top_stations(facts, "end_station_name", "total_ends")


def user_type_behavior(facts: DataFrame) -> DataFrame:
    def rides_when(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("rides")).otherwise(0)).alias(name)

    return facts.groupBy("member_casual").agg(
        total("rides", "total_rides"),
        average_minutes(),
        average_km(),
        rides_when(F.col("is_weekend"), "weekend_rides"),
        rides_when(~F.col("is_weekend"), "weekday_rides"),
    )


def bike_type_usage(facts: DataFrame) -> DataFrame:
    return facts.groupBy("rideable_type").agg(total("rides", "total_rides"), average_minutes(), average_km())


def station_od_pairs(facts: DataFrame) -> DataFrame:
    both_named = facts.where(F.col("start_station_name").isNotNull() & F.col("end_station_name").isNotNull())
    return both_named.groupBy("start_station_name", "end_station_name").agg(
        total("rides", "total_rides"), average_minutes()
    )


def monthly_summary(facts: DataFrame) -> DataFrame:
    """Exact distinct stations: trips are first summed by route, so the two distinct counts go over
    routes and not over trips."""
    return monthly_of_routes(roll_up(facts, *ROUTE_KEYS))


def monthly_of_routes(routes: DataFrame) -> DataFrame:
    """``monthly_summary`` of trips that are summed by route already."""
    return routes.groupBy("month").agg(
        total("rides", "total_rides"),
        total("member_rides", "member_rides"),
        total("casual_rides", "casual_rides"),
        average_minutes(),
        average_km(),
        F.count_distinct("start_station_name").alias("unique_start_stations"),
        F.count_distinct("end_station_name").alias("unique_end_stations"),
    )


@dataclass(frozen=True)
class Mart:
    """How a Gold table is built, from which staged sums, in which order it is shown, and stored.

    ``from_sums`` builds it from the staged sums where that takes less than ``build``.
    """

    build: Callable[[DataFrame], DataFrame]
    source: str
    order: tuple[str, ...]
    largest_first: bool = False
    hidden: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = field(default=())
    from_sums: Callable[[DataFrame], DataFrame] | None = None

    def stored(self, sums: DataFrame) -> DataFrame:
        """The table as it is written: in no order, which readers give it."""
        return (self.from_sums or self.build)(sums).drop(*self.hidden)

    def sorted(self, table: DataFrame) -> DataFrame:
        """By the leading column of ``order``, largest first where asked for; the rest break ties."""
        first = F.col(self.order[0])
        first = first.desc() if self.largest_first else first.asc()
        return table.orderBy(first, *[F.col(column).asc() for column in self.order[1:]])

    def shown(self, facts: DataFrame) -> DataFrame:
        return self.sorted(self.build(facts)).drop(*self.hidden)


MARTS = {
    "gold_daily_rides": Mart(daily_rides, "calendar", ("ride_date",), partition_by=("ride_date",)),
    "gold_hourly_demand": Mart(
        hourly_demand, "calendar", ("day_of_week_num", "start_hour"), hidden=("day_of_week_num",)
    ),
    "gold_top_start_stations": Mart(
        top_start_stations, "routes", ("total_starts", "start_station_name"), largest_first=True
    ),
    "gold_top_end_stations": Mart(
        top_end_stations, "routes", ("total_ends", "end_station_name"), largest_first=True
    ),
    "gold_user_type_behavior": Mart(
        user_type_behavior, "calendar", ("total_rides", "member_casual"), largest_first=True
    ),
    "gold_bike_type_usage": Mart(
        bike_type_usage, "calendar", ("total_rides", "rideable_type"), largest_first=True
    ),
    "gold_station_od_pairs": Mart(
        station_od_pairs,
        "routes",
        ("total_rides", "start_station_name", "end_station_name"),
        largest_first=True,
    ),
    "gold_monthly_summary": Mart(monthly_summary, "routes", ("month",), from_sums=monthly_of_routes),
}


def gold_table(silver: DataFrame, name: str) -> DataFrame:
    """One Gold table straight from Silver, in its order."""
    return MARTS[name].shown(trip_facts(silver))


def build_gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """All eight Gold tables by name, each in its order; nothing runs until one is used."""
    return {name: gold_table(silver, name) for name in GOLD_TABLES}


def stage_sums(silver: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    """The two summed tables all Gold tables can be built from.

    Their size follows calendar hours and station pairs, not trips.
    """
    facts = trip_facts(silver)
    return {
        "calendar": stage.table(roll_up(facts, *CALENDAR_KEYS), "calendar_sums"),
        "routes": stage.table(roll_up(facts, *ROUTE_KEYS), "route_sums"),
    }


def build_gold(lakehouse: Lakehouse, stage: Stage | None = None) -> dict[str, int]:
    """Silver table to the eight Gold tables; returns the rows stored in each.

    The tables come from the staged sums and do not depend on each other, so their small jobs run
    side by side.
    """
    silver = require_non_empty(lakehouse.read("silver"), "Silver trip table")
    sums = stage_sums(silver, stage or Stage(lakehouse.spark))

    def store(name: str) -> int:
        mart = MARTS[name]
        table = mart.stored(sums[mart.source])
        if mart.partition_by:
            # A day is one row and so one file; dealt out in turn, the files are written by all slots.
            table = table.repartition(lakehouse.spark.sparkContext.defaultParallelism)
        return lakehouse.write(table, name, mart.partition_by, needed_for=name)

    with ThreadPoolExecutor(len(MARTS)) as pool:
        return dict(zip(MARTS, pool.map(store, MARTS)))
