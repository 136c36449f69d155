"""Demand panel: one row per grid area and hour, with lags and rush-hour labels.

Trips are summed once to a table of areas by hours, and everything else is derived from that table,
whose size follows the calendar and the number of areas, not the number of trips.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripmart.functions.geo import area_id
from tripmart.functions.trips import is_weekend_day
from tripmart.session import Stage

LAGS = (1, 2, 24, 168)
TRAIN_SHARE = 0.8
HOUR = "timestamp_hour"
PANEL_COLUMNS = (
    HOUR,
    "area_id",
    "demand_count",
    "hour_of_day",
    "day_of_week",
    "month_of_year",
    "day_of_week_num",
    "is_weekend",
    *[f"lag_{lag}" for lag in LAGS],
    "split",
    "rush_threshold",
    "is_rush_area",
)


@dataclass(frozen=True)
class PanelOptions:
    """``scope``: rank areas by trips of the ``train`` hours, or of ``all`` hours.
    ``spine``: hours run over all ``trips``, or over those of the ``top_areas``.
    ``quantile``: ``approx`` gives an observed count, ``exact`` interpolates between two.
    """

    top_areas: int = 150
    rush_quantile: float = 0.9
    min_threshold: int = 3
    scope: str = "train"
    spine: str = "trips"
    quantile: str = "approx"

    def __post_init__(self):
        allowed = {"scope": ("train", "all"), "spine": ("trips", "top_areas"), "quantile": ("approx", "exact")}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")
        if self.spine == "top_areas" and self.scope == "train":
            raise ValueError("spine='top_areas' needs scope='all': train hours depend on the spine")


# The settings of the whole-period variant: areas and hours from all trips, interpolated threshold.
WHOLE_PERIOD = PanelOptions(scope="all", spine="top_areas", quantile="exact")


def truncate_hour(column: str = "started_at") -> Column:
    return F.date_trunc("hour", F.col(column).cast("timestamp"))


def demand_by_area_hour(trips: DataFrame) -> DataFrame:
    """Trips per area and hour, with the coordinate sums that the area centres need.

    Trips without coordinates have no area; they stay as rows with a NULL area, since their hours
    still count for the calendar.
    """
    located = trips.select(
        area_id().alias("area_id"), truncate_hour().alias(HOUR), "start_lat", "start_lng"
    )
    return located.groupBy("area_id", HOUR).agg(
        F.count("*").alias("demand_count"),
        F.sum("start_lat").alias("lat_sum"),
        F.sum("start_lng").alias("lng_sum"),
    )


def hour_range(demand: DataFrame) -> DataFrame:
    """One row: first and last hour, how many hours that is, and the first test hour.

    The hours have no gaps, so the hour at 80 % of them is found by arithmetic.
    """
    ends = demand.agg(F.min(HOUR).alias("first_hour"), F.max(HOUR).alias("last_hour"))
    seconds = F.unix_seconds("last_hour") - F.unix_seconds("first_hour")
    counted = ends.withColumn("hours", (seconds / 3600).cast("long") + 1)
    train_hours = F.floor(F.col("hours") * F.lit(TRAIN_SHARE))
    split_second = F.unix_seconds("first_hour") + train_hours * 3600
    return counted.withColumn("split_hour", F.timestamp_seconds(split_second))


def hour_spine(hours: DataFrame) -> DataFrame:
    """Every hour from the first to the last."""
    return hours.select(_hours_between(F.col("first_hour"), F.col("last_hour")))


def _hours_between(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias(HOUR)


def split_of(hours: DataFrame) -> Column:
    split_hour = hours.select("split_hour").scalar()
    return F.when(F.col(HOUR) < split_hour, "train").otherwise("test")


def top_areas(demand: DataFrame, limit: int = 150, before: Column | None = None) -> DataFrame:
    """Areas with the most trips, of hours ``before`` a given one if set; ties by area id."""
    placed = demand.where(F.col("area_id").isNotNull())
    if before is not None:
        placed = placed.where(F.col(HOUR) < before)
    ranked = placed.groupBy("area_id").agg(F.sum("demand_count").alias("trips"))
    return ranked.orderBy(F.desc("trips"), "area_id").limit(limit)


def keep_areas(demand: DataFrame, areas: DataFrame) -> DataFrame:
    """Demand of the given areas only. A limited list has a known size, so Spark chooses the join by it."""
    return demand.join(areas.select("area_id"), "area_id", "left_semi")


def dense_panel(demand: DataFrame, areas: DataFrame, hours: DataFrame) -> DataFrame:
    """A row for every area and hour, 0 where there was no trip.

    Each area lists its own hours with a count of 0, and demand is added on top. One shuffle by area
    serves this sum and the lag and threshold windows after it; no join is needed.
    """
    bounds = [hours.select(name).scalar() for name in ("first_hour", "last_hour")]
    # A ranked list is one partition: areas are dealt out before each becomes as many rows as there are hours.
    # Both sides name the number of partitions, or adaptive execution would merge so few rows again.
    spread = int(areas.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = areas.select("area_id").repartition(spread, "area_id")
    zeros = listed.select("area_id", _hours_between(*bounds)).withColumn("demand_count", F.lit(0).cast("long"))
    counted = demand.select("area_id", HOUR, "demand_count")
    rows = zeros.unionByName(counted).repartition(spread, "area_id")
    return rows.groupBy("area_id", HOUR).agg(F.sum("demand_count").alias("demand_count"))


def add_calendar(panel: DataFrame) -> DataFrame:
    return panel.withColumns(
        {
            "hour_of_day": F.hour(HOUR),
            "day_of_week": F.date_format(HOUR, "EEEE"),
            "month_of_year": F.month(HOUR),
            "day_of_week_num": F.dayofweek(HOUR),
            "is_weekend": is_weekend_day(F.dayofweek(HOUR)).cast("int"),
        }
    )


def add_lags(panel: DataFrame) -> DataFrame:
    """Demand 1, 2, 24 and 168 hours before, 0 where that is before the first hour."""
    by_hour = Window.partitionBy("area_id").orderBy(HOUR)
    return panel.withColumns({f"lag_{lag}": F.lag("demand_count", lag, 0).over(by_hour) for lag in LAGS})


def train_quantile(quantile: float, kind: str) -> Column:
    demand = F.when(F.col("split") == "train", F.col("demand_count"))
    return F.percentile(demand, quantile) if kind == "exact" else F.percentile_approx(demand, quantile)


def add_rush_threshold(panel: DataFrame, options: PanelOptions = PanelOptions()) -> DataFrame:
    """Quantile of each area's train hours, at least the minimum; also without any train hour."""
    per_area = train_quantile(options.rush_quantile, options.quantile).over(Window.partitionBy("area_id"))
    return panel.withColumn("rush_threshold", F.greatest(per_area, F.lit(options.min_threshold)))


def add_rush_label(panel: DataFrame) -> DataFrame:
    is_rush = F.col("demand_count") >= F.col("rush_threshold")
    return panel.withColumn("is_rush_area", F.when(is_rush, 1).otherwise(0))


def area_centroids(demand: DataFrame) -> DataFrame:
    """Mean start point of each area; trips without an area are left out."""
    placed = demand.where(F.col("area_id").isNotNull())
    trips = F.sum("demand_count")
    return placed.groupBy("area_id").agg(
        (F.sum("lat_sum") / trips).alias("lat"), (F.sum("lng_sum") / trips).alias("lng")
    )


@dataclass(frozen=True)
class RushPanel:
    """The labelled panel and what belongs to it, all as DataFrames."""

    data: DataFrame
    centroids: DataFrame
    areas: DataFrame
    hours: DataFrame
    options: PanelOptions


def build_rush_panel(
    trips: DataFrame, options: PanelOptions = PanelOptions(), stage: Stage | None = None
) -> RushPanel:
    """Trips (``started_at``, ``start_lat``, ``start_lng``) to the labelled panel.

    The sums by area and hour, and the panel, are written once and read back, to a new ``Stage`` unless
    one is given, so trips are scanned a single time.
    """
    stage = stage or Stage(trips.sparkSession)
    demand = stage.table(demand_by_area_hour(trips), "area_hours")
    hours = hour_range(demand)
    if options.scope == "train":
        areas = top_areas(demand, options.top_areas, before=hours.select("split_hour").scalar())
    else:
        areas = top_areas(demand, options.top_areas)
    kept = keep_areas(demand, areas)
    if options.spine == "top_areas":
        hours = hour_range(kept)
    panel = dense_panel(kept, areas, hours)
    panel = add_lags(panel).withColumn("split", split_of(hours))
    panel = add_rush_label(add_rush_threshold(panel, options))
    panel = stage.table(add_calendar(panel).select(*PANEL_COLUMNS), "panel")
    return RushPanel(panel, area_centroids(demand), areas, hours, options)


def split_summary(panel: DataFrame) -> DataFrame:
    return panel.groupBy(F.initcap("split").alias("split")).agg(
        F.min(HOUR).alias("start_time"), F.max(HOUR).alias("end_time"), F.count("*").alias("total_rows")
    )


def panel_summary(panel: DataFrame) -> DataFrame:
    """One row: areas, rows, rush rows and their percentage, median threshold over the areas."""
    per_area = panel.groupBy("area_id").agg(
        F.count("*").alias("rows"),
        F.sum("is_rush_area").alias("rush"),
        F.max("rush_threshold").alias("threshold"),
    )
    rush, rows = F.sum("rush"), F.sum("rows")
    numbers = per_area.agg(
        F.count("*").alias("areas"),
        F.coalesce(rows, F.lit(0)).alias("total_rows"),
        F.coalesce(rush, F.lit(0)).alias("rush_rows"),
        F.round(rush * 100.0 / rows, 2).cast("double").alias("rush_pct"),
        F.percentile("threshold", 0.5).alias("median_threshold"),
    )
    text = F.concat(F.col("rush_rows").cast("string"), F.format_string(" (%.2f%%)", "rush_pct"))
    return numbers.withColumn("rush_text", text)


def area_summary(panel: DataFrame, top_n: int = 10) -> DataFrame:
    per_area = panel.groupBy("area_id").agg(
        F.sum("demand_count").alias("total_demand"),
        F.max("rush_threshold").alias("rush_threshold"),
        F.sum("is_rush_area").alias("rush_hours"),
    )
    return per_area.orderBy(F.desc("total_demand"), "area_id").limit(top_n)


def area_map_layer(panel: DataFrame, centroids: DataFrame, metric: str = "total_demand") -> DataFrame:
    """Circle per area: place, value, radius and colour, and the centre of the whole map.

    ``metric`` is ``total_demand`` or ``mean_demand``. The result has a row per panel area.
    """
    value = F.sum("demand_count").cast("double") if metric == "total_demand" else F.avg("demand_count")
    values = panel.groupBy("area_id").agg(value.alias("value")).join(centroids, "area_id")
    # One subquery for all three numbers.
    whole_map = values.agg(
        F.struct(
            F.max("value").alias("largest"), F.avg("lat").alias("map_lat"), F.avg("lng").alias("map_lng")
        ).alias("numbers")
    ).scalar()
    largest = whole_map.getField("largest")
    scale = F.when(largest > 0, largest).otherwise(1.0)
    return values.withColumns(
        {
            "radius": 5 + 15 * F.col("value") / scale,
            "color": F.when(F.col("value") > 0, "crimson").otherwise("blue"),
            "map_lat": whole_map.getField("map_lat"),
            "map_lng": whole_map.getField("map_lng"),
        }
    )
