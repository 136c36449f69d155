"""Checks of the Gold tables, the serving queries and the dashboard data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tripmart.checks.adapters import SILVER_SQL, silver_trips
from tripmart.checks.registry import check, day_text, half_up
from tripmart.operators.gold import build_gold, build_gold_tables, gold_table
from tripmart.plans import dashboard, serving
from tripmart.session import Stage
from tripmart.sources.tables import GOLD_TABLES, Lakehouse

MINUTES = half_up("sum(seconds) / (60.0e0 * count(*))", 2) + " as avg_duration_minutes"
KM = half_up("avg(distance_km)", 3) + " as avg_distance_km"
RIDERS = """count(*) as total_rides,
    count(*) filter (member_casual = 'member') as member_rides,
    count(*) filter (member_casual = 'casual') as casual_rides"""

GOLD_SQL = {
    "gold_daily_rides": f"""select {day_text("start_date")} as ride_date, {RIDERS}, {MINUTES}, {KM}
        from silver group by start_date""",
    "gold_hourly_demand": f"""select day_of_week, start_hour, count(*) as total_rides, {MINUTES}
        from silver group by day_of_week, start_hour""",
    "gold_top_start_stations": f"""select start_station_name, count(*) as total_starts, {MINUTES}
        from silver where start_station_name is not null group by start_station_name""",
    "gold_top_end_stations": f"""select end_station_name, count(*) as total_ends, {MINUTES}
        from silver where end_station_name is not null group by end_station_name""",
    "gold_user_type_behavior": f"""select member_casual, count(*) as total_rides, {MINUTES}, {KM},
        count(*) filter (is_weekend) as weekend_rides, count(*) filter (not is_weekend) as weekday_rides
        from silver group by member_casual""",
    "gold_bike_type_usage": f"""select rideable_type, count(*) as total_rides, {MINUTES}, {KM}
        from silver group by rideable_type""",
    "gold_station_od_pairs": f"""select start_station_name, end_station_name, count(*) as total_rides,
        {MINUTES} from silver where start_station_name is not null and end_station_name is not null
        group by start_station_name, end_station_name""",
    "gold_monthly_summary": f"""select month, {RIDERS}, {MINUTES}, {KM},
        count(distinct start_station_name) as unique_start_stations,
        count(distinct end_station_name) as unique_end_stations
        from silver group by month""",
}


def over(table: str, query: str) -> str:
    """SQL over one Gold table, named ``t``."""
    return f"with {SILVER_SQL}, t as ({GOLD_SQL[table]}) {query}"


def _register_gold(table: str) -> None:
    @check(table, over(table, "select * from t"))
    def gold_check(spark, sf_dir):
        return gold_table(silver_trips(spark, sf_dir), table)


for _table in GOLD_TABLES:
    _register_gold(_table)


def _register_view(name: str, table: str, view, query: str) -> None:
    """A serving query or chart over one Gold table."""

    @check(name, over(table, query))
    def view_check(spark, sf_dir):
        return view(gold_table(silver_trips(spark, sf_dir), table))


DAILY, HOURLY = "gold_daily_rides", "gold_hourly_demand"
STARTS, ENDS, PAIRS = "gold_top_start_stations", "gold_top_end_stations", "gold_station_od_pairs"
USERS, BIKES, MONTHS = "gold_user_type_behavior", "gold_bike_type_usage", "gold_monthly_summary"

_register_view(
    "q_top_days", DAILY, serving.top_days, "select * from t order by total_rides desc, ride_date limit 10"
)
_register_view(
    "q_peak_hours",
    HOURLY,
    serving.peak_hours,
    "select * from t order by total_rides desc, day_of_week, start_hour limit 10",
)
_register_view(
    "q_top_start_stations",
    STARTS,
    serving.top_start_stations,
    "select * from t order by total_starts desc, start_station_name limit 20",
)
_register_view(
    "q_top_end_stations",
    ENDS,
    serving.top_end_stations,
    "select * from t order by total_ends desc, end_station_name limit 20",
)
_register_view("q_user_behavior", USERS, serving.user_behavior, "select * from t order by total_rides desc")
_register_view(
    "q_weekend_share",
    USERS,
    serving.weekend_share,
    f"""select *, {half_up("weekend_rides * 100.0e0 / nullif(total_rides, 0)", 2)} as weekend_share_pct
    from t""",
)
_register_view("q_bike_usage", BIKES, serving.bike_usage, "select * from t order by total_rides desc")
_register_view(
    "q_top_od_pairs",
    PAIRS,
    serving.top_od_pairs,
    "select * from t order by total_rides desc, start_station_name, end_station_name limit 20",
)

_register_view(
    "chart_daily_total", DAILY, dashboard.chart_daily_total, "select ride_date, total_rides from t"
)
_register_view(
    "chart_daily_member_casual",
    DAILY,
    dashboard.chart_daily_member_casual,
    "select ride_date, member_rides, casual_rides from t",
)
_register_view(
    "chart_hour_dow_heatmap",
    HOURLY,
    dashboard.chart_hour_dow_heatmap,
    "select start_hour, day_of_week, total_rides from t",
)
_register_view(
    "chart_top_start",
    STARTS,
    dashboard.chart_top_start,
    """select start_station_name, total_starts from t
    order by total_starts desc, start_station_name limit 20""",
)
_register_view(
    "chart_top_end",
    ENDS,
    dashboard.chart_top_end,
    "select end_station_name, total_ends from t order by total_ends desc, end_station_name limit 20",
)
_register_view(
    "chart_member_share",
    USERS,
    dashboard.chart_member_share,
    f"""select member_casual, total_rides,
    {half_up("total_rides * 100.0e0 / sum(total_rides) over ()", 2)} as share_pct,
    total_rides * 100.0e0 / sum(total_rides) over () >= 5 as label_shown from t""",
)
_register_view(
    "chart_user_table",
    USERS,
    dashboard.chart_user_table,
    "select member_casual, total_rides, avg_duration_minutes, avg_distance_km from t",
)
_register_view(
    "chart_bike_type",
    BIKES,
    dashboard.chart_bike_type,
    "select rideable_type, total_rides from t order by total_rides desc, rideable_type limit 10",
)
_register_view(
    "chart_od_table",
    PAIRS,
    dashboard.chart_od_table,
    """select start_station_name, end_station_name, total_rides, avg_duration_minutes from t
    order by total_rides desc, start_station_name, end_station_name limit 30""",
)
_register_view(
    "chart_monthly_total",
    MONTHS,
    dashboard.chart_monthly_total,
    "select month, total_rides from t order by total_rides, month limit 12",
)
_register_view(
    "chart_monthly_table",
    MONTHS,
    dashboard.chart_monthly_table,
    """select month, total_rides, member_rides, casual_rides, avg_duration_minutes, avg_distance_km
    from t""",
)
_register_view(
    "dash_mom_growth",
    MONTHS,
    dashboard.month_growth,
    f"""select t.month, t.total_rides, p.total_rides as previous_rides,
    t.total_rides - p.total_rides as rides_change,
    {half_up("(t.total_rides - p.total_rides) * 100.0e0 / nullif(p.total_rides, 0)", 2)} as change_pct
    from t left join t p
      on p.month = strftime(strptime(t.month || '-01', '%Y-%m-%d') - interval 1 month, '%Y-%m')""",
)


@check(
    "dash_filters",
    f"""with {SILVER_SQL}, chosen as (
      select * from silver where month in ('2024-02', '2024-03') and member_casual = 'member'
        and rideable_type = 'electric_bike')
    {GOLD_SQL[DAILY].replace("from silver", "from chosen")}""",
)
def dash_filters_check(spark, sf_dir):
    """Over a stored Silver table, where the months chosen are the only ones read."""
    lakehouse = Lakehouse(spark, Stage(spark).root)
    lakehouse.write(silver_trips(spark, sf_dir), "silver", ("month",))
    chosen = dashboard.filter_trips(
        lakehouse.read("silver"),
        month=["2024-02", "2024-03"],
        member_casual="member",
        rideable_type="electric_bike",
    )
    return build_gold_tables(chosen)[DAILY]


@check(
    "dash_filter_dates",
    f"""with {SILVER_SQL}, chosen as (
      select * from silver where start_date between date '2024-02-10' and date '2024-03-20'
        and start_station_name in ('Station 1', 'Station 2'))
    {GOLD_SQL[PAIRS].replace("from silver", "from chosen")}""",
)
def dash_filter_dates_check(spark, sf_dir):
    chosen = dashboard.filter_trips(
        silver_trips(spark, sf_dir),
        "2024-02-10",
        "2024-03-20",
        start_station_name=["Station 1", "Station 2"],
    )
    return build_gold_tables(chosen)[PAIRS]


@check(
    "dash_kpis",
    f"""with {SILVER_SQL} select count(*) as total_rides, count(distinct month) as total_months,
      {half_up("count(*) * 1.0e0 / count(distinct month)", 2)} as rides_per_month, {MINUTES}, {KM},
      {half_up('''count(*) filter (member_casual = 'member') * 1.0e0
        / count(*) filter (member_casual = 'casual')''', 4)} as member_casual_ratio
    from silver""",
)
def dash_kpis_check(spark, sf_dir):
    return dashboard.headline_numbers(silver_trips(spark, sf_dir))


@check(
    "gold_build",
    f"""with {SILVER_SQL}, {", ".join(f"{name} as ({sql})" for name, sql in GOLD_SQL.items())}
    {" union all ".join(
        f"select '{name}' as table_name, count(*) as rows, cast(sum({measure}) as bigint) as rides from {name}"
        for name, measure in zip(GOLD_SQL, (
            "total_rides", "total_rides", "total_starts", "total_ends", "total_rides", "total_rides",
            "total_rides", "total_rides"))
    )}""",
)
def gold_build_check(spark, sf_dir):
    """All eight stored tables: their rows, and the rides they add up to."""
    lakehouse = Lakehouse(spark, Stage(spark).root)
    lakehouse.write(silver_trips(spark, sf_dir), "silver", ("month",))
    build_gold(lakehouse)
    tables = []
    for name in GOLD_TABLES:
        stored = lakehouse.read(name)
        measure = next(column for column in stored.columns if column.startswith("total_"))
        tables.append(
            stored.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("rows"),
                F.sum(measure).alias("rides"),
            )
        )
    return reduce(DataFrame.unionByName, tables)
