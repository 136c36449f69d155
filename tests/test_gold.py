from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tripmart.checks.adapters import silver_trips
from tripmart.operators.gold import MARTS, build_gold_tables, gold_table, stage_sums, trip_facts
from tripmart.operators.silver import transform_to_silver
from tripmart.plans import dashboard, serving
from tripmart.session import Stage

SF = "/root/testdata/sf0.001"


def rows(df):
    return [row.asDict() for row in df.collect()]


def rounded(value, digits):
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def test_demo_trips(demo_trips):
    tables = build_gold_tables(transform_to_silver(demo_trips))
    assert [(str(row["ride_date"]), row["total_rides"]) for row in rows(tables["gold_daily_rides"])] == [
        ("2023-05-01", 1),
        ("2023-05-06", 1),
        ("2023-05-07", 1),
        ("2023-05-09", 1),
    ]
    (month,) = rows(tables["gold_monthly_summary"])
    assert month["month"] == "2023-05" and month["total_rides"] == 4
    assert (month["member_rides"], month["casual_rides"]) == (2, 2)
    assert (month["unique_start_stations"], month["unique_end_stations"]) == (4, 4)
    assert month["avg_duration_minutes"] == 16.63
    assert len(rows(tables["gold_station_od_pairs"])) == 4
    users = {row["member_casual"]: row for row in rows(tables["gold_user_type_behavior"])}
    assert users["member"]["avg_duration_minutes"] == 10.5
    assert (users["casual"]["weekend_rides"], users["casual"]["weekday_rides"]) == (1, 1)
    assert [row["day_of_week"] for row in rows(tables["gold_hourly_demand"])] == [
        "Sunday", "Monday", "Tuesday", "Saturday",
    ]


def test_unknown_riders_count_only_in_the_total(text_trips):
    riders = ["Guest", None, "member"]
    trips = text_trips(*[{"ride_id": str(at), "member_casual": rider} for at, rider in enumerate(riders)])
    (day,) = rows(gold_table(transform_to_silver(trips), "gold_daily_rides"))
    assert (day["total_rides"], day["member_rides"], day["casual_rides"]) == (3, 1, 0)


def test_no_distance_at_all(text_trips):
    (day,) = rows(gold_table(transform_to_silver(text_trips({"start_lat": None})), "gold_daily_rides"))
    assert day["avg_distance_km"] is None and day["avg_duration_minutes"] == 12.0


def test_unnamed_stations(text_trips):
    silver = transform_to_silver(
        text_trips(
            {"ride_id": "1"},
            {"ride_id": "2", "start_station_name": None},
            {"ride_id": "3", "end_station_name": None},
        )
    )
    tables = build_gold_tables(silver)
    assert [row["total_starts"] for row in rows(tables["gold_top_start_stations"])] == [2]
    assert [row["total_ends"] for row in rows(tables["gold_top_end_stations"])] == [2]
    assert [row["total_rides"] for row in rows(tables["gold_station_od_pairs"])] == [1]
    assert rows(tables["gold_monthly_summary"])[0]["total_rides"] == 3


@pytest.mark.parametrize("name", MARTS)
def test_tables_from_staged_sums_equal_tables_from_trips(spark, name):
    silver = silver_trips(spark, SF)
    sums = stage_sums(silver, Stage(spark))
    mart = MARTS[name]
    assert rows(mart.shown(sums[mart.source])) == rows(gold_table(silver, name))


def test_station_ranking_by_brute_force(spark):
    silver = silver_trips(spark, SF)
    rides = defaultdict(list)
    for trip in silver.select("start_station_name", "trip_duration_minutes").collect():
        rides[trip.start_station_name].append(round(trip.trip_duration_minutes * 60))
    rides.pop(None)
    expected = [
        (station, len(seconds), rounded(sum(seconds) / (60.0 * len(seconds)), 2))
        for station, seconds in sorted(rides.items(), key=lambda item: (-len(item[1]), item[0]))
    ]
    found = [tuple(row) for row in gold_table(silver, "gold_top_start_stations").collect()]
    assert found == expected
    assert found[0][1] > sum(count for _, count, _ in found) / 4, "one station holds a large share"


def test_whole_seconds_come_back_exactly(spark):
    minutes = spark.range(1, 200_000).selectExpr("id as seconds_in", "id / 60.0D as trip_duration_minutes")
    facts = trip_facts(minutes.selectExpr("*", "'x' as member_casual", "1.0D as distance_km"))
    assert facts.where("seconds <> seconds_in").isEmpty()


def test_top_queries_break_ties_by_key(spark):
    pairs = spark.createDataFrame(
        [("b", "x", 5, 1.0), ("a", "y", 5, 1.0), ("a", "x", 5, 1.0), ("c", "z", 9, 1.0)],
        "start_station_name string, end_station_name string, total_rides bigint, avg_duration_minutes double",
    )
    top = serving.top_od_pairs(pairs, 3).collect()
    assert [(row[0], row[1]) for row in top] == [("c", "z"), ("a", "x"), ("a", "y")]


def test_weekend_share_of_nothing(spark):
    schema = "member_casual string, total_rides bigint, weekend_rides bigint"
    users = spark.createDataFrame([("x", 0, 0)], schema)
    assert serving.weekend_share(users).first().weekend_share_pct is None


def test_filters(spark):
    silver = silver_trips(spark, SF)
    chosen = dashboard.filter_trips(silver, month=["2024-01", "2024-02"], member_casual="member")
    expected = silver.where("month in ('2024-01', '2024-02') and member_casual = 'member'").count()
    assert chosen.count() == expected > 0
    with pytest.raises(ValueError, match="end_station_name"):
        dashboard.filter_trips(silver, end_station_name="x")


def test_growth_over_a_gap(spark):
    months = [("2024-04", 0), ("2024-01", 10), ("2024-02", 15), ("2024-05", 3)]
    monthly = spark.createDataFrame(months, "month string, total_rides bigint")
    assert [tuple(row) for row in dashboard.month_growth(monthly).collect()] == [
        ("2024-01", 10, None, None, None),
        ("2024-02", 15, 10, 5, 50.0),
        ("2024-04", 0, None, None, None),
        ("2024-05", 3, 0, 3, None),
    ]


def test_growth_over_new_year(spark):
    monthly = spark.createDataFrame([("2023-12", 4), ("2024-01", 6)], "month string, total_rides bigint")
    assert tuple(dashboard.month_growth(monthly).collect()[1]) == ("2024-01", 6, 4, 2, 50.0)


def test_monthly_chart_of_a_long_history(spark):
    months = [(f"20{23 + at // 12}-{at % 12 + 1:02}", 100 - at) for at in range(14)]
    monthly = spark.createDataFrame(months, "month string, total_rides bigint")
    assert len(dashboard.chart_monthly_total(monthly).collect()) == 12
    every = [tuple(row) for row in dashboard.chart_monthly_total(monthly, limit=None).collect()]
    assert every == sorted(months, key=lambda month: month[1])


def test_headline_numbers_of_no_trips(spark, demo_trips):
    row = dashboard.headline_numbers(transform_to_silver(demo_trips).where("false")).first()
    assert row.total_rides == 0 and row.total_months == 0 and row.avg_duration_minutes is None
