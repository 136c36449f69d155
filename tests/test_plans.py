"""What the plans look like: pruned scans, no cross joins, no Python, one shuffle where one will do."""

import re

import pytest

from tripmart.checks.adapters import demand_trips, raw_trips, silver_trips
from tripmart.operators import panel as panels
from tripmart.operators.gold import MARTS, gold_table
from tripmart.operators.panel import PanelOptions
from tripmart.operators.silver import transform_to_silver
from tripmart.plans import serving
from tripmart.plans.dashboard import filter_trips
from tripmart.session import Stage
from tripmart.sources.tables import Lakehouse

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    lakehouse = Lakehouse(spark, Stage(spark).root)
    lakehouse.write(silver_trips(spark, SF), "silver", ("month",))
    return lakehouse.read("silver")


@pytest.mark.parametrize("name", MARTS)
def test_marts_read_only_their_columns_and_sum_before_the_shuffle(silver, name):
    text = plan(gold_table(silver, name))
    (schema,) = set(re.findall(r"ReadSchema: struct<(.*?)>", text))
    assert schema.count(":") <= 6 < len(silver.columns)
    assert "partial_sum" in text
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "Python", "ObjectHashAggregate"):
        assert unwanted not in text


def test_month_filter_prunes_partitions(silver):
    text = plan(gold_table(filter_trips(silver, month="2024-02", member_casual="member"), "gold_daily_rides"))
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = 2024-02", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(member_casual,member\)", text)


def test_date_filter_prunes_partitions(silver):
    chosen = filter_trips(silver, "2024-02-10", "2024-03-20")
    text = plan(chosen)
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ >= 2024-02[^\]]*month#\d+ <= 2024-03", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(start_date,2024-02-10\)", text)
    days = {str(row.start_date) for row in chosen.select("start_date").distinct().collect()}
    assert min(days) >= "2024-02-10" and max(days) <= "2024-03-20"


def test_station_filter_reaches_the_scan(silver):
    assert "IsNotNull(start_station_name)" in plan(gold_table(silver, "gold_station_od_pairs"))


def test_top_queries_keep_few_rows_per_task_and_sort_once(silver):
    text = plan(serving.top_days(gold_table(silver, "gold_daily_rides")))
    assert "TakeOrderedAndProject(limit=10" in text
    assert text.count("Exchange") == 1 and "Sort [" not in text


def test_cleaning_never_shuffles(spark):
    text = plan(transform_to_silver(raw_trips(spark, SF)))
    assert "Exchange" not in text and "Python" not in text


def test_silver_columns_are_pruned_through_the_cleaning(spark):
    text = plan(transform_to_silver(raw_trips(spark, SF)).select("ride_id", "trip_duration_minutes"))
    assert "SIN(" not in text and "props" not in text


def test_panel_needs_one_shuffle_by_area(spark):
    stage = Stage(spark)
    demand = stage.table(panels.demand_by_area_hour(demand_trips(spark, SF)), "demand")
    hours = panels.hour_range(demand)
    areas = panels.top_areas(demand, 5)
    panel = panels.dense_panel(panels.keep_areas(demand, areas), areas, hours)
    panel = panels.add_lags(panel).withColumn("split", panels.split_of(hours))
    text = plan(panels.add_rush_threshold(panel))
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "SortMergeJoin", "Python"):
        assert unwanted not in text
    main = text.split("Subquery subquery")[0]
    # One for the list of areas, one for all rows.
    assert len(re.findall(r"Exchange hashpartitioning\(area_id#\d+, \d+\), REPARTITION_BY_NUM", text)) == 2
    assert "Window" in main
    assert not re.search(r"hashpartitioning\(area_id#\d+, timestamp_hour", text)


def test_area_lists_are_broadcast_by_their_size(spark, conf):
    demand = Stage(spark).table(panels.demand_by_area_hour(demand_trips(spark, SF)), "demand")

    def chosen(limit):
        return plan(panels.keep_areas(demand, panels.top_areas(demand, limit)))

    conf("spark.sql.autoBroadcastJoinThreshold", "10k")
    assert "BroadcastHashJoin" in chosen(150)
    assert "BroadcastHashJoin" not in chosen(10_000_000)


def test_zero_rows_are_made_in_many_tasks(spark):
    demand = Stage(spark).table(panels.demand_by_area_hour(demand_trips(spark, SF)), "demand")
    areas = panels.top_areas(demand, 6)
    panel = panels.dense_panel(demand, areas, panels.hour_range(demand))
    text = plan(panel)
    assert re.search(r"Generate explode(?s:.)*Exchange hashpartitioning\(area_id#\d+, \d+\), REPARTITION_BY_NUM", text)


def test_trips_are_scanned_once_for_a_staged_panel(spark):
    built = panels.build_rush_panel(demand_trips(spark, SF), PanelOptions(), Stage(spark))
    for part in (built.data, built.centroids, built.areas, built.hours):
        assert "events.parquet" not in plan(part)
