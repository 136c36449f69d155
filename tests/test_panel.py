from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmart.checks.adapters import demand_trips
from tripmart.operators import panel as panels
from tripmart.operators.panel import PANEL_COLUMNS, PanelOptions, build_rush_panel
from tripmart.session import Stage

SF = "/root/testdata/sf0.001"
START = datetime(2024, 3, 1)
HERE, THERE = (40.755, -73.985), (40.705, -74.0)


@pytest.fixture
def trips(spark):
    def make(rows):
        return spark.createDataFrame(rows, "started_at timestamp, start_lat double, start_lng double")

    return make


def at(hours, place=HERE, minutes=0):
    return (START + timedelta(hours=hours, minutes=minutes), *place)


def by_hour(panel, area):
    return [row.asDict() for row in panel.where(F.col("area_id") == area).orderBy("timestamp_hour").collect()]


def test_panel_by_brute_force(spark):
    """The whole operator against plain Python over the same trips."""
    rows = demand_trips(spark, SF).collect()
    hour_of = [row.started_at.replace(minute=0, second=0, microsecond=0) for row in rows]
    first, last = min(hour_of), max(hour_of)
    hours = [first + timedelta(hours=n) for n in range(int((last - first).total_seconds() // 3600) + 1)]
    split = hours[int(len(hours) * 0.8)]

    def cell(degrees):
        return np.floor(degrees * 100) / 100

    area_of = [
        None if row.start_lat is None else f"{cell(row.start_lat)}_{cell(row.start_lng)}" for row in rows
    ]
    train = Counter(a for a, h in zip(area_of, hour_of) if a is not None and h < split)
    top = sorted(train, key=lambda area: (-train[area], area))[:4]
    demand = Counter(zip(area_of, hour_of))
    expected = set()
    for area in top:
        counts = [demand[area, hour] for hour in hours]
        train_counts = sorted(n for n, hour in zip(counts, hours) if hour < split)
        observed = train_counts[int(np.ceil(0.9 * len(train_counts))) - 1]
        threshold = max(observed, 1)
        for n, hour in enumerate(hours):
            lags = tuple(counts[n - lag] if n >= lag else 0 for lag in (1, 2, 24, 168))
            part = "train" if hour < split else "test"
            expected.add((hour, area, counts[n], *lags, part, threshold, int(counts[n] >= threshold)))
    built = build_rush_panel(demand_trips(spark, SF), PanelOptions(top_areas=4, min_threshold=1), Stage(spark))
    assert tuple(built.data.columns) == PANEL_COLUMNS
    found = built.data.select(
        "timestamp_hour", "area_id", "demand_count", "lag_1", "lag_2", "lag_24", "lag_168", "split",
        "rush_threshold", "is_rush_area",
    )
    assert {tuple(row) for row in found.collect()} == expected
    assert found.count() == len(expected)


def test_staged_and_lazy_panels_are_the_same(spark):
    options = PanelOptions(top_areas=3)
    lazy = build_rush_panel(demand_trips(spark, SF), options)
    staged = build_rush_panel(demand_trips(spark, SF), options, Stage(spark))
    assert sorted(lazy.data.collect()) == sorted(staged.data.collect())


def test_hours_without_trips_are_zero_and_lags_count_hours(trips):
    built = build_rush_panel(trips([at(0), at(0, minutes=59), at(3), at(9)]), PanelOptions())
    rows = by_hour(built.data, "40.75_-73.99")
    assert [row["demand_count"] for row in rows] == [2, 0, 0, 1, 0, 0, 0, 0, 0, 1]
    assert [row["lag_1"] for row in rows] == [0, 2, 0, 0, 1, 0, 0, 0, 0, 0]
    assert [row["lag_2"] for row in rows] == [0, 0, 2, 0, 0, 1, 0, 0, 0, 0]
    assert [row["split"] for row in rows] == ["train"] * 8 + ["test"] * 2
    assert {row["rush_threshold"] for row in rows} == {3}


def test_top_areas_come_from_train_hours_only(trips):
    rows = [at(0), at(1), at(9, THERE), at(9, THERE), at(9, THERE)]
    by_train = build_rush_panel(trips(rows), PanelOptions(top_areas=1))
    assert {row.area_id for row in by_train.areas.collect()} == {"40.75_-73.99"}
    by_all = build_rush_panel(trips(rows), PanelOptions(top_areas=1, scope="all"))
    assert {row.area_id for row in by_all.areas.collect()} == {"40.7_-74.0"}
    assert by_all.data.count() == 10
    own_hours = build_rush_panel(trips(rows), PanelOptions(top_areas=1, scope="all", spine="top_areas"))
    assert own_hours.data.count() == 1


def test_trips_without_place_count_for_hours_only(trips):
    rows = [(START, None, -73.9), at(2), *[(START + timedelta(hours=4), None, None)] * 5]
    built = build_rush_panel(trips(rows), PanelOptions())
    assert [row["demand_count"] for row in by_hour(built.data, "40.75_-73.99")] == [0, 0, 1, 0, 0]
    assert built.data.count() == 5
    assert built.centroids.count() == 1


def test_exact_threshold_interpolates(trips):
    demand = [0, 1, 2, 3, 4, 5, 6, 7, 9, 9]
    rows = [at(hour) for hour, count in enumerate(demand) for _ in range(count)] + [at(0, THERE), at(12, THERE)]
    exact = build_rush_panel(trips(rows), PanelOptions(scope="all", quantile="exact"))
    observed = build_rush_panel(trips(rows), PanelOptions(scope="all"))
    train = demand[: int(13 * 0.8)]
    assert by_hour(exact.data, "40.75_-73.99")[0]["rush_threshold"] == pytest.approx(np.quantile(train, 0.9))
    assert by_hour(observed.data, "40.75_-73.99")[0]["rush_threshold"] == 9
    assert by_hour(exact.data, "40.7_-74.0")[0]["rush_threshold"] == 3


@pytest.mark.parametrize("rows", [[], [at(5), at(5, minutes=30)]])
def test_no_train_hours_give_an_empty_panel(trips, rows):
    built = build_rush_panel(trips(rows), PanelOptions())
    assert built.data.count() == 0
    summary = panels.panel_summary(built.data).first()
    assert (summary.areas, summary.total_rows, summary.rush_rows, summary.rush_pct) == (0, 0, 0, None)
    assert panels.split_summary(built.data).count() == 0


def test_one_hour_in_whole_period_mode_is_all_test(trips):
    built = build_rush_panel(trips([at(5)] * 4), panels.WHOLE_PERIOD)
    (row,) = by_hour(built.data, "40.75_-73.99")
    assert (row["split"], row["rush_threshold"], row["is_rush_area"]) == ("test", 3, 1)


def test_options_that_contradict_each_other():
    with pytest.raises(ValueError, match="scope"):
        PanelOptions(spine="top_areas")
    with pytest.raises(ValueError, match="quantile"):
        PanelOptions(quantile="mean")


def test_map_layer_scales_to_the_largest_area(trips):
    built = build_rush_panel(trips([at(0)] * 4 + [at(9, THERE), at(1, THERE)]), PanelOptions())
    layer = {row.area_id: row for row in panels.area_map_layer(built.data, built.centroids).collect()}
    assert layer["40.75_-73.99"].radius == 20 and layer["40.7_-74.0"].radius == 12.5
    assert layer["40.7_-74.0"].color == "crimson"
    assert layer["40.7_-74.0"].map_lat == pytest.approx((HERE[0] + THERE[0]) / 2)


def test_area_without_demand_in_the_panel_is_blue(spark):
    hours = [(START, "a", 0), (START, "b", 0)]
    panel = spark.createDataFrame(hours, "timestamp_hour timestamp, area_id string, demand_count bigint")
    places = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "area_id string, lat double, lng double")
    rows = panels.area_map_layer(panel, places).collect()
    assert {(row.radius, row.color, row.map_lat, row.map_lng) for row in rows} == {(5.0, "blue", 2.0, 3.0)}
