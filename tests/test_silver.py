import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import COMMUTE, DEMO_TRIPS
from tripmart.functions.geo import EARTH_RADIUS_KM, area_id, haversine_km
from tripmart.operators import silver
from tripmart.operators.bronze import ingest_bronze
from tripmart.operators.silver import SILVER_COLUMNS, transform_to_silver
from tripmart.sources.tables import Lakehouse


def plain_distance(lat1, lng1, lat2, lng2):
    """Spherical law of cosines, an independent formula."""
    a, b = math.radians(lat1), math.radians(lat2)
    cosine = math.sin(a) * math.sin(b) + math.cos(a) * math.cos(b) * math.cos(math.radians(lng2 - lng1))
    return EARTH_RADIUS_KM * math.acos(min(1.0, cosine))


def distance(spark, *points):
    df = spark.createDataFrame([points], "a double, b double, c double, d double")
    return df.select(haversine_km("a", "b", "c", "d")).first()[0]


def test_distance(spark):
    near = (51.5101, -0.118, 51.5203, -0.1042)
    assert 1.4 < distance(spark, *near) < 1.6
    assert distance(spark, *near) == pytest.approx(plain_distance(*near), rel=1e-6)
    assert distance(spark, 40.0, -73.0, 40.0, -73.0) == 0
    assert distance(spark, 90.0, 0.0, -90.0, 77.0) == pytest.approx(math.pi * EARTH_RADIUS_KM)
    for lat in (10.1, 33.3, 47.7):
        far = distance(spark, lat, 12.3, -lat, 12.3 - 180.0)
        assert far == pytest.approx(math.pi * EARTH_RADIUS_KM)
    assert distance(spark, None, -73.0, 40.0, -73.0) is None
    assert math.isnan(distance(spark, float("nan"), -73.0, 40.0, -73.0))


def test_grid_cells(spark):
    rows = [(40.7681, -74.0), (40.75, -73.9834), (None, -73.9)]
    cells = spark.createDataFrame(rows, "start_lat double, start_lng double").select(area_id())
    assert [row[0] for row in cells.collect()] == ["40.76_-74.0", "40.75_-73.99", None]


def test_invalid_trips_are_dropped(text_trips):
    day = "2024-01-01 "
    trips = text_trips(
        {"ride_id": "ok", "started_at": day + "10:00:00", "ended_at": day + "10:10:00"},
        {"ride_id": None},
        {"ride_id": "bad start", "started_at": "garbage"},
        {"ride_id": "no end", "ended_at": None},
        {"ride_id": "equal", "started_at": day + "10:00:00", "ended_at": day + "10:00:00"},
        {"ride_id": "reversed", "started_at": day + "10:00:00", "ended_at": day + "09:59:59"},
        {"ride_id": "same second", "started_at": day + "10:00:00.100", "ended_at": day + "10:00:00.900"},
        {"ride_id": "next second", "started_at": day + "10:00:00.900", "ended_at": day + "10:00:01.100"},
    )
    kept = {row.ride_id: row.trip_duration_minutes for row in transform_to_silver(trips).collect()}
    assert kept == {"ok": 10.0, "next second": 1 / 60}


def test_valid_trips_filter_alone_keeps_same_second_trips(text_trips):
    times = {"started_at": "2024-01-01 10:00:00.100", "ended_at": "2024-01-01 10:00:00.900"}
    typed = silver.cast_types(text_trips(times))
    assert silver.keep_valid_trips(typed).count() == 1
    assert silver.add_duration(typed).count() == 0


def test_old_rider_and_bike_spellings(text_trips):
    riders = ["Subscriber", "MEMBER", "Customer", "casual", "Guest", None]
    changes = [
        {"ride_id": str(at), "usertype": rider, "rideable_type": "Classic_Bike"}
        for at, rider in enumerate(riders)
    ]
    trips = text_trips(*changes, drop=("member_casual",))
    rows = transform_to_silver(trips).orderBy("ride_id").collect()
    assert [row.member_casual for row in rows] == ["member", "member", "casual", "casual", "guest", None]
    assert {row.rideable_type for row in rows} == {"classic_bike"}


def test_missing_coordinates_stay(text_trips):
    row = transform_to_silver(text_trips({"start_lat": ""}, {"end_lng": "NaN"})).collect()
    assert [(r.distance_km, r.end_lat) for r in row] == [(None, 51.5203)] * 2


def test_calendar(demo_trips):
    rows = transform_to_silver(demo_trips).orderBy("ride_id").collect()
    assert [row.trip_duration_minutes for row in rows] == [12.0, 20.5, 9.0, 25.0]
    assert [row.day_of_week for row in rows] == ["Monday", "Saturday", "Sunday", "Tuesday"]
    assert [row.day_of_week_num for row in rows] == [2, 7, 1, 3]
    assert [row.is_weekend for row in rows] == [False, True, True, False]
    assert {row.month for row in rows} == {"2023-05"}
    assert rows[0].start_hour == 7 and str(rows[0].start_date) == "2023-05-01"


def test_columns_and_order(demo_trips, text_trips):
    assert transform_to_silver(demo_trips).columns == [
        column for column in SILVER_COLUMNS if column not in ("ingestion_timestamp", "source_file")
    ]
    bare = text_trips({}, drop=("rideable_type", "member_casual", "start_station_name", "end_station_name"))
    row = transform_to_silver(bare).first()
    assert (row.rideable_type, row.member_casual, row.start_station_name) == (None, None, None)


def test_missing_required_columns_are_named(demo_trips):
    with pytest.raises(ValueError, match="end_lat"):
        transform_to_silver(demo_trips.drop("end_lat"))


def test_typed_input_is_accepted(demo_trips):
    typed = demo_trips.withColumns(
        {
            "started_at": F.to_timestamp("started_at"),
            "ended_at": F.to_timestamp("ended_at").cast("timestamp_ntz"),
            "start_lat": F.col("start_lat").cast("double"),
        }
    )
    expected = transform_to_silver(demo_trips).drop("data_layer").collect()
    assert transform_to_silver(typed).drop("data_layer").collect() == expected
    assert len(expected) == len(DEMO_TRIPS)


def test_files_of_several_layouts(spark, tmp_path):
    """Three spellings of the same columns, one file each, through Bronze to Silver."""
    old = {"started_at": "starttime", "ended_at": "Stop Time", "start_lng": "Start Lon", "member_casual": "usertype"}
    words = {name: name.replace("_", " ").title() for name in COMMUTE}
    for at, names in enumerate(({}, old, words)):
        trip = COMMUTE | {"ride_id": f"r{at}", "gender": str(at)}
        row = spark.createDataFrame([tuple(trip.values())], list(trip)).withColumnsRenamed(names)
        row.coalesce(1).write.mode("append").csv(str(tmp_path / "landing"), header=True)
    lakehouse = Lakehouse(spark, str(tmp_path / "lakehouse"))
    assert ingest_bronze(lakehouse, str(tmp_path / "landing")) == 3
    rows = transform_to_silver(lakehouse.read("bronze")).orderBy("ride_id").collect()
    assert [row.ride_id for row in rows] == ["r0", "r1", "r2"]
    assert {(row.trip_duration_minutes, row.member_casual, row.end_lat) for row in rows} == {(12.0, "member", 51.5203)}
    assert all(row.distance_km == rows[0].distance_km > 1 for row in rows)
