import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONPATH", str(ROOT))

from tripmart.session import build_session  # noqa: E402

TEXT_COLUMNS = (
    "ride_id rideable_type started_at ended_at start_station_name start_station_id end_station_name "
    "end_station_id start_lat start_lng end_lat end_lng member_casual"
).split()
COMMUTE = {
    "ride_id": "a1",
    "rideable_type": "classic_bike",
    "started_at": "2023-05-01 07:45:00",
    "ended_at": "2023-05-01 07:57:00",
    "start_station_name": "North Quay",
    "start_station_id": "Q10",
    "end_station_name": "Mill Lane",
    "end_station_id": "M2.50",
    "start_lat": "51.5101",
    "start_lng": "-0.118",
    "end_lat": "51.5203",
    "end_lng": "-0.1042",
    "member_casual": "member",
}
OUTING = {
    "ride_id": "a2",
    "rideable_type": "electric_bike",
    "started_at": "2023-05-06 13:30:00",
    "ended_at": "2023-05-06 13:50:30",
    "start_station_name": "Canal Gate",
    "start_station_id": "C7",
    "end_station_name": "Hill Park",
    "end_station_id": "H1",
    "start_lat": "51.5007",
    "start_lng": "-0.0914",
    "end_lat": "51.5312",
    "end_lng": "-0.129",
    "member_casual": "casual",
}
SUNDAY = COMMUTE | {
    "ride_id": "a3",
    "started_at": "2023-05-07 19:00:00",
    "ended_at": "2023-05-07 19:09:00",
    "start_station_name": "Mill Lane",
    "end_station_name": "Canal Gate",
}
LATE = OUTING | {
    "ride_id": "a4",
    "started_at": "2023-05-09 22:10:00",
    "ended_at": "2023-05-09 22:35:00",
    "start_station_name": "Hill Park",
    "end_station_name": "North Quay",
}
DEMO_TRIPS = [tuple(trip.values()) for trip in (COMMUTE, OUTING, SUNDAY, LATE)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tripmart-tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set a configuration for one test."""
    before = {}

    def set_conf(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def text_trips(spark):
    """Trips as text: every keyword replaces a column of the first demo trip."""

    def make(*changes, drop=()):
        base = dict(zip(TEXT_COLUMNS, DEMO_TRIPS[0]))
        rows = [base | change for change in changes]
        names = [name for name in dict.fromkeys(name for row in rows for name in row) if name not in drop]
        schema = ", ".join(f"`{name}` string" for name in names)
        return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)

    return make


@pytest.fixture
def demo_trips(spark):
    return spark.createDataFrame(DEMO_TRIPS, ", ".join(f"{name} string" for name in TEXT_COLUMNS))
