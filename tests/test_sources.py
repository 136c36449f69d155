import gzip
import io
import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import DEMO_TRIPS, TEXT_COLUMNS
from tripmart.operators.bronze import to_bronze
from tripmart.session import Stage
from tripmart.sources import raw_csv, zip_csv
from tripmart.sources.raw_csv import file_layouts, header_columns, header_index, read_raw_csv
from tripmart.sources.zip_csv import read_zip_csv


def as_dicts(df):
    return sorted((row.asDict() for row in df.collect()), key=lambda row: row["ride_id"])


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "a.csv").write_text('ride_id,name\n1,"Pier 1, East"\n2,\n')
    (tmp_path / "b.csv").write_text("name,ride_id,extra\nHub,3,x\n")
    (tmp_path / "c.csv").write_text("ride_id,name\n4,Dock\n")
    with gzip.open(tmp_path / "d.csv.gz", "wt") as file:
        file.write("ride_id,name\n5,Zip\n")
    (tmp_path / "._e.csv").write_text("ride_id,name\n99,hidden\n")
    return str(tmp_path)


EXPECTED = [
    {"ride_id": "1", "name": "Pier 1, East", "extra": None},
    {"ride_id": "2", "name": None, "extra": None},
    {"ride_id": "3", "name": "Hub", "extra": "x"},
    {"ride_id": "4", "name": "Dock", "extra": None},
    {"ride_id": "5", "name": "Zip", "extra": None},
]


def test_columns_follow_headers_not_positions(spark, landing):
    index = header_index(spark, landing)
    assert file_layouts(index) == ["name,ride_id,extra", "ride_id,name"]
    assert {row.source_file.rsplit("/", 1)[-1] for row in index.where("header = 'ride_id,name'").collect()} == {"a.csv", "c.csv", "d.csv.gz"}
    assert as_dicts(read_raw_csv(spark, landing)) == EXPECTED


def job_count(spark, action):
    """How many Spark jobs an action runs."""
    context, group = spark.sparkContext, uuid.uuid4().hex
    context.setJobGroup(group, "")
    try:
        result = action()
        return len(context.statusTracker().getJobIdsForGroup(group)), result
    finally:
        context._jsc.clearJobGroup()


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def land(folder, count):
        folder.mkdir()
        for at in range(count):
            names = ["ride_id,name", "name,ride_id"][at % 2]
            (folder / f"{at}.csv").write_text(f"{names}\n{at},{at}\n\n{at},{at}\n")
        return str(folder)

    few, many = land(tmp_path / "few", 4), land(tmp_path / "many", 200)
    jobs, rows = job_count(spark, lambda: read_raw_csv(spark, many))
    assert jobs == job_count(spark, lambda: read_raw_csv(spark, few))[0]
    assert tuple(rows.selectExpr("count(*)", "sum(int(ride_id))", "sum(int(name))").first()) == (400, 39_800, 39_800)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "BroadcastHashJoin" in plan


def test_only_first_blocks_are_read_for_headers(spark, tmp_path):
    class Counted(io.BytesIO):
        def read(self, size):
            assert size == raw_csv.HEADER_BYTES and self.tell() < 4 * size
            return super().read(size)

    long = b"\n \n\xef\xbb\xbfride_id,name\r\n" + b"1,x\n" * 100_000
    assert raw_csv._first_line(Counted(long)) == "\ufeffride_id,name"
    assert raw_csv._first_line(Counted(b"x" * 40_000)) == "x" * 40_000
    (tmp_path / "a b%20.csv").write_bytes(long)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "c.csv").write_text("ride_id,name")
    for index in (header_index, raw_csv.scanned_index):
        assert {row.header for row in index(spark, str(tmp_path)).collect()} - {""} == {"\ufeffride_id,name", "ride_id,name"}
    assert read_raw_csv(spark, str(tmp_path)).count() == 100_000


def test_store_that_only_spark_reads(spark, landing, monkeypatch):
    def closed(uri):
        raise OSError(uri)

    monkeypatch.setattr(raw_csv, "_open", closed)
    assert None in file_layouts(header_index(spark, landing))
    assert as_dicts(read_raw_csv(spark, landing)) == EXPECTED


def test_index_of_very_many_files_is_not_broadcast(spark, landing, monkeypatch):
    monkeypatch.setattr(raw_csv, "BROADCAST_FILES", 1)
    rows = read_raw_csv(spark, landing)
    assert as_dicts(rows) == EXPECTED


def test_empty_landing_zone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_raw_csv(spark, str(tmp_path), with_source=True).columns == ["source_file"]


def test_blank_and_repeated_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ride_id,,Ride_ID\n1,x,2\n")
    rows = read_raw_csv(spark, str(tmp_path))
    assert tuple(rows.first()) == ("1", "x", "2") and len(set(map(str.lower, rows.columns))) == 3


def test_source_file_is_kept(spark, landing):
    rows = read_raw_csv(spark, landing, with_source=True).collect()
    assert {row.ride_id: row.source_file.rsplit("/", 1)[-1] for row in rows} == {
        "1": "a.csv", "2": "a.csv", "3": "b.csv", "4": "c.csv", "5": "d.csv.gz",
    }
    bronze = to_bronze(read_raw_csv(spark, landing, with_source=True))
    assert bronze.columns[-3:] == ["ingestion_timestamp", "source_file", "data_layer"]
    assert {row.data_layer for row in bronze.collect()} == {"bronze"}


def test_given_header_is_enforced(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ride_id,name\n1,Hub\n")
    assert read_raw_csv(spark, str(tmp_path), ["ride_id", "name"]).count() == 1
    (tmp_path / "b.csv").write_text("name,ride_id\nHub,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_csv(spark, str(tmp_path), ["ride_id", "name"]).collect()


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as archive:
        archive.writestr("d/x.CSV", '﻿ride_id,name\r\n1,"Pier 1, East"\r\n\r\n2,\r\n')
        archive.writestr("__MACOSX/._x.csv", "junk")
        archive.writestr("readme.txt", "junk")
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as archive:
        archive.writestr("x.csv", "name,ride_id,extra\nHub,3,x\n")
        archive.writestr("y.csv", "ride_id,name\n4,Dock\n5,Zip\n")
        archive.writestr("empty.csv", "")
    rows = read_zip_csv(spark, str(tmp_path / "*.zip"), Stage(spark), with_source=True)
    assert as_dicts(rows.drop("source_file")) == EXPECTED
    assert {row.source_file.split("/")[-2:][0] for row in rows.collect()} == {"one.zip", "two.zip"}


def test_zip_longer_than_one_batch(spark, tmp_path):
    lines = "".join(f"{at},{at % 7}\n" for at in range(45_000))
    with zipfile.ZipFile(tmp_path / "long.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("long.csv", "ride_id,day\n" + lines)
    rows = read_zip_csv(spark, str(tmp_path / "long.zip"), Stage(spark))
    total = rows.selectExpr("count(*)", "sum(cast(ride_id as bigint))", "count(distinct day)").first()
    assert tuple(total) == (45_000, sum(range(45_000)), 7)


def test_a_task_for_each_member(spark, tmp_path):
    for archive_at in range(3):
        with zipfile.ZipFile(tmp_path / f"{archive_at}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for at in range(4):
                archive.writestr(f"{at}.csv", f"ride_id,name\n{archive_at}{at},x\n")
    lines = zip_csv.member_lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() == 12
    assert [row[0] for row in lines.where("line IS NOT NULL").groupBy(F.spark_partition_id()).count().select("count").collect()] == [1] * 12
    rows = read_zip_csv(spark, str(tmp_path), Stage(spark))
    assert sorted(row.ride_id for row in rows.collect()) == sorted(f"{a}{b}" for a in range(3) for b in range(4))


def test_only_the_range_of_a_member_is_read(tmp_path, monkeypatch):
    path = tmp_path / "large.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("before.csv", b"a,b\n" * 5_000_000)
        archive.writestr("small.csv", "ride_id\n1\n")
        archive.writestr("after.csv", b"a,b\n" * 5_000_000)
    asked = []

    class Counted(io.FileIO):
        def readinto(self, buffer):
            asked.append(super().readinto(buffer))
            return asked[-1]

    class Local:
        def open_input_file(self, path):
            return Counted(path)

    monkeypatch.setattr(zip_csv, "file_system", lambda uri: (Local(), uri))
    partition = zip_csv.InputPartition((str(path), "small.csv"))
    batches = list(zip_csv.MemberReader([str(path)]).read(partition))
    assert [batch.column("line").to_pylist() for batch in batches] == [[None], ["1"]]
    assert sum(asked) < 5 * zip_csv.RANGE_BYTES < path.stat().st_size / 4


def test_zip_in_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    with zipfile.ZipFile(tmp_path / "one.zip", "w") as archive:
        archive.writestr("x.csv", "ride_id,name\n1,a\n")
    monkeypatch.setattr(zip_csv, "reachable", lambda uri: False)
    assert read_zip_csv(spark, str(tmp_path), Stage(spark)).collect() == [("1", "a")]


def test_no_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "hidden.zip", "w") as archive:
        archive.writestr("_x.csv", "ride_id,name\n1,a\n")
    assert read_zip_csv(spark, str(tmp_path), Stage(spark), with_source=True).columns == ["source_file"]


def test_zip_without_csv_fails(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as archive:
        archive.writestr("readme.txt", "junk")
    with pytest.raises(Exception, match="No CSV files found"):
        read_zip_csv(spark, str(tmp_path / "none.zip"), Stage(spark)).collect()


def test_header_names():
    assert header_columns('ride_id,"Start, Name",,ride_id') == ["ride_id", "Start, Name", "_c2", "ride_id3"]


def test_odd_column_names_in_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "odd.zip", "w") as archive:
        archive.writestr("odd.csv", "Start: Time,a`b,c.d\n1,2,3\n")
    row = read_zip_csv(spark, str(tmp_path / "odd.zip"), Stage(spark)).first()
    assert row.asDict() == {"Start: Time": "1", "a`b": "2", "c.d": "3"}


def test_round_trip_of_demo_trips(spark, demo_trips, tmp_path):
    demo_trips.write.csv(str(tmp_path / "landing"), header=True)
    rows = read_raw_csv(spark, str(tmp_path / "landing")).select(*TEXT_COLUMNS)
    assert sorted(map(tuple, rows.collect())) == sorted(DEMO_TRIPS)
