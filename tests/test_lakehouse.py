import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmart.__main__ import main
from tripmart.operators.gold import MARTS, build_gold, stage_sums
from tripmart.operators.quality import (
    quality_summary,
    require_non_empty,
    validate_lakehouse,
    validation_report,
)
from tripmart.operators.silver import cast_types, transform_to_silver, write_silver
from tripmart.plans.medallion import run_lakehouse
from tripmart.plans.serving import PREVIEW_TABLES
from tripmart.session import Stage
from tripmart.sources.tables import GOLD_TABLES, Lakehouse, export_parquet, read_trip_starts


@pytest.fixture
def lakehouse(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lakehouse"))


@pytest.fixture
def finished(lakehouse, demo_trips, tmp_path):
    demo_trips.write.csv(str(tmp_path / "landing"), header=True)
    return run_lakehouse(lakehouse, str(tmp_path / "landing"))


def test_whole_run(lakehouse, finished, spark):
    assert finished.rows == {
        "bronze": 4,
        "silver": 4,
        "gold_daily_rides": 4,
        "gold_hourly_demand": 4,
        "gold_top_start_stations": 4,
        "gold_top_end_stations": 4,
        "gold_user_type_behavior": 2,
        "gold_bike_type_usage": 2,
        "gold_station_od_pairs": 4,
        "gold_monthly_summary": 1,
    }
    assert tuple(finished.quality.first()) == (4, 4, 0, 0, 0, 0)
    assert tuple(finished.preview) == PREVIEW_TABLES and len(PREVIEW_TABLES) == 7
    days = finished.preview["gold_daily_rides"].collect()
    assert [str(row.ride_date) for row in days] == ["2023-05-01", "2023-05-06", "2023-05-07", "2023-05-09"]

    report = {row.table_name: (row.rows, row.status) for row in validate_lakehouse(lakehouse).collect()}
    assert report == {name: (rows, "OK") for name, rows in finished.rows.items()}

    types = dict(lakehouse.read("silver").dtypes) | dict(lakehouse.read("gold_daily_rides").dtypes)
    assert types["month"] == "string" and types["ride_date"] == "date"


def test_registration(lakehouse, finished, spark):
    schema = f"trips_{uuid.uuid4().hex}"
    assert lakehouse.register(schema) == [f"{schema}.{name}" for name in GOLD_TABLES]
    assert lakehouse.register(schema) == []
    assert spark.table(f"{schema}.gold_daily_rides").count() == 4
    lakehouse.register()
    assert spark.sql("SELECT sum(total_rides) FROM gold_user_type_behavior").first()[0] == 4


def test_second_run_replaces_tables_and_their_schema(lakehouse, finished, text_trips):
    lakehouse.write(text_trips({"ride_id": "new", "Gender": "x"}), "bronze")
    assert lakehouse.read("bronze").columns[-1] == "Gender"
    rows, quality, found = write_silver(lakehouse, rebalance=True)
    assert rows == 1 and quality.first().distinct_ride_ids == 1
    assert build_gold(lakehouse)["gold_daily_rides"] == 1
    assert lakehouse.read("gold_daily_rides").count() == 1


def test_run_stops_when_a_table_would_be_empty(lakehouse, text_trips):
    lakehouse.write(transform_to_silver(text_trips({"start_station_name": None})), "silver", ("month",))
    with pytest.raises(ValueError, match="gold_top_start_stations is empty|gold_station_od_pairs is empty"):
        build_gold(lakehouse)


def test_run_stops_without_input(spark, lakehouse, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="raw trip input is empty"):
        run_lakehouse(lakehouse, str(tmp_path / "empty"))


def test_run_stops_when_no_trip_is_valid(lakehouse, text_trips):
    lakehouse.write(text_trips({"ride_id": None}), "bronze")
    with pytest.raises(ValueError, match="Silver trip table is empty"):
        write_silver(lakehouse)


def test_silver_is_written_in_one_pass_over_bronze(spark, lakehouse, text_trips, monkeypatch):
    trips = text_trips(
        {"ride_id": "a"},
        {"ride_id": "a"},
        {"ride_id": "b", "started_at": "garbage"},
        {"ride_id": None, "ended_at": "2023-01-01 00:00:00"},
        {"ride_id": "c", "ended_at": "2023-01-01 00:00:00"},
    )
    lakehouse.write(trips, "bronze")
    seen, read = spark.sparkContext.accumulator(0), Lakehouse.read

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(self, table):
        df = read(self, table)
        return df.mapInArrow(count, df.schema) if table == "bronze" else df

    monkeypatch.setattr(Lakehouse, "read", counted)
    rows, quality, found = write_silver(lakehouse)
    assert seen.value == 5
    assert rows == 2 and tuple(quality.first()) == (2, 1, 0, 0, 0, 0)
    assert quality.columns == quality_summary(cast_types(trips)).columns
    assert found == {"rows": 5, "null_ride_id": 1, "null_started_at": 1, "null_ended_at": 0, "non_positive_time_rows": 2}
    assert quality.schema == quality_summary(lakehouse.read("silver")).schema or quality.dtypes == quality_summary(lakehouse.read("silver")).dtypes


def test_readers_see_the_old_or_the_new_table(spark, lakehouse, text_trips):
    lakehouse.write(text_trips({"ride_id": "old"}), "bronze")
    before, place = lakehouse.read("bronze"), lakehouse.path("bronze")

    class Watched(Lakehouse):
        def _switch(self, table, current):
            # The new version is complete and not in use yet.
            assert [row.ride_id for row in self.read(table).collect()] == ["old"]
            super()._switch(table, current)

    Watched(spark, lakehouse.root).write(text_trips({"ride_id": "new", "Gender": "x"}), "bronze")
    assert [row.ride_id for row in before.collect()] == ["old"] and lakehouse.path("bronze") != place
    assert [(row.ride_id, row.Gender) for row in lakehouse.read("bronze").collect()] == [("new", "x")]
    for _ in range(3):
        lakehouse.write(text_trips({"ride_id": "newer"}), "bronze")
    assert len(list(Path(lakehouse.folder("bronze")).glob("v-*"))) == 2


def test_tables_are_read_without_looking_into_files(spark, lakehouse, demo_trips):
    lakehouse.write(transform_to_silver(demo_trips), "silver", ("month",))
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    columns = lakehouse.read("silver").where("month = '2023-05'").columns
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert columns[-1] == "month" and sorted(columns) == sorted(transform_to_silver(demo_trips).columns)


def test_only_the_months_that_landed_again_are_replaced(spark, lakehouse, text_trips):
    def month(name, *ids):
        times = {"started_at": f"2023-{name}-02 08:00:00", "ended_at": f"2023-{name}-02 08:10:00"}
        return [times | {"ride_id": i} for i in ids]

    def files(name):
        return {(f.name, f.stat().st_mtime_ns) for f in Path(lakehouse.path("silver"), f"month=2023-{name}").glob("*.parquet")}

    lakehouse.write(text_trips(*month("01", "a", "b"), *month("02", "c")), "bronze")
    assert write_silver(lakehouse, only_landed_months=True).rows == 3
    january, february = files("01"), files("02")
    lakehouse.write(text_trips(*month("02", "c", "d"), *month("03", "e")), "bronze")
    run = write_silver(lakehouse, only_landed_months=True)
    assert run.rows == 5 and run.found["rows"] == 3
    assert files("01") == january and files("02") != february
    found = {tuple(row) for row in lakehouse.read("silver").select("month", "ride_id").collect()}
    lakehouse.write(text_trips(*month("01", "a", "b"), *month("02", "c", "d"), *month("03", "e")), "bronze")
    write_silver(lakehouse)
    assert found == {tuple(row) for row in lakehouse.read("silver").select("month", "ride_id").collect()}
    with pytest.raises(ValueError, match="another schema"):
        lakehouse.replace_partitions(lakehouse.read("silver").drop("ride_id"), "silver", ("month",))


def test_stale_registrations_are_replaced(lakehouse, finished, spark):
    schema = f"trips_{uuid.uuid4().hex}"
    lakehouse.register(schema)
    lakehouse.write(lakehouse.read("gold_bike_type_usage").withColumn("share", F.lit(0.5)), "gold_bike_type_usage")
    assert lakehouse.register(schema) == [f"{schema}.gold_bike_type_usage"]
    assert {row.share for row in spark.sql(f"SELECT share FROM {schema}.gold_bike_type_usage").collect()} == {0.5}
    assert lakehouse.register(schema) == []


def test_tables_of_plain_files_are_still_read(lakehouse, demo_trips):
    demo_trips.write.parquet(lakehouse.folder("bronze"))
    assert lakehouse.read("bronze").count() == 4
    lakehouse.write(lakehouse.read("bronze").limit(2), "bronze")
    assert lakehouse.read("bronze").count() == 2


def test_validation_names_the_fault(lakehouse, finished, spark, demo_trips):
    lakehouse.write(demo_trips.select("ride_id", "started_at"), "bronze")
    with pytest.raises(AssertionError, match="bronze: missing columns: ended_at"):
        validate_lakehouse(lakehouse)
    silver = transform_to_silver(demo_trips)
    report = validation_report({"silver": silver.where("false")}).first()
    assert (report.rows, report.status) == (0, "empty")


def test_guard_passes_rows_through(demo_trips):
    assert require_non_empty(demo_trips, "trips") is demo_trips
    with pytest.raises(ValueError, match="trips is empty. Check input paths"):
        require_non_empty(demo_trips.where("false"), "trips")


def test_quality_before_cleaning(text_trips):
    trips = text_trips(
        {"ride_id": "a"},
        {"ride_id": "a", "started_at": "garbage"},
        {"ride_id": None, "ended_at": "2023-01-01 00:00:00"},
    )
    assert tuple(quality_summary(cast_types(trips)).first()) == (3, 1, 1, 1, 0, 1)


def test_export_and_trip_starts(spark, demo_trips, tmp_path):
    export_parquet(transform_to_silver(demo_trips), str(tmp_path / "export"))
    starts = read_trip_starts(spark, str(tmp_path / "export"))
    assert starts.columns == ["started_at", "start_lat", "start_lng"] and starts.count() == 4


def test_stages_use_the_shared_folder(spark):
    first, second = Stage(spark), Stage(spark)
    assert first.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert first.root != second.root


def test_stage_is_gone_after_a_run(spark, lakehouse, demo_trips, tmp_path):
    demo_trips.write.csv(str(tmp_path / "landing"), header=True)
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir())
    run_lakehouse(lakehouse, str(tmp_path / "landing"))
    assert set(Path(spark.conf.get("spark.checkpoint.dir")).iterdir()) == before


def test_failed_write_leaves_the_old_table(spark, lakehouse, finished):
    bad = lakehouse.read("gold_daily_rides").withColumn("ride_date", F.expr("raise_error('broken')"))
    with pytest.raises(Exception, match="broken"):
        lakehouse.write(bad, "gold_daily_rides")
    with pytest.raises(ValueError, match="gold_daily_rides is empty"):
        lakehouse.write(lakehouse.read("gold_daily_rides").where("false"), "gold_daily_rides", needed_for="gold_daily_rides")
    assert lakehouse.read("gold_daily_rides").count() == 4
    # A table can be made from itself.
    assert lakehouse.write(lakehouse.read("gold_daily_rides").limit(3), "gold_daily_rides") == 3
    assert lakehouse.read("gold_daily_rides").count() == 3


def test_gold_tables_are_written_without_sorting(spark, demo_trips):
    with Stage(spark) as stage:
        sums = stage_sums(transform_to_silver(demo_trips), stage)
        for mart in MARTS.values():
            text = mart.stored(sums[mart.source])._jdf.queryExecution().toString()
            assert "rangepartitioning" not in text and "Sort [" not in text


def test_jobs_from_the_command_line(lakehouse, demo_trips, tmp_path, capsys):
    demo_trips.write.csv(str(tmp_path / "landing"), header=True)
    main(["run", str(tmp_path / "landing"), lakehouse.root])
    main(["validate", lakehouse.root])
    main(["preview", lakehouse.root])
    shown = capsys.readouterr().out
    assert "gold_monthly_summary: 1 rows" in shown and "OK" in shown and "North Quay" in shown
    with pytest.raises(SystemExit):
        main(["unknown"])
