"""Checks of sources, sinks and the whole run. Each writes below a fresh shared folder."""

from __future__ import annotations

import uuid
import zipfile
from functools import reduce

import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, functions as F

from tripmart.checks.adapters import RAW_SQL, SILVER_SQL, raw_trips, silver_trips
from tripmart.checks.cleaning import SILVER_SELECT, SOURCE_SPELLINGS, nano_distance
from tripmart.checks.marts import GOLD_SQL
from tripmart.checks.registry import check, time_text
from tripmart.functions.naming import TRIP_COLUMNS
from tripmart.operators.bronze import ingest_bronze
from tripmart.operators.gold import build_gold
from tripmart.operators.quality import validate_lakehouse
from tripmart.operators.silver import write_silver
from tripmart.plans.medallion import run_lakehouse
from tripmart.plans.serving import PREVIEW_TABLES, preview_gold
from tripmart.session import Stage
from tripmart.sources.raw_csv import read_raw_csv
from tripmart.sources.tables import GOLD_TABLES, Lakehouse, export_parquet, read_trip_starts
from tripmart.sources.zip_csv import read_zip_csv

GOLD_CTES = ", ".join(f"{name} as ({sql})" for name, sql in GOLD_SQL.items())
STORED_ROWS = " union all ".join(
    f"select '{name}' as table_name, count(*) as rows from {table}"
    for name, table in [("bronze", "raw"), ("silver", "silver"), *[(name, name) for name in GOLD_SQL]]
)


def land_csv(raw: DataFrame, folder: str) -> str:
    """Raw trips as two sets of files, one of them gzipped, whose headers differ in order."""
    electric = F.col("rideable_type").eqNullSafe("electric_bike")
    header = {"header": True, "mode": "append"}
    raw.where(electric).write.csv(folder, **header)
    raw.where(~electric).select(*reversed(raw.columns)).write.csv(folder, compression="gzip", **header)
    return folder


def land_zip(raw: DataFrame, folder: str) -> str:
    """Raw trips as ZIP archives, one per partition, with files that are not trips beside the data."""
    lines = raw.select(F.to_csv(F.struct(*raw.columns)).alias("line"))
    header = ",".join(raw.columns)

    def pack(batches):
        shared, path = FileSystem.from_uri(folder.replace("s3a://", "s3://"))
        shared.create_dir(path)
        path = f"{path}/{uuid.uuid4().hex}.zip"
        with shared.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "not a table")
            archive.writestr("__MACOSX/._trips.csv", "not a table")
            with archive.open("data/trips.CSV", "w") as member:
                member.write(f"{header}\n".encode())
                for batch in batches:
                    member.write("".join(f"{line}\n" for line in batch["line"]).encode())
        yield pd.DataFrame({"path": [path]})

    lines.mapInPandas(pack, "path string").count()
    return folder


def fresh_lakehouse(spark) -> Lakehouse:
    return Lakehouse(spark, Stage(spark).root)


def stored_silver(spark, sf_dir) -> Lakehouse:
    lakehouse = fresh_lakehouse(spark)
    lakehouse.write(silver_trips(spark, sf_dir), "silver", ("month",))
    return lakehouse


def stored_gold(spark, sf_dir) -> Lakehouse:
    lakehouse = stored_silver(spark, sf_dir)
    build_gold(lakehouse)
    return lakehouse


@check("src_raw_csv", f"with {RAW_SQL} select * from raw")
def src_raw_csv_check(spark, sf_dir):
    folder = land_csv(raw_trips(spark, sf_dir), Stage(spark).path("landing"))
    return read_raw_csv(spark, folder).select(*TRIP_COLUMNS)


@check("src_zip_csv", f"with {RAW_SQL} select * from raw")
def src_zip_csv_check(spark, sf_dir):
    stage = Stage(spark)
    folder = land_zip(raw_trips(spark, sf_dir), stage.path("landing"))
    return read_zip_csv(spark, folder, stage).select(*TRIP_COLUMNS)


@check(
    "bronze_ingest",
    f"with {RAW_SQL} select *, 'bronze' as data_layer, true as has_time, true as has_file from raw",
)
def bronze_ingest_check(spark, sf_dir):
    lakehouse = fresh_lakehouse(spark)
    ingest_bronze(lakehouse, land_csv(raw_trips(spark, sf_dir), f"{lakehouse.root}/landing"))
    return lakehouse.read("bronze").select(
        *TRIP_COLUMNS,
        "data_layer",
        F.col("ingestion_timestamp").isNotNull().alias("has_time"),
        F.col("source_file").contains("/landing/part-").alias("has_file"),
    )


@check(
    "tbl_overwrite_schema",
    f"with {SILVER_SQL} select ride_id, month, round(distance_km, 9) as distance_km from silver",
)
def tbl_overwrite_schema_check(spark, sf_dir):
    lakehouse = fresh_lakehouse(spark)
    silver = silver_trips(spark, sf_dir)
    lakehouse.write(silver.select("ride_id", "member_casual"), "silver")
    lakehouse.write(silver.select("ride_id", "month", "distance_km"), "silver")
    return nano_distance(lakehouse.read("silver"))


@check(
    "tbl_partitioned_write",
    f"with {SILVER_SQL} select concat('month=', month) as folder, month, ride_id from silver",
)
def tbl_partitioned_write_check(spark, sf_dir):
    stored = stored_silver(spark, sf_dir).read("silver")
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("folder")
    return stored.select(folder, "month", "ride_id")


@check("tbl_read", f"with {SILVER_SQL} select {SILVER_SELECT} from silver")
def tbl_read_check(spark, sf_dir):
    return nano_distance(stored_silver(spark, sf_dir).read("silver"))


@check(
    "silver_write",
    f"with {SILVER_SQL} select {SILVER_SELECT} from silver",
)
def silver_write_check(spark, sf_dir):
    """Bronze table to Silver table, with file sizes evened out."""
    lakehouse = fresh_lakehouse(spark)
    lakehouse.write(raw_trips(spark, sf_dir), "bronze")
    write_silver(lakehouse, rebalance=True)
    return nano_distance(lakehouse.read("silver").select(*silver_trips(spark, sf_dir).columns))


@check("silver_mixed_layouts", f"with {SILVER_SQL} select {SILVER_SELECT} from silver")
def silver_mixed_layouts_check(spark, sf_dir):
    """Landed files of two layouts, half of them in older spellings, through Bronze to Silver."""
    lakehouse = fresh_lakehouse(spark)
    raw, folder = raw_trips(spark, sf_dir), f"{lakehouse.root}/landing"
    half = F.coalesce(F.crc32(F.col("ride_id").cast("binary")) % 2, F.lit(0))
    raw.where(half == 0).write.csv(folder, header=True, mode="append")
    raw.where(half == 1).withColumnsRenamed(SOURCE_SPELLINGS).write.csv(folder, header=True, mode="append")
    ingest_bronze(lakehouse, folder)
    write_silver(lakehouse)
    return nano_distance(lakehouse.read("silver").select(*silver_trips(spark, sf_dir).columns))


@check("export_silver_parquet", f"with {SILVER_SQL} select {SILVER_SELECT} from silver")
def export_silver_parquet_check(spark, sf_dir):
    path = Stage(spark).path("export")
    export_parquet(silver_trips(spark, sf_dir), path)
    return nano_distance(spark.read.parquet(path))


@check(
    "scan_pruned_parquet",
    f"with {SILVER_SQL} select {time_text('started_at')} as started_at, start_lat, start_lng from silver",
)
def scan_pruned_parquet_check(spark, sf_dir):
    path = Stage(spark).path("export")
    export_parquet(silver_trips(spark, sf_dir), path)
    return read_trip_starts(spark, path)


@check(
    "register_tables",
    f"""with {SILVER_SQL}, {GOLD_CTES}
    {" union all ".join(f"select '{name}' as table_name, count(*) as rows from {name}" for name in GOLD_SQL)}
    """,
)
def register_tables_check(spark, sf_dir):
    lakehouse = stored_gold(spark, sf_dir)
    schema = f"trips_{uuid.uuid4().hex}"
    lakehouse.register(schema)
    assert lakehouse.register(schema) == []
    counts = [f"SELECT '{name}' AS table_name, count(*) AS rows FROM {schema}.{name}" for name in GOLD_TABLES]
    return spark.sql(" UNION ALL ".join(counts))


def _register_stored(table: str) -> None:
    @check(f"stored_{table}", f"with {SILVER_SQL}, {GOLD_CTES} select * from {table}")
    def stored_check(spark, sf_dir):
        """The table as ``build_gold`` stores it, from the staged sums."""
        return stored_gold(spark, sf_dir).read(table)


for _table in GOLD_TABLES:
    _register_stored(_table)


PREVIEW_ORDER = {
    "gold_daily_rides": "ride_date",
    "gold_hourly_demand": """case day_of_week when 'Sunday' then 1 when 'Monday' then 2 when 'Tuesday' then 3
        when 'Wednesday' then 4 when 'Thursday' then 5 when 'Friday' then 6 else 7 end, start_hour""",
    "gold_top_start_stations": "total_starts desc, start_station_name",
    "gold_top_end_stations": "total_ends desc, end_station_name",
    "gold_user_type_behavior": "total_rides desc, member_casual",
    "gold_bike_type_usage": "total_rides desc, rideable_type",
    "gold_station_od_pairs": "total_rides desc, start_station_name, end_station_name",
}


@check(
    "preview_gold",
    f"""with {SILVER_SQL}, {GOLD_CTES} """
    + " union all ".join(
        f"""select '{name}' as table_name, to_json(t)::varchar as row_text
        from (select avg_duration_minutes from {name} order by {PREVIEW_ORDER[name]} limit 20) t"""
        for name in PREVIEW_TABLES
    ),
)
def preview_gold_check(spark, sf_dir):
    """The average duration of every previewed row, as JSON text."""
    previews = preview_gold(stored_gold(spark, sf_dir))
    rows = [
        df.select(
            F.lit(name).alias("table_name"), F.to_json(F.struct("avg_duration_minutes")).alias("row_text")
        )
        for name, df in previews.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@check("pipeline_run", f"with {SILVER_SQL}, {GOLD_CTES} {STORED_ROWS}")
@check("medallion_run", f"with {SILVER_SQL}, {GOLD_CTES} {STORED_ROWS}")
def medallion_run_check(spark, sf_dir):
    """Rows stored by each step of the run from CSV files to Gold."""
    lakehouse = fresh_lakehouse(spark)
    folder = land_csv(raw_trips(spark, sf_dir), f"{lakehouse.root}/landing")
    result = run_lakehouse(lakehouse, folder)
    return spark.createDataFrame(list(result.rows.items()), "table_name string, rows bigint")


@check(
    "validate_lakehouse",
    f"with {SILVER_SQL}, {GOLD_CTES}, stored as ({STORED_ROWS}) select *, 'OK' as status from stored",
)
def validate_lakehouse_check(spark, sf_dir):
    lakehouse = fresh_lakehouse(spark)
    folder = land_csv(raw_trips(spark, sf_dir), f"{lakehouse.root}/landing")
    run_lakehouse(lakehouse, folder)
    return validate_lakehouse(lakehouse).drop("path")
