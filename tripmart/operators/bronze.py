"""Bronze: raw rows as they are, plus where and when they came in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripmart.session import Stage
from tripmart.sources.raw_csv import SOURCE_FILE, read_raw_csv
from tripmart.sources.tables import Lakehouse
from tripmart.sources.zip_csv import read_zip_csv

AUDIT_COLUMNS = ("ingestion_timestamp", SOURCE_FILE, "data_layer")


def to_bronze(raw: DataFrame) -> DataFrame:
    """Adds the audit columns to rows that were read together with their source file."""
    source_columns = [F.col(f"`{column}`") for column in raw.columns if column != SOURCE_FILE]
    return raw.select(
        *source_columns,
        F.current_timestamp().alias("ingestion_timestamp"),
        F.col(SOURCE_FILE),
        F.lit("bronze").alias("data_layer"),
    )


def ingest_bronze(
    lakehouse: Lakehouse,
    input_path: str,
    zipped: bool = False,
    columns: Sequence[str] | None = None,
    stage: Stage | None = None,
) -> int:
    """Replace the Bronze table by the CSV files, or the ZIP archives, at ``input_path``."""
    spark = lakehouse.spark
    if zipped:
        raw = read_zip_csv(spark, input_path, stage or Stage(spark), with_source=True)
    else:
        raw = read_raw_csv(spark, input_path, columns, with_source=True)
    return lakehouse.write(to_bronze(raw), "bronze", needed_for="raw trip input")
