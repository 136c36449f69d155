"""The lakehouse tables: where they are, how they are written, read and registered."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from tripmart.session import remove_folder

# The aggregate tables, in the order they are built and registered.
GOLD_TABLES = (
    "gold_daily_rides",
    "gold_hourly_demand",
    "gold_top_start_stations",
    "gold_top_end_stations",
    "gold_user_type_behavior",
    "gold_bike_type_usage",
    "gold_station_od_pairs",
    "gold_monthly_summary",
)


#: The file in a table's folder that names the version in use, its schema and partition columns.
POINTER = "_current.json"


@dataclass(frozen=True)
class Lakehouse:
    """Tables below one root folder, in one file format.

    ``fmt`` is ``parquet`` unless a table format such as ``delta`` is installed on the cluster. A plain Parquet table is a
    folder of versions and a small file that names the one in use, with its schema: a rewrite adds a version and
    then replaces that file, so no folder is renamed and readers see the old or the new table. The version before
    the one in use is kept for readers that still hold it; older ones are removed.
    """

    spark: SparkSession
    root: str
    fmt: str = "parquet"

    def folder(self, table: str) -> str:
        """``bronze`` and ``silver`` are one table each; the rest are Gold tables."""
        name = table if table in ("bronze", "silver") else f"gold/{table}"
        return f"{self.root.rstrip('/')}/{name}"

    def path(self, table: str) -> str:
        """Where the data of the table are now."""
        current = self._current(table)
        return f"{self.folder(table)}/{current['version']}" if current else self.folder(table)

    def read(self, table: str) -> DataFrame:
        current = self._current(table)
        reader = self.spark.read.format(self.fmt)
        if current:
            # With the schema known, no file is opened before the data are read.
            reader = reader.schema(T.StructType.fromJson(current["schema"]))
        return reader.load(f"{self.folder(table)}/{current['version']}" if current else self.folder(table))

    def write(
        self, df: DataFrame, table: str, partition_by: Sequence[str] = (), needed_for: str | None = None
    ) -> int:
        """Replace a table, its schema included, and return the rows stored.

        A run that fails leaves the table as it was. The count is read from the file footers of what was
        written; nothing is computed again. With ``needed_for`` no rows are an error that names it, and the
        table stays as it was.
        """
        version = f"v-{uuid.uuid4().hex}"
        fresh = self.folder(table) if self.fmt != "parquet" else f"{self.folder(table)}/{version}"
        writer = df.write.format(self.fmt).mode("overwrite").option("overwriteSchema", True)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(fresh)
        schema = stored_schema(df, partition_by)
        reader = self.spark.read.format(self.fmt)
        rows = (reader.schema(schema) if self.fmt == "parquet" else reader).load(fresh).count()
        if not rows and needed_for:
            if self.fmt == "parquet":
                remove_folder(self.spark, fresh)
            raise ValueError(f"{needed_for} is empty. Check input paths and data filters.")
        if self.fmt == "parquet":
            self._switch(table, {"version": version, "schema": schema.jsonValue(), "partition_by": list(partition_by)})
        return rows

    def replace_partitions(
        self, df: DataFrame, table: str, partition_by: Sequence[str], needed_for: str | None = None
    ) -> int:
        """Replace only the partitions that ``df`` has rows for, and return the rows of the whole table.

        The files of other partitions stay untouched, in the version in use; so a reader at the same time may see
        a partition without its files. The schema must be the table's; a table that isn't there yet is written.
        """
        current = self._current(table)
        if not current and self.fmt == "parquet":
            return self.write(df, table, partition_by, needed_for)
        if current:
            new, known = stored_schema(df, partition_by), T.StructType.fromJson(current["schema"])
            if [(f.name, f.dataType) for f in new] != [(f.name, f.dataType) for f in known] or current["partition_by"] != list(partition_by):
                raise ValueError(f"{table} has another schema or other partitions; write the whole table")
        path = self.path(table)
        writer = df.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_by).save(path)
        self.spark.catalog.refreshByPath(path)
        rows = self.read(table).count()
        if not rows and needed_for:
            raise ValueError(f"{needed_for} is empty. Check input paths and data filters.")
        return rows

    def _files(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def _current(self, table: str) -> dict | None:
        if self.fmt != "parquet":
            return None
        files, pointer = self._files(f"{self.folder(table)}/{POINTER}")
        if not files.exists(pointer):
            return None
        stream = files.open(pointer)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, table: str, current: dict) -> None:
        """Names the version in use by replacing one file, and removes all but that version and the one before."""
        jvm, old = self.spark.sparkContext._jvm, self._current(table)
        files, pointer = self._files(f"{self.folder(table)}/{POINTER}")
        _, fresh = self._files(f"{self.folder(table)}/_{uuid.uuid4().hex}.json")
        stream = files.create(fresh, True)
        stream.write(bytearray(json.dumps(current).encode()))
        stream.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(files.makeQualified(fresh), files.makeQualified(pointer), options)
        keep = {POINTER, current["version"], (old or {}).get("version")}
        for status in files.listStatus(pointer.getParent()):
            if status.getPath().getName() not in keep:
                files.delete(status.getPath(), True)

    def register(self, schema: str | None = None, tables: Sequence[str] = GOLD_TABLES) -> list[str]:
        """Make tables known by name; with a schema as external tables in it, without one as temporary views.

        A registered table that has other columns than the stored one, or lies where it no longer is, is
        registered anew; others stay as they are, but for new partitions. Returns the names added or replaced.
        """
        if schema is None:
            for table in tables:
                self.read(table).createOrReplaceTempView(table)
            return list(tables)
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{self.root}/schema'")
        catalog = self.spark.catalog
        added = []
        for table in tables:
            name, path = f"{schema}.{table}", self.path(table)
            if catalog.tableExists(name) and not self._registered(name, table, path):
                self.spark.sql(f"DROP TABLE {name}")
            if not catalog.tableExists(name):
                self.spark.sql(f"CREATE TABLE {name} USING {self.fmt} LOCATION '{path}'")
                added.append(name)
            if self.fmt == "parquet" and any(column.isPartition for column in catalog.listColumns(name)):
                catalog.recoverPartitions(name)
        return added

    def _registered(self, name: str, table: str, path: str) -> bool:
        """Whether a registered table has the stored table's columns and place."""
        files, wanted = self._files(path)
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
        _, place = self._files(described.data_type)
        columns = [(column.name, column.dataType) for column in self.spark.catalog.listColumns(name)]
        return files.makeQualified(wanted).equals(files.makeQualified(place)) and columns == self.read(table).dtypes


def stored_schema(df: DataFrame, partition_by: Sequence[str] = ()) -> T.StructType:
    """The schema that a table has when it is read: partition columns last, and every column nullable."""
    names = [name for name in df.columns if name not in partition_by]
    return T.StructType([T.StructField(name, df.schema[name].dataType) for name in (*names, *partition_by)])


def export_parquet(silver: DataFrame, path: str) -> None:
    """Plain Parquet copy of a table for use outside the lakehouse."""
    silver.write.mode("overwrite").parquet(path)


def read_trip_starts(spark: SparkSession, path: str) -> DataFrame:
    """Start time and place only, from an exported copy: all that the demand panel needs."""
    starts = spark.read.parquet(path).select("started_at", "start_lat", "start_lng")
    return starts.withColumn("started_at", starts.started_at.cast("timestamp"))
