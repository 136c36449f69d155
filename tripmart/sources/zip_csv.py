"""Trip CSV files inside ZIP archives."""

from __future__ import annotations

import hashlib
import io
import json
import sys
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tripmart.session import Stage
from tripmart.sources.raw_csv import SOURCE_FILE, file_system, header_columns, text_schema

# Functions that run in tasks are sent along with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LINES_PER_BATCH = 20_000
RANGE_BYTES = 1 << 20
#: So many archives' directories are read at once when a read is planned.
PLAN_THREADS = 16
LINE_SCHEMA = pa.schema([(name, pa.string()) for name in (SOURCE_FILE, "layout", "header", "line")])
SPARK_LINE_SCHEMA = ", ".join(f"{name} string" for name in LINE_SCHEMA.names)


def _member_lines(archive: zipfile.ZipFile, member: str) -> Iterator[list[str]]:
    """Non-blank lines of one member in batches, unpacked as they are read; the header comes alone."""
    with archive.open(member) as raw:
        batch: list[str] = []
        limit = 1
        for line in io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace"):
            line = line.rstrip("\n")
            if line.strip():
                batch.append(line)
            if len(batch) == limit:
                yield batch
                batch, limit = [], LINES_PER_BATCH
        if batch:
            yield batch


def _member_batches(archive: zipfile.ZipFile, member: str, source: str) -> Iterator[pa.RecordBatch]:
    """One row for the header, without a line, and then rows for the lines, without the header."""
    batches = _member_lines(archive, member)
    for header in next(batches, []):
        layout = hashlib.md5(header.encode()).hexdigest()
        yield pa.RecordBatch.from_pylist(
            [{SOURCE_FILE: source, "layout": layout, "header": header}], LINE_SCHEMA
        )
        for lines in batches:
            count = len(lines)
            columns = [
                pa.repeat(pa.scalar(source), count),
                pa.repeat(pa.scalar(layout), count),
                pa.nulls(count, pa.string()),
                pa.array(lines, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=LINE_SCHEMA)


def csv_members(archive: zipfile.ZipFile, path: str) -> list[str]:
    """The CSV members of an archive, those with hidden names left out; an archive without any is an error."""
    members = [name for name in archive.namelist() if name.lower().endswith(".csv")]
    if not members:
        raise RuntimeError(f"No CSV files found inside {path}")
    return [name for name in members if not file_name(name).startswith((".", "_"))]


def file_name(member: str) -> str:
    return member.rsplit("/", 1)[-1]


@contextmanager
def opened(uri: str) -> Iterator[zipfile.ZipFile]:
    """An archive of which only what is asked for is read, by ranges."""
    system, path = file_system(uri)
    with system.open_input_file(path) as file, zipfile.ZipFile(io.BufferedReader(file, RANGE_BYTES)) as archive:
        yield archive


def _planned(uri: str) -> list[tuple[str, str]]:
    with opened(uri) as archive:
        return [(uri, member) for member in csv_members(archive, uri)]


class MemberReader(DataSourceReader):
    def __init__(self, archives: list[str]):
        self.archives = archives

    def partitions(self) -> list[InputPartition]:
        with ThreadPoolExecutor(PLAN_THREADS) as pool:
            members = [member for found in pool.map(_planned, self.archives) for member in found]
        return [InputPartition(member) for member in members] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is not None:
            uri, member = partition.value
            with opened(uri) as archive:
                yield from _member_batches(archive, member, f"{uri}/{file_name(member)}")


class ZipMembers(DataSource):
    """Lines of the CSV members of archives: a partition a member, planned from the archives' directories."""

    @classmethod
    def name(cls) -> str:
        return "zip_csv_members"

    def schema(self) -> str:
        return SPARK_LINE_SCHEMA

    def reader(self, schema) -> MemberReader:
        return MemberReader(json.loads(self.options["archives"]))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of whole archives, read in place from the Arrow buffer: for stores that only Spark reads."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                for member in csv_members(archive, path):
                    yield from _member_batches(archive, member, f"{path}/{file_name(member)}")


def reachable(uri: str) -> bool:
    """Whether tasks can open files of this store themselves."""
    try:
        system, path = file_system(uri)
        with system.open_input_file(path):
            return True
    except (OSError, ValueError, pa.ArrowException):
        return False


def member_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of every CSV member of the archives at ``path``, with their member's header."""
    archives = spark.read.format("binaryFile").load(path)
    names = [row.path for row in archives.select("path").collect()]
    if names and not reachable(names[0]):
        return archives.select("path", "content").mapInArrow(_unpack, SPARK_LINE_SCHEMA)
    spark.dataSource.register(ZipMembers)
    return spark.read.format(ZipMembers.name()).option("archives", json.dumps(names)).load()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_zip_csv(spark: SparkSession, path: str, stage: Stage, with_source: bool = False) -> DataFrame:
    """All rows of every ``*.csv`` member of the archives at ``path``, every column text.

    A member can't be split, so one task unpacks one member, streaming it; the directories of the archives tell
    where each is, and only its own range is read. The lines are
    staged as a table by header; from there on Spark splits and parses them like any other data.
    Rows of members with the same file name are all kept. In a store that only Spark can read, one task
    unpacks one archive, of up to 2 GB.
    """
    lines = stage.table(member_lines(spark, path), "unzipped", partition_by=("layout",))
    headers = lines.where(F.col("header").isNotNull())
    layouts = sorted(headers.select("layout", "header").distinct().collect())

    def parsed(layout: str, header: str) -> DataFrame:
        names = header_columns(header)
        schema = ", ".join(f"{quoted(name)} string" for name in names)
        rows = lines.where((F.col("layout") == layout) & F.col("line").isNotNull())
        rows = rows.select(SOURCE_FILE, F.from_csv("line", schema).alias("row"))
        columns = [F.col("row").getField(name).alias(name) for name in names]
        return rows.select(*columns, *([SOURCE_FILE] if with_source else []))

    if not layouts:
        return spark.createDataFrame([], text_schema([SOURCE_FILE] if with_source else []))
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [parsed(row.layout, row.header) for row in layouts],
    )
