"""Landing zone of trip CSV files, plain or gzip."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Functions that run in tasks are sent along with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCE_FILE = "source_file"
HEADER_BYTES = 1 << 14
BLANK = b" \t\r\n"
#: An index of so many files is sent to all tasks (some 200 bytes a file); a longer one is joined by a shuffle.
BROADCAST_FILES = 200_000


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(column, T.StringType()) for column in columns])


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("multiLine", False)


def header_columns(header: str) -> list[str]:
    """Column names of a header line; blank and repeated names (in any case) get their position appended."""
    names: list[str] = []
    for position, name in enumerate(next(csv.reader([header.removeprefix("﻿")]))):
        name = name or "_c"
        taken = name == "_c" or name.lower() in map(str.lower, names)
        names.append(f"{name}{position}" if taken else name)
    return names


def file_system(uri: str):
    """The file system of a URI and the path in it, for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _open(uri: str):
    """The file at a URI as a stream, unpacked if its name says gzip; nothing of it is read yet."""
    system, path = file_system(uri)
    return system.open_input_stream(path, compression="gzip" if uri.endswith(".gz") else None, buffer_size=HEADER_BYTES)


def _first_line(stream) -> str:
    """The first line that isn't blank."""
    text = b""
    while block := stream.read(HEADER_BYTES):
        text += block
        line, end, _ = text.lstrip(BLANK).partition(b"\n")
        if end:
            break
    return text.lstrip(BLANK).partition(b"\n")[0].decode("utf-8", "replace").rstrip("\r")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[str | None] = []
        for uri in batch.column("path").to_pylist():
            try:
                with _open(uri) as stream:
                    found.append(_first_line(stream))
            except (OSError, ValueError, pa.ArrowException):
                found.append(None)
        yield pa.RecordBatch.from_arrays([batch.column(SOURCE_FILE), pa.array(found, pa.string())], [SOURCE_FILE, "header"])


def header_index(spark: SparkSession, path: str) -> DataFrame:
    """``source_file, header`` for each file of the landing zone: one job, whose tasks read the first block of each file.

    ``header`` is empty for a file without lines, and NULL where the tasks can't open the store themselves.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return files.mapInArrow(_headers, f"{SOURCE_FILE} string, header string")


def scanned_index(spark: SparkSession, path: str) -> DataFrame:
    """The same as ``header_index`` for a store that only Spark reads: one scan, of which a line a file is kept."""
    place = F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row")).alias("place")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias(SOURCE_FILE), place, "value")
    lines = lines.where(F.trim(F.translate("value", BLANK.decode(), "")) != "")
    return lines.groupBy(SOURCE_FILE).agg(F.min_by("value", "place").alias("header"))


def file_layouts(index: DataFrame) -> list[str | None]:
    """The different header lines of an index, in order."""
    return sorted((row.header for row in index.where("header <> '' OR header IS NULL").select("header").distinct().collect()), key=str)


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    with_source: bool = False,
) -> DataFrame:
    """All rows of a folder of CSV files, every column text.

    Spark binds CSV columns by position, so headers are looked at first, and put together by name; a
    column that a file lacks is NULL in its rows. All files are read in one scan: where layouts differ, each row
    finds its file's layout in the header index. Where every file is known to have the header
    ``columns``, pass it: no first lines are read, and the scan itself fails on any other header.
    """
    extra = [SOURCE_FILE] if with_source else []

    def scan(header: Sequence[str], header_known: bool) -> DataFrame:
        # With enforceSchema off, Spark compares the schema to the header of every file it reads.
        rows = _reader(spark).option("enforceSchema", header_known).schema(text_schema(header)).csv(path)
        return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))

    if columns is not None:
        return scan(columns, header_known=False).select(*columns, *extra)
    index = header_index(spark, path)
    headers = file_layouts(index)
    if None in headers:
        index = scanned_index(spark, path)
        headers = file_layouts(index)
    layouts = [header_columns(header) for header in headers]
    if not layouts:
        return spark.createDataFrame([], text_schema(extra))
    if len(layouts) == 1:
        rows = scan(layouts[0], header_known=True)
        return rows if with_source else rows.drop(SOURCE_FILE)
    number = F.create_map(*[F.lit(x) for place, header in enumerate(headers) for x in (header, place)])
    index = index.where("header <> ''").select(SOURCE_FILE, number[F.col("header")].alias("layout"))
    if len(spark.read.text(path).inputFiles()) <= BROADCAST_FILES:
        index = F.broadcast(index)
    width = max(map(len, layouts))
    rows = scan([f"c{place}" for place in range(width)], header_known=True).join(index, SOURCE_FILE)

    def value(name: str) -> Column:
        """The column at the place that the row's layout gives it."""
        places = {number: layout.index(name) for number, layout in enumerate(layouts) if name in layout}
        if len(set(places.values())) == 1 and len(places) == len(layouts):
            return F.col(f"c{places[0]}")
        found = F.lit(None).cast("string")
        for place in sorted(set(places.values())):
            of = [number for number, at in places.items() if at == place]
            found = F.when(F.col("layout").isin(of), F.col(f"c{place}")).otherwise(found)
        return found

    names = dict.fromkeys(name for layout in layouts for name in layout)
    return rows.select(*[value(name).alias(name) for name in names], *extra)
