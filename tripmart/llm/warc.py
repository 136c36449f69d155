"""WARC archives: write pages as records, and read archives back by verified chains of record boundaries.

Writing: one record per page, the html as an HTTP response. Of pages with equal payloads of at least
``LEAST_BYTES`` bytes, the one with the smallest page_id is a ``response``; the others are ``revisit`` records
without content that name it. Records are rows of a text sink whose line separator is the end of a WARC record,
so the files are WARC 1.1, plain or gzip, as many as there are partitions, and committed by Spark.

Reading: files are read in splits, cut at every occurrence of the magic ``WARC/1.1``, in payloads too. Each piece
that parses as a header is a candidate record, whose lengths give the offset of its successor. The chain of
true records begins at offset 0; pointer jumping (every round doubles the steps of the pointers) finds the
candidates on it in logarithmically many rounds, and only these are kept. Pieces between two of them are parts of
the first one's payload. Offsets are running totals of piece lengths over
the splits of a file; archives are to be of ordinary size (a GB or so), as one task goes through one.

NULL html is an empty payload. NULL page_ids are written as an empty id; they are the response only if all pages
with the payload have none. Rows with one page_id are separate records: with the smallest id all are responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.staging import Stage

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
#: Of a header: what comes between the magic and the empty line, the block length last.
_HEADER = r"^WARC-Type: (response|revisit)\r\n(?:[^\r\n]+\r\n)*Content-Length: ([0-9]{1,18})\r\n\r\n"


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def records(pages: DataFrame) -> DataFrame:
    """``record``: each page's WARC record without the end, from ``page_id, url, html``."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # Only payloads that occur twice or more are joined back, with small rows on either side.
    firsts = rows.where(F.octet_length("html") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(firsts.where("n > 1").drop("n"), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    block = F.when(revisit, "").otherwise(F.concat(F.lit(_HTTP), _bytes(F.col("html")).cast("string"), F.lit(END), F.col("html")))
    header = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: "), identity("page_id"),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.regexp_replace(F.col("url"), "[\r\n]", "%0A"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), identity("first"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), _bytes(block).cast("string"), F.lit(END),
    )
    return rows.select(F.concat(header, block).alias("record"))


def write(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """Archives as files below ``path``; ``compression`` is ``gzip`` (of whole files) or ``none``."""
    # The sink ends each row with its separator, which is what ends a record.
    records(pages).write.option("lineSep", END).option("compression", compression).text(path)


def _html(text: Column) -> Column:
    """The payload of a record: what follows its header and the HTTP header, without the end of the record."""
    block = F.substr(text, F.length(F.regexp_extract(text, _HEADER, 0)) + 1)
    block = F.regexp_replace(block, r"\r\n\r\n\z", "")
    return F.when(block == "", "").otherwise(F.substr(block, F.instr(block, END) + len(END)))


def _fields(text: Column) -> dict[str, Column]:
    head = F.regexp_extract(text, _HEADER, 0)
    field = lambda name: F.nullif(F.regexp_extract(head, rf"{name}([^\r\n>]*)", 1), F.lit(""))
    return {
        "page_id": field("WARC-Record-ID: <urn:page:").try_cast("long"),
        "record_type": field("WARC-Type: "),
        "refers_to": field("WARC-Refers-To: <urn:page:").try_cast("long"),
        "header_digest": field("WARC-Payload-Digest: sha256:"),
    }


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, next, piece``: what follows each magic, where the magic is, and where the record should end;
    the fields of its header, and ``bytes`` and ``digest`` of the payload of a record that is one piece.

    ``next`` is NULL where no header follows. All but ``piece`` are worked out where a file is read, and only small
    columns reach the shuffle if ``piece`` isn't used.
    """
    header = F.regexp_extract("value", _HEADER, 0)
    length = _bytes(F.col("value")) + len(MAGIC)
    span = F.when(header != "", len(MAGIC) + _bytes(header) + F.regexp_extract("value", _HEADER, 2).try_cast("long") + len(END))
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), length.alias("length"), span.alias("span"),
    )
    html = F.when(F.col("span") == F.col("length"), _html(F.col("value")))
    lines = lines.withColumns({**_fields(F.col("value")), "bytes": _bytes(html), "digest": F.sha2(html.cast("binary"), 256)})
    # Rows keep their order within a split; splits of a file follow each other. The piece before the first magic of
    # a file is empty and has no magic of its own: all offsets are one magic less.
    earlier = Window.partitionBy("file").orderBy("split", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)) - len(MAGIC))
    placed = placed.where("offset >= 0").withColumn("next", F.col("offset") + F.col("span"))
    return placed.withColumnRenamed("value", "piece").drop("split", "row", "length", "span")


def chain(candidates: DataFrame, stage: Stage) -> DataFrame:
    """``file, offset`` of the candidates (``file, offset, next``) that can be reached from offset 0."""
    known = candidates.select("file", F.col("offset").alias("next"), F.lit(True).alias("there"))
    # A successor that is no candidate (the end of the file, or nothing) ends a chain.
    state = candidates.join(known, ["file", "next"], "left")
    state = state.select("file", "offset", F.when(F.col("there"), F.col("next")).alias("next"), (F.col("offset") == 0).alias("reached"))
    turn = 0
    while True:
        state = stage.table(state, f"chain-{turn}")
        if state.where("next is not null").isEmpty():
            return state.where("reached").select("file", "offset")
        ahead = state.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        hits = state.where("reached and next is not null").select("file", F.col("next").alias("offset"), F.lit(True).alias("hit")).distinct()
        state = state.join(ahead, ["file", "next"], "left").join(hits, ["file", "offset"], "left")
        state = state.select("file", "offset", F.col("after").alias("next"), (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached"))
        turn += 1


_FIELDS = ("page_id", "record_type", "refers_to", "header_digest")


def records_of(spark: SparkSession, path: str, stage: Stage) -> DataFrame:
    """``file, offset``, header fields, ``bytes`` and ``digest`` of every true record; the last two are NULL if its
    payload holds the magic."""
    candidates = pieces(spark, path).where("next is not null").select("file", "offset", "next", *_FIELDS, "bytes", "digest")
    candidates = stage.table(candidates, "candidates")
    true = chain(candidates.select("file", "offset", "next"), stage)
    return stage.table(candidates.join(true, ["file", "offset"]), "records")


def whole(spark: SparkSession, path: str, true: DataFrame) -> DataFrame:
    """``page_id, record_type, refers_to, header_digest, html`` of true records (``file, offset``), of all there are in
    their files."""
    # Pieces without a true record at their own offset go on with the record before them.
    found = pieces(spark, path).select("file", "offset", "piece").join(true.select("file").distinct(), "file", "left_semi")
    owned = found.join(true.select("file", "offset", F.col("offset").alias("own")), ["file", "offset"], "left")
    owner = F.last("own", ignorenulls=True).over(Window.partitionBy("file").orderBy("offset"))
    owned = owned.withColumn("owner", owner).where("owner is not null")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "piece"))), lambda x: x["piece"])
    text = owned.groupBy("file", "owner").agg(F.array_join(parts, MAGIC).alias("record"))
    fields = [column.alias(name) for name, column in _fields(F.col("record")).items()]
    return text.select("file", F.col("owner").alias("offset"), *fields, _html(F.col("record")).alias("html"))


def read(spark: SparkSession, path: str, stage: Stage | None = None) -> DataFrame:
    """``page_id, record_type, refers_to, header_digest, html`` of every true record below ``path``."""
    return whole(spark, path, records_of(spark, path, stage or Stage(spark))).select(*_FIELDS, "html")


def payloads(spark: SparkSession, path: str, stage: Stage) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every true record below ``path``.

    Revisits have the payload of their response. Payloads are digested where they are read; only of files with a
    payload that holds the magic is text brought together.
    """
    true = records_of(spark, path, stage)
    rows = true.where("digest is not null").select(*_FIELDS, "bytes", "digest")
    split = true.where("digest is null").select("file", F.col("offset").alias("begin"))
    if not split.isEmpty():
        files = true.join(split.select("file").distinct(), "file", "left_semi")
        text = whole(spark, path, files).join(split.withColumnRenamed("begin", "offset"), ["file", "offset"], "left_semi")
        rows = rows.union(text.select(*_FIELDS, _bytes(F.col("html")), F.sha2(F.col("html").cast("binary"), 256)))
    rows = stage.table(rows, "read")
    own = rows.where("record_type = 'response'")
    first = own.groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("header_digest")).agg(F.max("bytes").alias("whole"))
    again = rows.where("record_type = 'revisit'").join(first, ["refers_to", "header_digest"])
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return own.select("page_id", "bytes", "digest", "record_type", "refers_to").toDF(*names).union(
        again.select("page_id", "whole", "header_digest", "record_type", "refers_to").toDF(*names)
    )


SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
