import hashlib

import pytest

from tripmart.llm import warc
from tripmart.session import Stage

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
SCHEMA = "page_id long, url string, html string"


def back(spark, pages, compression="gzip"):
    """The records' texts, and their payloads."""
    path = Stage(spark).path("archives")
    warc.write(pages.repartition(3), path, compression)
    rows = warc.read(spark, path).collect()
    return rows, sorted((tuple(r) for r in warc.payloads(spark, path, Stage(spark)).collect()), key=str)


def expected(rows):
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= warc.LEAST_BYTES and i is not None:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html in first and first[html] != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=str)


def pages():
    long = "<p>é</p>" * 40
    rows = [(i, f"http://x/{i}", f"<html>{i}{'y' * i}</html>") for i in range(40)]
    rows += [(100 + i, "u\r\nWARC-Type: x", long) for i in range(9)]
    rows += [(200, None, None), (201, "u", ""), (202, "u", FAKE), (203, "u", "x" * 90 + FAKE * 3 + "end"), (204, "u", "\r\n\r\n" * 50)]
    # Fake records that lead exactly to the end of their payload, or nowhere, and a magic at either end.
    rows += [(205, "u", "z" * 100 + FAKE), (206, "u", "WARC/1.1\r\n" * 30), (207, "u", FAKE.replace("5", "999999")), (208, "u", "q" * 120 + "WARC/1.1\r\n")]
    rows += [(None, "u", long), (209, "u", "<" * 99), (210, "u", "<" * 99), (211, "u", "<" * 100), (212, "u", "<" * 100)]
    return rows


@pytest.mark.parametrize("split, compression", [("128m", "gzip"), ("64k", "none"), ("700b", "none")])
def test_round_trip(spark, conf, split, compression):
    conf("spark.sql.files.maxPartitionBytes", split)
    conf("spark.sql.files.openCostInBytes", "1")
    rows = pages()
    read, got = back(spark, spark.createDataFrame(rows, SCHEMA), compression)
    html = {r.page_id: r.html for r in read if r.record_type == "response"}
    wrong = [i for i, _, h in rows if i in html and html[i] != (h or "")]
    assert wrong == [] and len(read) == len(rows)
    assert got == expected(rows)


def test_files_are_plain_warc(spark):
    stage = Stage(spark)
    warc.write(spark.createDataFrame([(1, "u", "a" * 200)], SCHEMA).coalesce(1), stage.path("one"), "none")
    data = spark.read.format("binaryFile").load(stage.path("one")).first().content
    head, _, block = bytes(data).partition(b"\r\n\r\n")
    length = int(head.rpartition(b"Content-Length: ")[2])
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")
    assert block[:length].endswith(b"a" * 200) and block[length:] == b"\r\n\r\n"


def test_empty_and_repeated(spark):
    assert back(spark, spark.createDataFrame([], SCHEMA)) == ([], [])
    rows = [(1, "u", "b" * 300), (1, "u", "b" * 300), (2, "u", "b" * 300)]
    assert back(spark, spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS first"))[1] == expected(rows)
