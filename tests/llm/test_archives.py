"""WARC round trips with payloads that imitate records."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import warc
from millrace.session import shared_dir

M = warc.MAGIC
PAGES = [
    (1, "http://a/b c\r\nX: y", None),
    (2, None, ""),
    (3, "u", "x" * 50),
    (4, "u", "x" * 50),
    (5, "u", f"evil {M}WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n{M}"),
    (None, "u", "zz"),
    (7, "u", "zz"),
    (7, "u", "zz"),
    (8, "u", M),
    (9, "u", M * 3 + "é" * 40),
    (10, "u", "\r\n\r\n" + M + "Content-Length: 99999\r\n\r\n"),
    (11, "u", "<p>ü</p>" + "long " * 20_000),
    *[(100 + i, "v", f"p{i % 20}" * (i % 7 + 1)) for i in range(120)],
]
SCHEMA = "page_id long, url string, html string, record_type string"


def wanted(min_bytes=0):
    rows = []
    for i, _, html in PAGES:
        payload = (html or "").encode()
        same = [j for j, _, other in PAGES if (other or "") == (html or "")]
        largest = max((j for j in same if j is not None), default=None)
        revisit = len(same) > 1 and i != largest and len(payload) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        rows.append((i, len(payload), digest, "revisit" if revisit else "response", largest if revisit else None))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("split", ["128m", "900"])
def test_round_trip(spark, rows, monkeypatch, split):
    monkeypatch.setattr(warc, "FILE_RECORDS", 40)
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], SCHEMA).coalesce(2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = warc.round_trip(pages)
        assert rows(warc.reported(found)) == wanted()
        payload = found.where("page_id = 5").select(F.col("payload").cast("string")).first()[0]
        assert payload == PAGES[4][2]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_pages_are_not_revisits(spark, rows):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], SCHEMA)
    assert rows(warc.reported(warc.round_trip(pages, min_bytes=3))) == wanted(3)


def test_a_file_that_does_not_start_with_a_record_has_none(spark):
    path = shared_dir(spark, "broken")
    broken = spark.createDataFrame([(f"junk{M}WARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n",)], "value string")
    broken.write.option("lineSep", "\n").text(path)
    assert warc.read_archives(spark, path).count() == 0


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_other_blocks_in_the_second_scan_fail(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(5)], "page_id long, url string, html string")
    plain = warc.pieces

    def moved(session, path, content):
        found = plain(session, path, content)
        return found.withColumn("block", F.col("block") + 1) if content else found

    assert warc.round_trip(pages).count() == 5
    monkeypatch.setattr(warc, "pieces", moved)
    with pytest.raises(Exception, match="other blocks"):
        warc.round_trip(pages).count()
