"""WARC archives: exact round trips, false records inside payloads, damaged files."""

import hashlib

import pytest

from corpuslens.llm.common import Scratch
from corpuslens.llm.warc import END, HTTP, _segments, page_records, read_archives, round_trip, write_archives

FAKE = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5{END}hello{END}"


def pages():
    long, copy = "é" * 70_000, "x" * 1000
    return [
        (1, "http://a.b/c", "<p>one</p>"), (2, None, None), (3, "http://a.b/\r\nX: y", ""), (4, "u", FAKE), (5, "u", FAKE * 3 + "tail"),
        (6, "u", "WARC/1.1\r\n"), (7, "u", "a WARC/1. b WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 99999999" + END), (8, "u", long), (9, "u", long),
        (10, "u", copy), (11, "u", copy), (None, "u", copy), (12, "u", "y" * 999), (13, "u", "y" * 999), (11, "u", copy), (14, "WARC/1.1\r\nno: x", "z"),
        (15, "u", END), (16, "u", "\r\n"), (17, "u", "WARC/1.1\r\n" * 500), (18, "u", FAKE[:-3]), (19, "http://x/WARC/1.1/WARC/1.0", "q"),
    ]


def expected(rows):
    payload = [(i, (h or "").encode()) for i, _, h in rows]
    top = {}
    for i, p in payload:
        if len(p) >= 1000:
            top.setdefault(p, []).append(i)
    out = []
    for i, p in payload:
        ids = top.get(p, [])
        best = max((x for x in ids if x is not None), default=None)
        again = len(ids) > 1 and best is not None and i != best
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, compression):
    df = spark.createDataFrame([(*r, "x") for r in pages()], "page_id long, url string, html string, digest string").repartition(3)
    assert got(round_trip(df, compression)) == expected(pages())


def test_blocks_smaller_than_records(spark):
    rows = [r for r in pages() if r[0] not in (8, 9, 14, 19)] * 2
    scratch = Scratch(spark, "test-warc")
    path = scratch.path()
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, scratch, "none")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("700", "1024", "4001"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert _segments(spark, path).select("block").distinct().count() > 3
            assert got(page_records(read_archives(spark, path, scratch), scratch)) == expected(rows)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_payload_text_is_kept(spark):
    scratch = Scratch(spark, "test-warc")
    path = scratch.path()
    write_archives(spark.createDataFrame(pages(), "page_id long, url string, html string"), path, scratch, least_bytes=10**9)
    blocks = [bytes(r.block).decode() for r in read_archives(spark, path, scratch).collect()]
    assert sorted(blocks) == sorted(HTTP + (h or "") for _, _, h in pages())


def test_damage_is_refused(spark):
    scratch = Scratch(spark, "test-warc")
    path = scratch.path()
    spark.createDataFrame([(FAKE + FAKE + FAKE[:60],)], "v string").coalesce(1).write.option("lineSep", "\n").text(path)
    with pytest.raises(ValueError, match="do not reach"):
        read_archives(spark, path, scratch)


def test_no_pages(spark):
    assert got(round_trip(spark.createDataFrame([], "page_id long, url string, html string"))) == []
