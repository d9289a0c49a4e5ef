"""WARC archives written and read back with verified record boundaries.

Archives are written by Spark's text sink, one record a row, and may be compressed. They are read as
segments between occurrences of the magic ``WARC/1.``, which Spark's reader finds across block borders.
An occurrence may lie inside a payload, so tasks only emit candidates: the offset of a possible record
and that of its successor, from its header. Pointer jumping from offset 0 of every file doubles the
known part of the chain in each step and keeps the candidates it reaches; segments between two of them
belong to the payload of the former. An archive whose chain does not end at its last byte is refused.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpuslens.llm.common import Scratch, read, with_small
from corpuslens.llm.registry import query

MAGIC, END = "WARC/1.", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are written in full each time.
LEAST_BYTES = 1000


def payload_digest(payload: Column) -> Column:
    return F.sha1(payload.cast("binary"))


def as_records(pages: DataFrame, scratch: Scratch, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``record``: the text of a record for each page, without the blank lines that follow it.

    Of pages with equal payloads of ``least_bytes`` or more, those with the largest page_id are
    responses and the others revisit them; a null page_id is below any other.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({"digest": payload_digest(F.col("payload")), "n": F.octet_length("payload")})
    groups = rows.filter(F.col("n") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("copies"))
    rows = with_small(rows, scratch.keep(groups.filter("copies > 1 and top is not null").select("digest", "top")), ["digest"])
    again = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")) & (F.col("n") >= least_bytes)
    block = F.concat(F.lit(HTTP), F.when(again, F.lit("")).otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        "\r\n",
        F.lit(MAGIC + "1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("top")))),
        F.when(again, F.lit("WARC-Profile: " + REVISIT)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(END), block).alias("record"))


def write_archives(pages: DataFrame, path: str, scratch: Scratch, compression: str = "gzip", least_bytes: int = LEAST_BYTES) -> None:
    """One archive file per task; a record is written whole, so files of any size are read back."""
    as_records(pages, scratch, least_bytes).write.option("lineSep", END).option("compression", compression).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, m, value``: what lies between occurrences of the magic, numbered in file order."""
    text = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("m"), "value")


_START = re.compile(rb"[0-9]\r\n[A-Za-z0-9-]+[ \t]*:")
_LENGTH = re.compile(rb"\r\ncontent-length[ \t]*:[ \t]*([0-9]+)[ \t]*(?=\r\n|$)", re.I)
PLACED = "file string, block long, m long, n long, rest long"


def _candidates(segments: DataFrame) -> DataFrame:
    """``n``: bytes of each segment with its magic; ``rest``: of the record it may begin (null: none).

    A header that the magic interrupts goes on in the next segments.
    """

    def scan(batches):
        open_: list[list] = []  # file, block, m, n, header so far
        last = None
        for batch in batches:
            rows = []
            for file, block, m, value in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (file, block) != last:
                    rows += [(*x[:4], None) for x in open_]
                    open_, last = [], (file, block)
                n, cut = len(value) + len(MAGIC), value.find(END.encode())
                if _START.match(value):
                    open_.append([file, block, m, n, b""])
                else:
                    rows.append((file, block, m, n, None))
                for x in open_:
                    x[4] += (MAGIC.encode() if x[2] != m else b"") + (value if cut < 0 else value[:cut])
                if cut >= 0:
                    for x in open_:
                        size = _LENGTH.search(x[4])
                        rows.append((*x[:4], len(MAGIC) + len(x[4]) + 2 * len(END) + int(size[1]) if size else None))
                    open_ = []
            yield _placed(rows)
        yield _placed([(*x[:4], None) for x in open_])

    def _placed(rows):
        cols = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.string(), *[pa.int64()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["file", "block", "m", "n", "rest"])

    return segments.select("file", "block", "m", F.col("value").cast("binary")).mapInArrow(scan, PLACED)


def _located(placed: DataFrame) -> DataFrame:
    """With ``off``, the offset of the segment's magic in its file.

    Sums are taken inside each block, a bounded piece of a file, and then over the blocks. The first
    segment of a file lies before its first magic, so its ``n`` counts a magic too many.
    """
    inner = Window.partitionBy("file", "block").orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("file", "block").agg(F.sum("n").alias("size"))
    start = F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("file", "block", start.alias("start"))
    off = F.col("start") + F.coalesce(F.sum("n").over(inner), F.lit(0)) - len(MAGIC)
    return placed.join(blocks, ["file", "block"]).withColumn("off", off).drop("start")


def _reached(candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """``file, off`` of the candidates ``(file, off, to)`` on the chain from offset 0, by pointer jumping."""
    jumps, reached = candidates, scratch.keep(candidates.filter("off = 0").select("file", "off"))
    n = reached.count()
    while True:
        ahead = reached.join(jumps, ["file", "off"]).select("file", F.col("to").alias("off")).join(candidates.select("file", "off"), ["file", "off"], "left_semi")
        both = scratch.keep(reached.unionAll(ahead))
        scratch.drop(reached)
        reached, before, n = both, n, both.count()
        if n == before:
            return reached
        twice = jumps.select("file", F.col("off").alias("to"), F.col("to").alias("then"))
        further = scratch.keep(jumps.join(twice, ["file", "to"]).select("file", "off", F.col("then").alias("to")))
        if jumps is not candidates:
            scratch.drop(jumps)
        jumps = further


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """``head`` (header lines as text) and ``block`` (bytes) of every record of the archives under ``path``.

    Raises ValueError if the chain of some file does not end at its end: the archive is cut or damaged.
    """
    segments = _segments(spark, path)
    placed = scratch.keep(_located(_candidates(segments)))
    candidates = scratch.keep(placed.filter("rest is not null").select("file", "off", (F.col("off") + F.col("rest")).alias("to")))
    reached = _reached(candidates, scratch).withColumn("starts", F.lit(True))
    placed = scratch.keep(placed.join(reached, ["file", "off"], "left"))
    chain_end = F.max(F.when(F.col("starts"), F.col("off") + F.col("rest")))
    files = placed.groupBy("file").agg(chain_end.alias("chain"), F.max(F.col("off") + F.col("n")).alias("size"))
    bad = files.filter("size > 0 and not chain <=> size").limit(3).collect()
    if bad:
        raise ValueError(f"archives whose records do not reach their end: {[tuple(r) for r in bad]}")

    # Nearly every record is one segment. The others, and what lies inside them, are put together.
    lone = F.col("starts") & (F.col("rest") == F.col("n"))
    odd = scratch.keep(_owned(placed).filter(~F.coalesce(lone, F.lit(False))).select("file", "block", "m", "owner"))
    if odd.isEmpty():
        whole = segments.select("value")
    else:
        marked = with_small(segments, odd.withColumn("odd", F.lit(True)), ["file", "block", "m"])
        parts = marked.filter("odd and owner is not null").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("m", "value"))).alias("parts"))
        joined = parts.select(F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC).alias("value"))
        whole = marked.filter("odd is null").select("value").unionAll(joined)
    value = F.col("value")
    head = F.substring_index(value, END, 1)
    length = F.regexp_extract(head, r"(?i)\r\ncontent-length[ \t]*:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", 1).cast("int")
    block = F.substring(value.cast("binary"), F.octet_length(head) + len(END) + 1, length)
    return whole.select(head.alias("head"), block.alias("block"))


def _owned(placed: DataFrame) -> DataFrame:
    """With ``owner``: offset of the record a segment belongs to; null for what precedes the first magic."""
    upto = Window.partitionBy("file").orderBy("off", "m")
    return placed.withColumn("owner", F.last(F.when(F.col("starts"), F.col("off")), ignorenulls=True).over(upto))


def field(head: Column, name: str) -> Column:
    """Value of a header field; null where there is none."""
    return F.nullif(F.regexp_extract(head, rf"(?i)\r\n{name}[ \t]*:[ \t]*([^\r\n]*)", 1), F.lit(""))


def page_records(records: DataFrame, scratch: Scratch) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest`` of records of pages.

    Sizes and digests are taken from the payloads read; a revisit has those of the response it names.
    """
    head, block = F.col("head"), F.col("block")
    urn = lambda c: F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1)
    number = lambda c: F.when(urn(c) != "", urn(c).cast("long"))
    http = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END)
    payload = F.substring(block, http + 1, F.greatest(F.octet_length(block) - http, F.lit(0)))
    rows = records.select(
        number(field(head, "WARC-Record-ID")).alias("page_id"),
        field(head, "WARC-Target-URI").alias("url"),
        field(head, "WARC-Type").alias("record_type"),
        number(field(head, "WARC-Refers-To")).alias("refers_to"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload_digest(payload).alias("payload_digest"),
    )
    rows = scratch.keep(rows)
    full = rows.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to")).agg(F.max_by("payload_bytes", "payload_bytes").alias("b"), F.max_by("payload_digest", "payload_bytes").alias("d"))
    again = rows.filter("record_type = 'revisit'").join(full, "refers_to", "left")
    again = again.select("page_id", "url", "record_type", "refers_to", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"))
    return rows.filter("record_type <> 'revisit'").unionByName(again)


def round_trip(pages: DataFrame, compression: str = "gzip") -> DataFrame:
    """Write the pages to archives in the shared folder and read them back; see ``page_records``.

    One row per page row. A null html is an empty payload, a null URL an empty one; line breaks in a URL
    are written as %0D and %0A. Repeated rows are written each; rows that share the largest page_id of a
    payload are all responses. Without pages there are no records. Other columns are not written.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    path = scratch.path()
    write_archives(pages, path, scratch, compression)
    return page_records(read_archives(spark, path, scratch), scratch)


SQL = """
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS p, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), top AS (SELECT d, max(page_id) AS top FROM payload WHERE n >= 1000 GROUP BY d HAVING count(*) > 1)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
  CASE WHEN top IS NOT NULL AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM payload p LEFT JOIN top t ON p.d = t.d AND n >= 1000
"""


@query(SQL)
def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(read(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
