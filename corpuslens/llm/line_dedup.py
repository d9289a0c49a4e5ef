"""Lines that many documents share, dropped through per-document bitmaps.

Line hashes are range-partitioned and sorted by (hash, document, position); every task streams its
range once and counts documents per hash. Ranges are cut on all columns, so a line that a third of all
documents hold is spread over many tasks. A hash at either end of a range may go on in the next one:
its count there, two rows a range, is put together afterwards. Texts do not take part: decisions come
back as one compressed keep bitmap per document.

A document is a pair of id and text: equal rows are one document and decided alike, and rows that
share an id (or have none) but not the text are documents of their own.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from corpuslens.llm.common import ROWS, Remembered, Scratch, read, sliced
from corpuslens.llm.registry import query

BLANK = b" \t\n\x0b\x0c\r"
#: Rows of a streamed range: n = DROP or OPEN for a line, else the documents of a hash at an end of the range.
DROP, OPEN = -1, -2
STREAMED = "h binary, doc long, t long, pos int, part int, n long, head_doc long, head_t long, tail_doc long, tail_t long"
_ARROW = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]
_NAMES = [c.split()[0] for c in STREAMED.split(", ")]


def _batch(rows: list[tuple], n: int) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * n
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW, strict=False)], names=_NAMES[:n])


def text_mark(text: Column) -> Column:
    """With the id, what tells documents apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h, doc, t, pos`` of every line whose key has at least ``min_chars`` code points; ``h`` is 128 bits."""

    def lines(batches):
        known = Remembered(lambda key: hashlib.blake2b(key, digest_size=16).digest())
        rows: list[tuple] = []
        for batch in sliced(batches):
            for doc, t, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for pos, line in enumerate((text or "").encode().split(b"\n")):
                    key = line.strip(BLANK).lower()
                    if len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars):
                        continue
                    rows.append((known[key], doc, t, pos))
                if len(rows) > 20_000:
                    yield _batch(rows, 4)
                    rows = []
        yield _batch(rows, 4)

    columns = docs.select(F.col("doc_id").cast("long"), text_mark(F.col("text")), "text")
    return columns.mapInArrow(lines, "h binary, doc long, t long, pos int")


def streamed_ranges(hashes: DataFrame, min_docs: int) -> DataFrame:
    """The lines to drop as far as one range can tell, and what it must leave open; see STREAMED.

    A line waits until ``min_docs`` documents of its hash were seen, so a task holds the lines of fewer
    documents than that.
    """

    def stream(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        now, n, head, last, is_first = None, 0, (None, None), (None, None), True
        held: list[tuple] = []
        out: list[tuple] = []

        def close(at_end: bool) -> None:
            if now is not None and (is_first or at_end):
                out.append((now, None, None, None, part, n, *head, *last))
                out.extend((*x, part, OPEN, None, None, None, None) for x in held)

        for batch in batches:
            for h, doc, t, pos in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if h != now:
                    close(False)
                    is_first = now is None
                    now, n, head, held = h, 0, (doc, t), []
                if n == 0 or (doc, t) != last:
                    n, last = n + 1, (doc, t)
                if n < min_docs:
                    held.append((h, doc, t, pos))
                    continue
                out.extend((*x, part, DROP, None, None, None, None) for x in held)
                held = []
                out.append((h, doc, t, pos, part, DROP, None, None, None, None))
                if len(out) > 20_000:
                    yield _batch(out, 10)
                    out = []
        close(True)
        yield _batch(out, 10)

    keys = ["h", "doc", "t", "pos"]
    return hashes.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(stream, STREAMED)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """``doc, t, keep`` of documents that lose lines: zlib-packed bits, 1 for a kept line.

    Bits end with the last dropped line; lines beyond are kept. ``t`` is the text's ``text_mark``.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    rows = scratch.keep(streamed_ranges(line_hashes(docs, min_chars), min_docs))
    ends = rows.filter("n >= 0")
    before = Window.partitionBy("h").orderBy("part")
    straddles = F.lag("tail_doc").over(before).eqNullSafe(F.col("head_doc")) & (F.lag("tail_t").over(before) == F.col("head_t"))
    total = ends.withColumn("own", F.col("n") - F.coalesce(straddles, F.lit(False)).cast("int")).groupBy("h").agg(F.sum("own").alias("docs"))
    late = rows.filter(F.col("n") == OPEN).join(total.filter(F.col("docs") >= min_docs), "h", "left_semi")
    dropped = rows.filter(F.col("n") == DROP).select("doc", "t", "pos").unionByName(late.select("doc", "t", "pos"))
    return dropped.groupBy("doc", "t").agg(F.collect_set("pos").alias("gone")).select("doc", "t", _packed("gone").alias("keep"))


@F.pandas_udf(T.BinaryType())
def _packed(gone: pd.Series) -> pd.Series:
    def pack(places):
        keep = np.ones((int(max(places)) // 8 + 1) * 8, dtype=bool)  # whole bytes
        keep[np.asarray(places)] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return gone.map(pack)


@F.arrow_udf(T.StringType())
def _kept(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    def cut(text, bits):
        if bits is None:
            return None
        lines = (text or "").split("\n")
        stays = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))[: len(lines)]
        return "\n".join([x for x, y in zip(lines, stays, strict=False) if y] + lines[len(stays) :])

    for text, keep in columns:
        parts = [[cut(x.as_py(), y.as_py()) for x, y in zip(text[i : i + ROWS], keep[i : i + ROWS], strict=True)] for i in range(0, len(text), ROWS)]
        yield pa.concat_arrays([pa.array(p, pa.string()) for p in parts]) if parts else pa.array([], pa.string())


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The documents, with all columns, and ``kept`` (text without shared lines), ``n_lines``, ``n_dropped``.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of ``min_chars`` code
    points or more that ``min_docs`` documents or more hold lose all their lines. Null and empty texts
    are one empty line; if every line goes, the text is empty. Columns named like the results are
    replaced.
    """
    columns = [c for c in docs.columns if c not in ("kept", "n_lines", "n_dropped")]
    bitmaps = keep_bitmaps(docs, min_docs, min_chars).select(F.col("doc").alias("__doc"), F.col("t").alias("__t"), F.col("keep").alias("__keep"))
    marked = docs.withColumn("__mark", text_mark(docs["text"]))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__mark") == F.col("__t"))
    joined = marked.join(bitmaps.hint("shuffle_hash"), same, "left")
    whole = F.coalesce(F.col("text"), F.lit(""))
    n_lines = lambda c: F.length(c) - F.length(F.translate(c, "\n", "")) + 1
    cut = joined.withColumn("__cut", _kept(F.when(F.col("__keep").isNotNull(), whole), F.col("__keep")))
    n = n_lines(whole).cast("long")
    gone = F.when(F.col("__keep").isNull(), F.lit(0)).otherwise(F.col("__gone"))
    cut = cut.withColumn("__gone", _n_gone(F.col("__keep")))
    return cut.select(*[cut[c] for c in columns], F.coalesce("__cut", whole).alias("kept"), n.alias("n_lines"), gone.cast("long").alias("n_dropped"))


@F.pandas_udf(T.LongType())
def _n_gone(keep: pd.Series) -> pd.Series:
    def count(bits):
        if bits is None:
            return 0
        stays = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8))
        return int(len(stays) - stays.sum())

    return keep.map(count)


SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(generate_series(1, len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), shared AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (s.key IS NOT NULL)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (s.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key GROUP BY doc_id
"""


@query(SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
