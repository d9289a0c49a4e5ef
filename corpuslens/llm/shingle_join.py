"""Near-duplicate documents by a blocked sparse product of documents and word n-grams.

A document is the set of its word n-grams, as sorted 64-bit hashes. Two sets with Jaccard similarity of
at least t differ in so few n-grams, by their sizes, that of one part more than that number at least one
part of the hash range has the same n-grams in both. Documents that share the signature of a part are
candidates, whatever n-grams are frequent in the corpus, and no pair is lost.

Candidates are gathered in cells: documents that share several signatures are a family; one that shares
a signature with another family visits it; a signature that many families share is a cell of its own. In
a cell, rows of the incidence matrix are multiplied block by block. Blocks hold rows of similar size, and
pairs of blocks whose sizes rule a link out are left out, as are pairs below the bound that their sizes
set. Tasks return stars of the local components, so what moves grows with the rows, not with the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslens.llm.common import BROADCAST_IDS, Remembered, Scratch, components, read, sliced, with_small
from corpuslens.llm.registry import query

WORDS = 3
#: Jaccard similarity of linked documents, as a fraction.
SIMILARITY = (90, 100)
#: Rows of a block and n-grams in all of them, about; and columns that are multiplied at a time.
BLOCK, GRAMS, COLUMNS = 512, 1 << 18, 4096
#: Blocks of a large cell hold rows whose sizes differ by this factor at most.
SIZE_STEP = 1.05
#: One part to spare for so many that linked sets can differ in.
SPARE = 8
#: A signature that more families share than this is a cell of its own.
FAMILIES = 8
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def _hashes() -> Remembered:
    """Word to hash."""
    return Remembered(xxhash.xxh3_64_intdigest)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C[3]
    x = (x ^ (x >> np.uint64(29))) * _C[4]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, known: Remembered, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; with fewer words, of all words as one; none without words."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(known.__getitem__, w), dtype=np.uint64, count=len(w))
    k = min(words, len(h))
    total = np.full(len(h) - k + 1, k, dtype=np.uint64) * _C[4]
    for i in range(k):
        total = _mixed(total + h[i : len(h) - k + 1 + i] * _C[0])
    return np.unique(total)


def levels(similarity: tuple[int, int]) -> np.ndarray:
    """Least sizes of the size levels: a set of one level links only with sets of it and of its neighbours."""
    num, den = similarity
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * den // num + 1)
    return np.array(out, dtype=np.int64)


def signatures(h: np.ndarray, bounds: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, list[int]]:
    """Signatures of the set's parts, at its own level and at the next, where larger sets meet it.

    There are more parts than two linked sets can differ in, so linked sets share several signatures of
    a level: the second result is how many at least, for even and for odd levels (the last bit of a
    signature). Empty parts say little and have none; a set with more empty parts than there are parts
    to spare keeps those, and one shared signature is enough for it.
    """
    num, den = similarity
    level = int(np.searchsorted(bounds, len(h), side="right")) - 1
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_mixed(h + _C[1]))])
    out, need = [], [1, 1]
    for k in (level, level + 1):
        largest = int(bounds[k + 1]) - 1
        # |x - y| + |y - x| of linked sets is at most (den - num) / (den + num) of |x| + |y|
        differ = 2 * largest * (den - num) // (den + num)
        spare = 1 + differ // SPARE if differ else 0
        parts = differ + 1 + spare
        edges = (np.arange(1, parts, dtype=np.float64) / parts * 2.0**64).astype(np.uint64)
        cut = np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
        part = np.arange(parts, dtype=np.uint64)
        sig = _mixed(_mixed(sums[cut[1:]] - sums[cut[:-1]]) + part * _C[0] + np.uint64((k + 1) * int(_C[2]) % 2**64))
        sig = (sig & np.uint64(2**64 - 2)) | np.uint64(k & 1)
        empty = cut[1:] == cut[:-1]
        out.append(sig if empty.sum() > spare else sig[~empty])
        need[k & 1] = max(1, spare + 1 - int(empty.sum()))
    return np.concatenate(out), need


def _sets(batches, words):
    known = _hashes()
    for part in sliced(batches):
        for row in zip(*(part.column(j).to_pylist() for j in range(part.num_columns)), strict=True):
            yield (*row[:-1], shingles(row[-1], known, words))


def _described(words: int, similarity: tuple[int, int]):
    """Rows of a document (mark, n) and of its signatures (sig), with a key made of task and number."""

    def describe(batches):
        from pyspark import TaskContext

        key, bounds = TaskContext.get().partitionId() << 33, levels(similarity)
        names = ["key", "sig", "mark", "n", "need_even", "need_odd"]
        marks: list = []
        keys: list[int] = []
        facts: list[tuple[int, int, int]] = []
        sigs: list[np.ndarray] = []

        def rows():
            n, counts = len(marks), [len(s) for s in sigs]
            sig = np.concatenate(sigs) if sigs else np.zeros(0, dtype=np.uint64)
            per_sig = np.repeat(np.array(keys, dtype=np.int64), counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.nulls(n, pa.int64()), pa.array(marks, pa.binary()), *[pa.array([f[i] for f in facts], pa.int64()) for i in range(3)]], names=names)
            for i in range(0, len(sig), 200_000):
                part = sig[i : i + 200_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(per_sig[i : i + 200_000]), pa.array(part), pa.nulls(len(part), pa.binary()), *[pa.nulls(len(part), pa.int64())] * 3], names=names)

        for mark, h in _sets(batches, words):
            marks.append(mark)
            keys.append(key)
            sig, need = signatures(h, bounds, similarity) if len(h) else (h, [1, 1])
            facts.append((len(h), *need))
            sigs.append(sig)
            key += 1
            if len(marks) == 500:
                yield from rows()
                marks, keys, facts, sigs = [], [], [], []
        yield from rows()

    return describe


def _shared(batches):
    """Of rows (sig, key) in the order of sig, those whose sig is not alone."""
    sig, key, again = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False  # the last row, and whether its sig was met before

    def out(s, k):
        return pa.RecordBatch.from_arrays([pa.array(s), pa.array(k)], names=["sig", "key"])

    for batch in batches:
        s = np.concatenate([sig, batch.column(0).to_numpy()])
        k = np.concatenate([key, batch.column(1).to_numpy()])
        if not len(s):
            continue
        same = s[1:] == s[:-1]
        stays = np.concatenate([[again], same]) | np.concatenate([same, [False]])
        yield out(s[:-1][stays[:-1]], k[:-1][stays[:-1]])
        sig, key, again = s[-1:], k[-1:], bool(stays[-1])
    if again:
        yield out(sig, key)


def overlaps(rows: list[np.ndarray]) -> np.ndarray:
    """Product of the incidence matrix of the rows with its transpose: common n-grams of every two rows.

    Columns with a single row add nothing off the diagonal and are left out; the others are multiplied a
    block of columns at a time.
    """
    sizes = [len(r) for r in rows]
    value, column, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), sizes)
    use = count[column] > 1
    order = np.cumsum(count > 1) - 1
    row, column = row[use], order[column[use]]
    by_column = np.argsort(column, kind="stable")
    row, column = row[by_column], column[by_column]
    total = np.zeros((len(rows), len(rows)), dtype=np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, width, COLUMNS):
        i, j = np.searchsorted(column, [first, first + COLUMNS])
        block = np.zeros((len(rows), min(COLUMNS, width - first)), dtype=np.float32)
        block[row[i:j], column[i:j] - first] = 1
        total += block @ block.T
    return total


def _product(similarity: tuple[int, int]):
    num, den = similarity

    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        """Links among the rows of a pair of blocks, as stars; two visitors are not compared."""
        rows = [np.frombuffer(x, dtype=np.uint64) for x in pdf["h"]]
        n = np.array([len(x) for x in rows], dtype=np.int64)
        home, key = pdf["home"].to_numpy(), pdf["key"].to_numpy()
        both = overlaps(rows).astype(np.int64)
        linked = (den * both >= num * (n[:, None] + n[None] - both)) & (home[:, None] | home[None])
        np.fill_diagonal(linked, False)
        some = np.flatnonzero(linked.any(axis=1))
        linked, key = linked[np.ix_(some, some)], key[some]
        root = np.arange(len(some))
        while len(some):
            new = np.minimum(root, np.where(linked, root[None], len(some)).min(axis=1))
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"a": key, "b": key[root]})[key != key[root]].astype("int64")

    return multiply


def _odd() -> Column:
    """Whether a signature is of an odd level; signatures are signed, and the remainder of a negative one is -1."""
    return (F.col("sig") % 2 != 0).alias("odd")


def _need() -> Column:
    return F.when(_odd(), F.col("need_odd")).otherwise(F.col("need_even"))


def _often_enough(shared: DataFrame) -> DataFrame:
    """Without documents that share too few signatures of a level to be linked there, and signatures then alone."""
    rows = shared.withColumn("odd", _odd())
    enough = rows.groupBy("key", "odd").agg(F.count("*").alias("times"), F.max(_need()).alias("need")).filter("times >= need").select("key", "odd")
    rows = rows.join(enough, ["key", "odd"], "left_semi").drop("odd")
    return rows.join(rows.groupBy("sig").agg(F.count("*").alias("times")).filter("times > 1").select("sig"), "sig", "left_semi").select(*shared.columns)


def _cells(shared: DataFrame, scratch: Scratch) -> DataFrame:
    """``kind, cell, key, n, home``: who is to be compared where, from the shared signatures ``(sig, key, n)``."""
    first = shared.groupBy("sig").agg(F.min("key").alias("first"))
    often = shared.join(first, "sig").filter("key <> first").groupBy("key", "first").agg(F.count("*").alias("times")).filter("times > 1")
    member = components(often.select(F.col("key").alias("a"), F.col("first").alias("b")), scratch)
    placed = shared.join(member.select(F.col("node").alias("key"), F.col("component").alias("family")), "key", "left")
    placed = scratch.keep(placed.withColumn("family", F.coalesce("family", "key")))

    families = scratch.keep(placed.select("sig", "family").distinct())
    number = families.groupBy("sig").agg(F.count("*").alias("families")).filter("families > 1")
    few = families.join(number.filter(F.col("families") <= FAMILIES), "sig").groupBy("sig").agg(F.collect_list("family").alias("others"))
    guest = placed.join(few, "sig").select("key", "n", "sig", _need().alias("need"), "family", F.explode("others").alias("host")).filter("host < family")
    # a signature of a crowd is not counted here, but who shares one is compared in the crowd
    guest = guest.groupBy("host", "key", "n", _odd()).agg(F.count("*").alias("times"), F.max("need").alias("need"))
    guest = scratch.keep(guest.filter("times >= need").select("host", "key", "n").distinct())
    home = placed.select("family", "key", "n").distinct()
    open_ = home.groupBy("family").agg(F.count("*").alias("members")).join(guest.select(F.col("host").alias("family"), F.lit(True).alias("visited")).distinct(), "family", "left")
    home = home.join(open_.filter("members > 1 or visited").select("family"), "family", "left_semi")
    crowd = placed.join(number.filter(F.col("families") > FAMILIES).select("sig"), "sig", "left_semi")
    rows = lambda df, kind, cell, home: df.select(F.lit(kind).alias("kind"), F.col(cell).alias("cell"), "key", "n", F.lit(home).alias("home"))
    return rows(home, 0, "family", True).unionAll(rows(guest, 0, "host", False)).unionAll(rows(crowd, 1, "sig", True))


def _linked(cells: DataFrame, sets: DataFrame, similarity: tuple[int, int], scratch: Scratch) -> DataFrame:
    """Stars ``(a, b)`` of the links inside the cells; ``sets`` is ``(key, h)``.

    A cell of up to BLOCK rows and GRAMS n-grams is one block. In a larger one, rows are dealt to blocks
    by size and hash, and every two blocks meet whose sizes allow a link. A task holds one such pair.
    """
    num, den = similarity
    cells = scratch.keep(cells)
    step = math.log(SIZE_STEP)
    reach = int(math.log(den / num) / step) + 1
    cell = ["kind", "cell"]
    total = cells.groupBy(*cell).agg(F.count("*").alias("rows"), F.sum("n").alias("grams"))
    grade = F.when((F.col("rows") <= BLOCK) & (F.col("grams") <= GRAMS), F.lit(0)).otherwise(F.floor(F.log("n") / F.lit(step))).cast("int")
    graded = cells.join(total, cell).withColumn("grade", grade)
    grades = graded.groupBy(*cell, "grade").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / GRAMS)).cast("int").alias("blocks"))
    # at most as many grades as sizes have steps
    plan = grades.groupBy(*cell).agg(F.sort_array(F.collect_list(F.struct("grade", "blocks"))).alias("plan"))
    rows = graded.join(scratch.keep(plan), cell)
    own = F.element_at(F.filter("plan", lambda g: g["grade"] == F.col("grade")), 1)["blocks"]
    rows = rows.withColumn("b", F.pmod(F.xxhash64("key"), own).cast("long"))
    block = lambda g, b: g.cast("long") * (1 << 40) + b
    near = F.filter("plan", lambda g: F.abs(g["grade"] - F.col("grade")) <= reach)
    mates = F.flatten(F.transform(near, lambda g: F.transform(F.sequence(F.lit(0), g["blocks"] - 1), lambda b: block(g["grade"], b))))
    rows = rows.select(*cell, "key", "home", block(F.col("grade"), F.col("b")).alias("mine"), F.explode(mates).alias("mate"))
    rows = rows.select(*cell, F.least("mine", "mate").alias("x"), F.greatest("mine", "mate").alias("y"), "key", "home")
    rows = rows.join(sets, "key").select(*cell, "x", "y", "key", "home", "h")
    return rows.groupBy(*cell, "x", "y").applyInPandas(_product(similarity), "a long, b long")


def mark_of(text):
    """Equal for equal texts; texts are folded by it."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def group_documents(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, words: int = WORDS) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id, group``, one row per row of ``doc_id, text``.

    Words are runs of other than blanks, A-Z in lower case. Documents link when the Jaccard similarity
    of their sets reaches ``similarity``; ``component_id`` is the smallest doc_id reachable. Null, empty
    and blank texts have empty sets and link with nothing, each its own component (also among rows of
    one id). Rows that share an id but not the text are joined like any others by that id's smallest
    component; a null id is never the smallest beside others. ``mark`` is the MD5 of the text, and ``group``
    tells components apart also where ids are null.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shingles")
    marked = docs.select("doc_id", mark_of(F.col("text")).alias("mark"), "text")
    ids = scratch.keep(marked.select("doc_id", "mark"))

    # one text of each group of equal texts is looked at: the others' ids are told to the scan
    first = ids.groupBy("mark").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1 and first is not null")
    copies = scratch.keep(ids.join(first, "mark").filter("not doc_id <=> first").select(F.col("doc_id").alias("copy"), F.col("mark").alias("of")).distinct())
    if copies.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        copies = F.broadcast(copies)
    texts = marked.join(copies, F.col("doc_id").eqNullSafe(F.col("copy")) & (F.col("mark") == F.col("of")), "left_anti")
    rows = scratch.keep(texts.select("mark", "text").mapInArrow(_described(words, similarity), "key long, sig long, mark binary, n long, need_even long, need_odd long"))
    texts_ = rows.filter("mark is not null").groupBy("mark").agg(
        *[F.min("key").alias("key"), F.count("*").alias("looked_at")], *[F.max(c).alias(c) for c in ("n", "need_even", "need_odd")]
    )
    texts_ = scratch.keep(texts_)

    by_sig = rows.filter("sig is not null").select("sig", "key").repartition("sig").sortWithinPartitions("sig")
    shared = scratch.keep(by_sig.mapInArrow(_shared, "sig long, key long"))
    # rows of a text that was looked at twice (repeated rows, null ids) stand for its first key
    shared = scratch.keep(shared.join(texts_.select("key", "n", "need_even", "need_odd"), "key").distinct())
    scratch.drop(rows)
    shared = scratch.keep(_often_enough(_often_enough(shared)))

    wanted = scratch.keep(shared.select("key").distinct().join(texts_, "key").select("mark", "key", (F.col("looked_at") > 1).alias("twice")))
    again = with_small(texts.select("mark", "text"), wanted, ["mark"]).filter("key is not null")
    if not wanted.filter("twice").isEmpty():
        again = again.filter("not twice").unionAll(again.filter("twice").dropDuplicates(["key"]))
    again = again.select("key", "text")

    def rows_of(batches):
        known = _hashes()
        for batch in sliced(batches):
            both = [(k, shingles(t, known, words).tobytes()) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in both], pa.int64()), pa.array([x[1] for x in both], pa.binary())], names=["key", "h"])

    sets = scratch.keep(again.mapInArrow(rows_of, "key long, h binary"))

    edges = scratch.keep(_linked(_cells(shared, scratch), sets, similarity, scratch))
    scratch.drop(sets)
    member = scratch.keep(components(edges, scratch))

    by_text = texts_.join(member.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    all_ids = scratch.keep(ids.join(by_text.select("mark", "n", "component"), "mark"))
    smallest = all_ids.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    out = all_ids.join(smallest, "component", "left")
    component = F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "mark", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("component").alias("group"))


def one_of_each_group(docs: DataFrame, similarity: tuple[int, int], words: int) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest id, then MD5, stays.

    Of equal rows one stays. Documents without words are no group and all stay. What goes is told to the
    scan of the documents, so texts are not moved unless very many go.
    """
    scratch = Scratch(docs.sparkSession, "groups")
    rows = scratch.keep(group_documents(docs, similarity, words).filter("n_shingles > 0"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    by_row = rows.groupBy("group", "doc_id", "mark").agg(F.count("*").alias("copies"))
    stays = by_row.groupBy("group").agg(best.alias("best")).select("group", F.col("best.doc_id").alias("id"), F.col("best.mark").alias("of"))
    is_best = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("of"))
    odd = by_row.join(stays, "group").withColumn("is_best", is_best).filter("not is_best or copies > 1")
    # ids may be null, and joins on them must not lose rows
    odd = scratch.keep(odd.groupBy(F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"), F.col("mark").alias("__mark")).agg(F.max("is_best").alias("__best")))
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__none": F.col("doc_id").isNull(), "__mark": mark_of(F.col("text"))})
    told = with_small(keyed, odd, ["__id", "__none", "__mark"])
    if odd.filter("__best").isEmpty():
        return told.filter("__best is null").select(*docs.columns)
    again = told.filter("__best").dropDuplicates(["__id", "__none", "__mark"])
    return told.filter("__best is null").unionByName(again).select(*docs.columns)


SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), gram AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM word
), size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id
), overlap AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
  SELECT a, b FROM overlap JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)
), reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM documents d JOIN reach ON a = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query(SQL)
def op5_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_documents(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
