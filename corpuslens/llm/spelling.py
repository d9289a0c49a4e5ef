"""Spelling variants: words of the corpus that one edit makes of each other, pointed to the most frequent form.

Two words are near if one code point inserted, deleted or replaced makes one of the other. Words are dealt
out so that near ones meet in small groups: a pair whose shorter word has ``c`` code points differs either
behind the first ``c // 2`` of them or before the rest, so it shares that prefix or that suffix. A group
beyond a limit is split again, by halves of the part that is still open, until none is left beyond it.
Inside a group the sorted list is scanned once for every word: the rows of the edit matrix, three cells
wide, are kept as far as the next word shares its prefix with the one before, and as soon as no cell of a
row is below two, all words with that prefix are skipped.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read, with_small
from corpuslens.llm.registry import query

LETTERS = "A-Za-zÀ-ÿ"
#: Of the words of a document, one of so many loses a code point (see ``damaged``).
DAMAGE = 199
MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
#: Words of a group; larger ones are split.
GROUP = 256
#: A task passes on its counts when its words take about so many bytes.
COUNT_BYTES = 16 << 20


def damaged(word: str, crc: int, share: int) -> str:
    """The word, without its code point ``crc % length`` if ``share`` divides the checksum."""
    if crc % share:
        return word
    i = crc % len(word)
    return word[:i] + word[i + 1 :]


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, damage: int | None = None) -> DataFrame:
    """``word, n`` of all runs of letters, A-Z in lower case, of ``min_chars`` code points or more.

    ``damage`` deletes a code point of one in so many pairs of document and word, chosen by the CRC-32
    of ``<doc_id>:<word>`` (a null id is written as nothing), before lengths are taken.
    """
    run = re.compile(f"[{LETTERS}]+")

    def counted(batches):
        total: Counter[str] = Counter()
        size = 0

        def flushed():
            nonlocal size
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            size = 0
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                # of UTF-8 bytes, only A-Z are lowered
                words = Counter(run.findall(text.encode().lower().decode()))
                if damage:
                    start = zlib.crc32(f"{'' if (d := doc.as_py()) is None else d}:".encode())
                    for word in list(words):
                        crc = zlib.crc32(word.encode(), start)
                        if crc % damage == 0:
                            # another word of this document may become the same, or be deleted itself: counts add up below
                            total[damaged(word, crc, damage)] += words.pop(word)
                before = len(total)
                total.update(words)
                size += (len(total) - before) * 100 + sum(len(w) for w in words if len(w) > 100)
                if size >= COUNT_BYTES:
                    yield flushed()
        yield flushed()

    rows = docs.select("doc_id", "text").mapInArrow(counted, "word string, n long")
    return rows.filter(F.length("word") >= min_chars).groupBy("word").agg(F.sum("n").alias("n"))


GROUPED = "key binary, word string, n long, c int, a int, b int, below int"


def _key(df: DataFrame) -> DataFrame:
    """Group of a word: class, shared prefix and suffix; 128 bits of them."""
    rest = F.concat_ws("\x00", F.col("c"), F.col("a"), F.col("b"), F.expr("left(word, a)"), F.expr("if(b > 0, right(word, b), '')"))
    return df.withColumn("key", F.unhex(F.md5(rest))).select(*[x.split()[0] for x in GROUPED.split(", ")])


def _halves(df: DataFrame) -> DataFrame:
    """Each row twice: the open part behind ``a`` and before the last ``b`` code points of the class is halved.

    A pair that differs behind the first half goes on in the first child; one that differs inside it, in
    the second, which therefore takes pairs with a common prefix ``below`` the cut only.
    """
    half = F.floor((F.col("c") - F.col("a") - F.col("b")) / 2).cast("int")
    first = F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b"), F.col("below").alias("below"))
    second = F.struct(F.col("a").alias("a"), (F.col("c") - F.col("a") - half).alias("b"), (F.col("a") + half).alias("below"))
    return _key(df.withColumn("to", F.explode(F.array(first, second))).select("word", "n", "c", "to.a", "to.b", "to.below"))


def grouped(words: DataFrame, scratch: Scratch, limit: int = GROUP) -> DataFrame:
    """The words in groups (see GROUPED), none of more than ``limit`` words that can still be split.

    Class ``c`` holds words of ``c`` and ``c + 1`` code points. An open part of one code point can't be
    split; such a group has no more words than the letters make of one or two places.
    """
    size = F.length("word")
    least = words.agg(F.min(size)).first()[0] or 1
    classes = F.explode(F.array(size, size - 1)).alias("c")
    rows = words.select("word", "n", classes).filter(F.col("c") >= least).withColumns({"a": F.lit(0), "b": F.lit(0), "below": F.col("c") + 2})
    done, rows = None, scratch.keep(_halves(rows))
    while True:
        large = rows.filter("c - a - b >= 2").groupBy("key").count().filter(F.col("count") > limit).select("key", F.lit(True).alias("large"))
        large = scratch.keep(large)
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        marked = with_small(rows, large, ["key"])
        small = marked.filter("large is null").drop("large")
        done = small if done is None else done.unionByName(small)
        rows = scratch.keep(_halves(marked.filter("large").drop("large")))


def common_prefix(x: str, y: str) -> int:
    n = 0
    for a, b in zip(x, y):
        if a != b:
            break
        n += 1
    return n


def near_words(words: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Places ``i < j`` in a sorted list of distinct words of the pairs that are one edit apart."""
    n = len(words)
    lcp = [0] + [common_prefix(words[j - 1], words[j]) for j in range(1, n)]
    for i in range(n - 1):
        q = words[i]
        m = len(q)
        # row d: distances of the first d code points of a word to the first d - 1, d and d + 1 of q
        rows = [(2, 0, 1)] + [(1, 0, 1)] * m
        j, known = i + 1, lcp[i + 1]
        while j < n:
            w = words[j]
            end = min(len(w), m + 1)
            del rows[known + 1 :]
            x, y, z = rows[known]
            dead = 0
            for d in range(known + 1, end + 1):
                ch = w[d - 1]
                left = min(x + (d < 2 or ch != q[d - 2]), y + 1)
                y = min(y + (ch != q[d - 1]), z + 1, left + 1) if d <= m else 2
                z = min(z + (ch != q[d]), y + 1) if d < m else 2
                x = left
                if x > 1 and y > 1 and z > 1:
                    dead = d
                    break
                rows.append((x, y, z))
            if not dead and len(w) > end:
                dead = end + 1  # longer than q by two or more, with all that share so much
            if not dead and (x, y, z)[m - len(w) + 1 if -1 <= m - len(w) <= 1 else 0] == 1 and -1 <= m - len(w) <= 1:
                yield i, j
            j += 1
            if dead:
                while j < n and lcp[j] >= dead:
                    known = min(known, lcp[j])
                    j += 1
            if j < n:
                known = min(lcp[j], len(rows) - 1)


LINK = "word string, n long, near string, near_n long"


def near_pairs(groups: DataFrame) -> DataFrame:
    """Every pair of near words once, as LINK; a task holds one group at a time."""

    def scanned(batches):
        out: list[tuple] = []

        def scan(group):
            group.sort()
            words = [g[0] for g in group]
            c, a, below = group[0][2:]
            if all(len(w) > c for w in words):
                return
            for i, j in near_words(words):
                u, v = group[i], group[j]
                if len(u[0]) > c and len(v[0]) > c:
                    continue  # both of the next class
                if a <= common_prefix(u[0], v[0]) < below:
                    out.append((u[0], u[1], v[0], v[1]))

        def flushed():
            cols = list(zip(*out, strict=True)) or [()] * 4
            batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, [pa.string(), pa.int64()] * 2, strict=True)], names=["word", "n", "near", "near_n"])
            out.clear()
            return batch

        now, group = None, []
        for batch in batches:
            for key, *row in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 6)), strict=True):
                if key != now:
                    if len(group) > 1:
                        scan(group)
                    now, group = key, []
                    if len(out) > 20_000:
                        yield flushed()
                group.append(row)
        if len(group) > 1:
            scan(group)
        yield flushed()

    return groups.repartition("key").sortWithinPartitions("key").mapInArrow(scanned, LINK)


def follow(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` from ``word, form``: the last word that the forms lead to, by pointer jumping.

    Forms must not lead in circles; here each is more frequent than its word.
    """
    to = scratch.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = scratch.keep(to.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if jumped.filter("moved").isEmpty():
            return jumped.select("word", "root")
        to = jumped.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO, limit: int = GROUP) -> DataFrame:
    """One row per word of ``words (word, n)``, which are distinct: ``word, form, root, n, n_near, form_n``.

    ``n_near`` counts the near words; ``form`` is the most frequent of them (the first in code-point
    order among equals) if its ``n`` is at least ``ratio`` times the word's, with ``form_n`` its count,
    else both are null. ``root`` follows forms to the last, the word itself without any. Null and empty
    words are left out. ``ratio`` is above 1.
    """
    if ratio <= 1:
        raise ValueError("the ratio must be above 1, or forms could lead in circles")
    scratch = Scratch(words.sparkSession, "spelling")
    words = scratch.keep(words.filter("word <> ''").select("word", F.col("n").cast("long").alias("n")))
    links = scratch.keep(near_pairs(grouped(words, scratch, limit)))
    swapped = links.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = links.unionByName(swapped).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    fits = -F.col("best.n") >= ratio * F.col("n")
    table = words.join(best, "word", "left").select(
        "word", F.when(fits, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, -F.col("best.n")).alias("form_n")
    )
    table = scratch.keep(table)
    roots = follow(table.filter("form is not null"), scratch)
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(read(spark, sf_dir, "documents"), MIN_CHARS, DAMAGE)
    return spelling_variants(counts.filter(F.col("n") >= MIN_COUNT))
