"""Spelling variants against brute force: counts with deleted code points, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuslens.llm.common import Scratch
from corpuslens.llm.spelling import grouped, near_words, op12_spelling_variants, spelling_variants, word_counts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, min_chars, damage):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if damage and h % damage == 0:
                i = h % len(word)
                word = word[:i] + word[i + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    # words that are one edit apart agree in one of their halves or, with one code point deleted, in a string
    by_part = {}
    for w in counts:
        for part in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_part.setdefault(part, []).append(w)
    near = {w: set() for w in counts}
    for words in by_part.values():
        for a in words:
            near[a].update(b for b in words if a != b and is_near(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def lists():
    rng = random.Random(5)
    for letters in ("ab", "abc", "abcdefghéÿ"):
        for _ in range(150):
            yield sorted({"".join(rng.choices(letters, k=rng.randint(1, 8))) for _ in range(rng.randint(1, 60))})


def test_scan_of_a_sorted_list():
    for words in lists():
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if is_near(words[i], words[j])]
        assert sorted(near_words(words)) == pairs


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    counts = {w: n for w, n in brute_counts(rows, 6, 199).items() if n >= 5}
    got = as_rows(op12_spelling_variants(spark, folder))
    assert got == brute_variants(counts)
    assert sum(r[1] is not None for r in got) > 20


def test_odd_rows(spark):
    long = "q" * 70_000
    rows = [
        (1, None), (2, ""), (3, " \n12 _"), (None, "Straße straße STRAßE Étés étés ×÷×÷"), (4, f"{long} {long}b"), (4, "dog's co-op a1b"),
        (5, "abcdef " * 9 + "abcdeg abcde abcdeff"), (5, "abcdef " * 9 + "abcdeg abcde abcdeff"), (6, "Ābcdẞ naïve 한글x"),
    ]
    df = spark.createDataFrame([(d, t, "n", 3) for d, t in rows], "doc_id long, text string, word string, n int")
    for damage in (None, 3):
        counts = brute_counts(rows, 1, damage)
        got = word_counts(df, 1, damage)
        assert {r.word: r.n for r in got.collect()} == counts
        assert as_rows(spelling_variants(got)) == brute_variants(counts)


@pytest.mark.parametrize("letters", ["ab", "abcde"])
def test_large_groups_are_split(spark, letters):
    rng = random.Random(len(letters))
    counts = {"same" * 2 + "".join(rng.choices(letters, k=rng.randint(3, 7))): rng.choice([5, 5, 6, 30, 150, 800]) for _ in range(400)}
    counts |= {"".join(rng.choices(letters, k=rng.randint(3, 7))) + "tail" * 2: rng.choice([5, 30, 30]) for _ in range(200)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert as_rows(spelling_variants(df, limit=8)) == brute_variants(counts)
    assert as_rows(spelling_variants(df.withColumn("root", F.lit(1)), limit=10**6)) == brute_variants(counts)
    groups = grouped(df, Scratch(spark, "test"), 8)
    sizes = groups.groupBy("key", "c", "a", "b").count().filter("c - a - b >= 2").agg(F.max("count")).first()[0]
    assert sizes <= 8


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert as_rows(spelling_variants(word_counts(docs))) == []
    words = spark.createDataFrame([(None, 7), ("", 8), ("alone", 9)], "word string, n int")
    assert as_rows(spelling_variants(words)) == [("alone", None, "alone", 9, 0, None)]


def test_circles_are_refused(spark):
    with pytest.raises(ValueError, match="circles"):
        spelling_variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)
