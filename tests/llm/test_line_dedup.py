"""Shared lines against brute force, with ranges cut inside a line's occurrences."""

import random
from collections import defaultdict

import pytest

from corpuslens.llm.common import Scratch
from corpuslens.llm.line_dedup import OPEN, drop_shared_lines, keep_bitmaps, line_hashes, streamed_ranges

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, kept int, h string"


def brute(rows, min_docs, min_chars):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add((doc, text or ""))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stays = [x for x in lines if len(key(x)) < min_chars or len(docs[key(x)]) < min_docs]
        out.append((doc, "\n".join(stays), len(lines), len(lines) - len(stays)))
    return sorted(out, key=str)


def run(spark, rows, min_docs, min_chars):
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA)
    # a column called like one of the results is replaced
    return sorted(((r["doc_id"], r["kept"], r["n_lines"], r["n_dropped"]) for r in drop_shared_lines(df, min_docs, min_chars).collect()), key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    pool = ["", " ", "Shared", " shared\t", "SHARED", "é", "É", "x", "a" * 5000, "two words", "\x1cz", "rare"] + [f"l{i}" for i in range(30)]
    weights = [5, 2, 9, 3, 3, 4, 4, 6, 1, 5, 2, 1] + [1] * 30
    rows = [(i, "\n".join(rng.choices(pool, weights)[0] if rng.random() < 0.6 else f"own {i} {k}" for k in range(rng.randrange(1, 40)))) for i in range(n)]
    return rows + [(500, None), (501, ""), (502, "\n" * 50), (503, "shared"), (503, "shared\nother"), (None, "shared\nx"), (None, "x"), (504, "shared\n" * 3000), (505, "shared\r\nx\r\n"), (1, rows[1][1])]


@pytest.mark.parametrize(("parts", "min_docs", "min_chars"), [("1", 10, 1), ("4", 10, 1), ("60", 10, 1), ("13", 3, 3), ("5", 1, 1), ("5", 10, 0)])
def test_against_brute_force(spark, parts, min_docs, min_chars):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = corpus(int(parts))
        assert run(spark, rows, min_docs, min_chars) == brute(rows, min_docs, min_chars)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_documents_and_nothing_shared(spark):
    assert run(spark, [], 10, 1) == []
    rows = [(i, f"own {i}\n\n") for i in range(30)]
    assert run(spark, rows, 10, 1) == brute(rows, 10, 1)
    assert keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_open_lines_are_few(spark):
    """Whatever the number of lines, a range leaves open only lines of fewer documents than the bound, at its two ends."""
    rows = [(i, "shared\nmore\n" + f"own {i}") for i in range(2000)]
    out = Scratch(spark, "test-lines").keep(streamed_ranges(line_hashes(spark.createDataFrame(rows, "doc_id long, text string"), 1), 10))
    ranges = out.select("part").distinct().count()
    assert out.filter(out.n == OPEN).count() <= 2 * 9 * ranges
