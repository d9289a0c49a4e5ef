"""Mixing: targets by iteration, exact budgets, the same rows every time."""

import random
import re
from collections import Counter, defaultdict

import pytest

from corpuslens.llm.mixing import mix, repeated, sampling_key, source_targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, source string, text string, size string, target int"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """By giving the excess away again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = budget - sum(most * sizes[s] for s in full)
        t = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if t[s] > most * sizes[s]}
        if not over:
            return t | {s: most * sizes[s] for s in full}
        full |= over


def test_targets(spark):
    rng = random.Random(0)
    for n in (1, 2, 3, 8, 30):
        sizes = {(f"s{i:02}" if i else None): rng.choice([0, 1, 5, 50, 4000]) for i in range(n)}
        df = spark.createDataFrame([((s is None, s or ""), x) for s, x in sizes.items()], "source_key struct<none: boolean, name: string>, source_size long")
        got = {None if r.source_key.none else r.source_key.name: r.target for r in source_targets(df).collect()}
        assert got == pytest.approx(targets(sizes))


def corpus():
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "é", None]), " ".join("w" * rng.randrange(1, 9) for _ in range(rng.choice([0, 3, 30, 200]))), "x", 1) for i in range(400)]
    return rows + [(1000, "a", None, "x", 1), (1001, "z", "", "x", 1), (None, "a", "x y", "x", 1), (None, "a", "x y", "x", 1), (3, "b", "x %%% $$$", "x", 1), (2000, "b", "long " * 5000, "x", 1)]


def test_budgets(spark):
    rows = corpus()
    out = mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, s, t, *_ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want, taken = targets(sizes), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.epochs * r.size + r.part
        assert r.epochs == (r.target // r.source_size if r.source_size else 0)
        taken[r.source] += r.taken
    assert all(want[s] - 1.001 <= taken[s] <= want[s] + 0.001 for s in sizes)
    again = mix(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_documents_are_repeated(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    copies = Counter(tuple(r) for r in repeated(df).collect())
    assert set(copies) <= set(rows)
    words = lambda r: len(WORD.findall(r[2] or ""))
    mixed = mix(df).collect()
    for s in {r[1] for r in rows}:
        got, want = sum(n * words(r) for r, n in copies.items() if r[1] == s), sum(x.taken for x in mixed if x.source == s)
        assert abs(got - want) <= max(words(r) for r in rows if r[1] == s)


def test_plain_text_comes_first(spark):
    rows = [(i, "a" if i % 2 else "b", ("word " * 10 if i % 4 < 2 else "w%%% " * 10), "x", 1) for i in range(4000)]
    out = mix(spark.createDataFrame(rows, SCHEMA), share=(1, 2), most=1).collect()
    picked = [r.doc_id % 4 < 2 for r in out if r.taken and r.source == "b"]  # a quarter of this source is taken
    assert 450 < len(picked) < 550 and sum(picked) > 0.9 * len(picked)


def test_keys_are_exponential(spark):
    from pyspark.sql import functions as F

    keys = [r.k for r in spark.range(20_000).select(sampling_key(F.col("id"), F.lit(2.0)).alias("k")).collect()]
    assert abs(sum(keys) / len(keys) - 0.5) < 0.02 and min(keys) >= 0


def test_nothing(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert repeated(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in mix(spark.createDataFrame([(1, "a", None, "x", 1)], SCHEMA)).collect()] == [0]
