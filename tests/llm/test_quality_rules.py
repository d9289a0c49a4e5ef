"""Quality rules against a brute-force version."""

import math
import re
import struct
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from corpuslens.llm.quality_rules import BUCKETS, DEVIATIONS, HELD_OUT, LEAST_GAP, SMOOTHING, held_out, judge_quality, op7_likelihood_ratio

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def grams(words, buckets):
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in words]
    pairs = [xxhash.xxh64_intdigest(struct.pack("<Q", y), seed=xxhash.xxh64_intdigest(struct.pack("<Q", x), seed=42)) for x, y in zip(h, h[1:])]
    return [signed(x) % buckets for x in h + pairs]


def forms(text):
    for kind, sign in ((r"[\p{Ll}\p{Lo}\p{Lm}\p{M}]+", "a"), (r"[\p{Lu}\p{Lt}]+", "A"), (r"\p{N}+", "0"), (r"([^aA0 \t-\r])\1+", r"\1")):
        text = regex.sub(kind, sign, text)
    return WORD.findall(text)


def is_held_out(doc):
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", doc), seed=42)) % HELD_OUT == 0


def brute(rows, trusted, buckets=BUCKETS, threshold=None):
    words = [WORD.findall(t or "") for _, t in rows]
    g = [grams(forms(t or ""), buckets) for _, t in rows]
    raw, target = Counter(), Counter()
    for (doc, _), x in zip(rows, g):
        raw.update(x)
        if doc in trusted and not is_held_out(doc):
            target.update(x)
    part = sum(target.values()) / max(1, sum(raw.values()))
    weight = lambda b: math.log((target[b] + SMOOTHING) / (raw[b] * part + SMOOTHING))
    out = []
    for (doc, text), w, x in zip(rows, words, g):
        text = text or ""
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        hit = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        score = sum(map(weight, x)) / len(x) if x else None
        out.append([doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed, score])
    if threshold is None:
        held = [r[-1] for r in out if r[0] in trusted and is_held_out(r[0]) and not r[6]]
        mean = sum(held) / len(held) if held else 0.0
        spread = math.sqrt(sum((x - mean) ** 2 for x in held) / len(held)) if held else 0.0
        threshold = mean - max(DEVIATIONS * spread, LEAST_GAP)
    return [(*r[:7], not r[6] and r[7] >= threshold) for r in out]


def key(row):
    return tuple((x is None, x) for x in row)


def check(spark, rows, trusted, **options):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, kept string, n_words int")
    ids = spark.createDataFrame([(x,) for x in [*trusted, *trusted, None]], "doc_id long")
    got = judge_quality(docs, ids, **options).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, set(trusted), **options), key=key)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    trusted = [r[0] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").select("doc_id").collect()]
    check(spark, rows, trusted)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    plain = " ".join(f"a{i}" for i in range(30))
    rows = [
        (1, None), (2, ""), (3, " \n\t\x0b\x0c\r"), (4, plain), (4, plain), (5, plain + "\n" + plain), (None, "x " * 40), (6, long),
        (7, "é " * 19 + "z"), (8, "a\n a\na \n\na\n a"), (9, "   b " * 12), (10, "#*$%&|<> " * 21), (4, "other text"),
    ]
    check(spark, rows, [4, 6], buckets=1024, threshold=-0.1)


def test_empty_tables(spark):
    check(spark, [], [])
    check(spark, [(1, "a b c " * 10)], [])


def test_trusted_text_outranks_junk(spark):
    clean = [(i, " ".join(f"w{(i * 7 + k * k) % 97}" for k in range(40))) for i in range(60)]
    junk = [(100 + i, " ".join(f"w{(i * 7 + k * k) % 97}%%%" for k in range(40))) for i in range(30)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id long")
    kept = {r.doc_id for r in judge_quality(docs, ids, buckets=4096).filter("kept").collect()}
    assert kept == {i for i, _ in clean}


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_verdicts_hold_at_every_size(spark, sf):
    """Good documents that the counts did not see stay, bad ones go, among those that pass the base rules."""
    folder = f"/root/testdata/sf{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = op7_likelihood_ratio(spark, folder).filter("not base_failed").join(labels, "doc_id")
    unseen = judged.filter("quality = 1").filter(held_out(F.col("doc_id")))
    n, kept = unseen.agg(F.count("*"), F.count_if("kept")).first()
    assert n >= 5 and kept >= 0.9 * n
    n, kept = judged.filter("quality = 0").agg(F.count("*"), F.count_if("kept")).first()
    assert n >= 5 and kept <= 0.1 * n
