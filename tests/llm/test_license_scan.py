"""License scan against brute force: phrases, and blocks of words that hold a template."""

import random
import re

import pytest

from corpuslens.llm.license_scan import LEAST_STEP, PHRASES, SHARE, TEMPLATES, op13_license_blocks, scan_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EXTRA = "doc_id long, text string, labels string, score int, uid long, blocks int"


def brute(rows, phrases=PHRASES, templates=TEMPLATES, share=SHARE):
    out = []
    for doc, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        at, base = [], set()
        for label, phrase in phrases:
            p = phrase.lower().split()
            here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            at += here
            base |= {label} if here else set()
        labels, score = set(base), 0.0
        for label, template in templates:
            sequence = re.findall("[0-9a-z]+", template.lower())
            of, step = set(sequence), LEAST_STEP
            while step < len(sequence):
                step *= 2
            need = max(1, -(-len(of) * share[0] // share[1]))
            for b in range(max(1, -(-len(words) // step) - 1)):
                held = len(of & set(words[b * step : b * step + 2 * step]))
                if held >= need:
                    labels.add(label)
                    score = max(score, held / len(of))
        out.append((doc, len(words), len(at), min(at, default=None), max(at, default=None), sorted(base), sorted(labels), score))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, "x", 1, 2, 3) for d, t in rows], EXTRA)
    return sorted((tuple(r)[:8] for r in scan_licenses(df, **options).collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    pool = "the of and to use free code a this is new way some all by cc version 2 0".split()
    rows = []
    for i in range(n):
        words = [rng.choice(pool) if rng.random() < 0.5 else f"w{rng.randrange(50)}" for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            _, text = rng.choice(TEMPLATES + PHRASES)
            new = text.split()
            for _ in range(rng.randrange(3)):  # some words lost or strewn in
                k = rng.randrange(len(new))
                new[k : k + rng.randrange(2)] = rng.choice([[], ["XX"], ["xé", "y"]])
                new = new or ["x"]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() if rng.random() < 0.3 else w for w in new]
        rows.append((i, rng.choice([" ", "\n", ", ", " -- "]).join(words)))
    return rows


@pytest.mark.parametrize("share", [SHARE, (1, 2), (1, 1), (1, 100)])
def test_against_brute_force(spark, share):
    rows = corpus(share[0] * 100 + share[1])
    assert run(spark, rows, share=share) == brute(rows, share=share)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in op13_license_blocks(spark, folder).collect()), key=str)
    want = sorted([(*r[:5], ",".join(r[5]), ",".join(r[6]), r[7]) for r in brute(rows)], key=str)
    assert got == want and any(r[6] != r[5] for r in got)


def test_odd_texts(spark):
    notice = "Released under the MIT License"
    rows = [
        (1, None), (2, ""), (3, " .\n"), (None, notice), (4, notice), (4, notice), (4, "CC BY CC BY, cc-by; Cc bY"), (5, "cK by K"), (6, "xcc by cc byx ccé by"),
        (7, "İ All\x00Rights\x7freserved"), (8, ("word " * 40_000) + notice + (" cc by" * 20_000)), (9, "all rights reserved" * 2), (10, "all " * 9 + "rights reserved"), (11, "by"), (12, "general public license, general public"),
    ]
    assert run(spark, rows) == brute(rows)


def test_no_rows_phrases_or_templates(spark):
    rows = [(1, "cc by released under the mit license"), (2, None)]
    assert run(spark, []) == []
    assert run(spark, rows, phrases=()) == brute(rows, phrases=())
    assert run(spark, rows, templates=()) == brute(rows, templates=())


def test_blocks_say_where(spark):
    text = "x " * 100 + TEMPLATES[0][1]
    row = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert {(b.template, b.label, b.containment) for b in row.blocks} == {(0, "mit", 1.0)}
    assert all(b.start <= 100 and 105 <= b.start + b.width for b in row.blocks)


def test_templates_must_be_ascii_and_have_words(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for bad in ("é", "--"):
        with pytest.raises(ValueError, match="words"):
            scan_licenses(docs, templates=(("x", bad),))
