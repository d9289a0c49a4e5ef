"""Document groups against brute force over all pairs."""

import random
import re

import pytest

from corpuslens.llm import shingle_join
from corpuslens.llm.shingle_join import _hashes, group_documents, levels, shingles, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, k=3):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, num=90, den=100):
    sets = [grams(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return sorted(((d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1, b"x") for d, t in rows], "doc_id long, text string, component_id int, mark binary")
    return sorted(map(tuple, group_documents(df, **options).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def corpus(seed, groups, words, edits):
    rng = random.Random(seed)
    rows, n = [], 0
    shared = [f"p{i}" for i in range(60)]
    for _ in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice(words))]
        if rng.random() < 0.4:
            base[len(base) // 2 : len(base) // 2] = shared
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                w = w[: -max(1, len(w) // 40)] or w
            rows.append((n, rng.choice([" ", "\n", "\t "]).join(w).title() if rng.random() < 0.3 else " ".join(w)))
            n += 1
    return rows


@pytest.mark.parametrize(("seed", "words", "edits"), [(1, [1, 2, 3, 4, 9, 10, 11, 12, 18, 19, 20, 21], 2), (2, [30, 90, 200], 5), (3, [400, 700], 14)])
def test_random_groups(spark, seed, words, edits):
    rows = corpus(seed, 40, words, edits)
    assert run(spark, rows) == brute(rows)


def test_large_cells(spark, monkeypatch):
    """One large family, cells of many blocks, signatures shared by many families."""
    monkeypatch.setattr(shingle_join, "BLOCK", 8)
    monkeypatch.setattr(shingle_join, "FAMILIES", 2)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w[rng.randrange(3) * 4 :])))
    rows += [(i + 1000, t) for i, t in corpus(6, 25, [15, 25, 60], 4)]
    assert run(spark, rows) == brute(rows)


def test_other_similarity(spark):
    rows = corpus(4, 30, [20, 60, 150], 8)
    assert run(spark, rows, similarity=(8, 10)) == brute(rows, 8, 10)


@pytest.mark.parametrize(("similarity", "words"), [((90, 100), 3), ((80, 100), 5)])
def test_short_copies_with_trimmed_ends(spark, similarity, words):
    """Copies of adjacent size levels, many of them in other families, share just the signatures needed."""
    rng = random.Random(11)
    texts = []
    for _ in range(450):
        base = [f"w{rng.randrange(10**7)}" for _ in range(rng.randrange(27, 31))]
        for _ in range(4):
            w = base[rng.randrange(3) : len(base) - rng.randrange(3)]
            if rng.random() < 0.3:
                w[rng.choice([0, -1])] = f"e{rng.randrange(10**7)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    sets = [grams(t, words) for t in texts]
    holders = {}
    for i, x in enumerate(sets):
        for g in x:
            holders.setdefault(g, []).append(i)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    num, den = similarity
    for i, x in enumerate(sets):
        for j in {j for g in x for j in holders[g] if j < i}:
            if den * len(x & sets[j]) >= num * len(x | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    assert run(spark, rows, similarity=similarity, words=words) == sorted(((i, len(x), root(i)) for i, x in enumerate(sets)), key=str)


def test_odd_texts(spark):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [
        (5, None), (3, ""), (4, " \n\x0b"), (9, "One"), (8, "one"), (7, "one two"), (6, "ONE  two"), (1, "É a b"), (2, "é a b"), (10, "a\x1cb c d"), (11, "a b c d"),
        (12, long), (13, long + " x"), (14, long[:-1]), (15, "a b a b a b a b"), (16, "a b a b a b"), (None, "one"), (None, long), (9, "one"), (9, "other words here"), (None, None),
    ]
    assert run(spark, rows) == brute(rows)


def test_no_documents(spark):
    assert run(spark, []) == []


def test_chain_of_near_copies(spark):
    """Neighbours link, ends do not: one component all the same."""
    w = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        rows.append((100 - i, " ".join(w)))
        w[i * 6] = f"new{i}"
    assert {r[2] for r in run(spark, rows)} == {71}


def test_linked_sets_share_a_signature():
    bounds, known = levels((90, 100)), _hashes()
    rng = random.Random(9)
    for _ in range(300):
        n = rng.choice([5, 12, 40, 300, 1000])
        a = [f"w{rng.randrange(10**7)}" for _ in range(n)]
        b = list(a)
        for _ in range(rng.randrange(1 + n // 60)):
            b[rng.randrange(n)] = "z"
        x, y = shingles(" ".join(a), known), shingles(" ".join(b), known)
        both = len(set(x.tolist()) & set(y.tolist()))
        if 100 * both >= 90 * (len(x) + len(y) - both):
            (p, need), (q, other) = signatures(x, bounds, (90, 100)), signatures(y, bounds, (90, 100))
            common = set(p.tolist()) & set(q.tolist())
            assert any(sum(s % 2 == odd for s in common) >= max(need[odd], other[odd]) for odd in (0, 1))
