"""Vector links against brute force, with many small cells and blocks."""

import numpy as np
import pytest

from corpuslens.llm import vector_dedup
from corpuslens.llm.vector_dedup import link_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, component_id string"


def brute(rows, s=0.98):
    rows = [r[:3] for r in rows]
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    v = [np.array(r[1], dtype=np.float32).astype(float) if k else None for r, k in zip(rows, ok)]
    links = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(v[i]) == len(v[j]):
                if v[i] @ v[j] / (np.linalg.norm(v[i]) * np.linalg.norm(v[j])) >= s:
                    links[i].append(j)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((r[0], len(links[i]), c, r[0] == c))
    return sorted(out, key=str)


def run(spark, rows):
    return sorted(map(tuple, link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)


@pytest.mark.parametrize(("cell", "block"), [(4096, 2048), (20, 2048), (60, 16)])
def test_random_groups(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vector_dedup, "CELL", cell)
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for g in range(60):
        base = rng.normal(size=12)
        for _ in range(rng.integers(1, 9)):
            rows.append((n, (base + rng.normal(size=12) * rng.choice([0, 0.02, 0.06, 0.12])).astype("f4").tolist(), int(g % 3), "x"))
            n += 1
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "a"), (2, [1.0, 0.0], 1, "a"), (3, [5.0, 0.0], 1, "a"), (4, [1.0, 0.0], 2, "a"), (5, [1.0, 0.0], None, "a"), (6, None, 1, "a"),
        (7, [], 1, "a"), (8, [0.0, 0.0], 1, "a"), (9, [nan, 1.0], 1, "a"), (10, [inf, 1.0], 1, "a"), (11, [None, 1.0], 1, "a"), (12, [1.0, 0.0, 0.0], 1, "a"),
        (None, [1.0, 0.0], 1, "a"), (13, [1.0, 0.1], 1, "a"), (13, [1.0, 0.1], 1, "a"), (14, [1.0, 0.35], 1, "a"), (None, [0.0, 1.0], 3, "a"), (15, [-1.0, 0.0], 1, "a"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_large_tight_group(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    rng = np.random.default_rng(1)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.01).astype("f4").tolist(), 0, "x") for i in range(300)]
    got = run(spark, rows)
    assert got == brute(rows) and all(r[1] == 299 for r in got)
