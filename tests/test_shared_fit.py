"""Classifiers fitted together against the gradient of each on its own, and a plain solver."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from corpuslens.operators import shared_fit as S

N, SIZE, CLASSES = 120, 25, 3


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = (rng.random((N, SIZE)) < 0.25) * rng.random((N, SIZE))
    x[7] = 0.0
    y = (x @ rng.random((SIZE, CLASSES)) + 0.3 * rng.random((N, CLASSES))).argmax(axis=1)
    return x, y, np.arange(N) % 5


@pytest.fixture(scope="module")
def blocks(spark, data):
    rows = [
        (i, Vectors.dense(x.tolist()) if i % 3 == 0 else Vectors.sparse(SIZE, [(j, float(v)) for j, v in enumerate(x) if v]), float(y), int(k))
        for i, (x, y, k) in enumerate(zip(*data))
    ]
    unlabelled = (999, rows[0][1], -1.0, 0)  # a row without a class takes no part
    df = spark.createDataFrame([*rows, unlabelled], ["id", "features", "y", "fold"]).withColumn("y", F.when(F.col("y") >= 0, F.col("y"))).repartition(3)
    both = S.spread([S.pack_blocks(df, "all", fold=F.col("fold"), id_col=F.col("id")), S.pack_blocks(df.filter("id < 60"), "half")], 8)
    yield both
    both.unpersist()


PROBLEMS = [
    S.Problem("all", S.SQUARED_HINGE), S.Problem("all", S.SQUARED_HINGE, 2.0, True, 3), S.Problem("all", S.LOG, 2.0), S.Problem("half", S.LOG, 0.5, True), S.Problem("half", S.SQUARED_HINGE, 0.25),
]


def plain(problem, x, y, fold):
    """Loss and gradient document by document."""
    if problem.data == "half":
        x, y, fold = x[:60], y[:60], np.full(60, -1)
    use = fold != problem.left_out if problem.left_out is not None else np.ones(len(y), dtype=bool)
    counts = np.bincount(y[use], minlength=CLASSES)
    own = use.sum() / (CLASSES * counts) if problem.balanced else np.ones(CLASSES)

    def at(w):
        f, g = 0.0, np.zeros_like(w)
        for xi, yi in zip(x[use], y[use]):
            xi = np.append(xi, 1.0)
            z = w @ xi
            if problem.loss == S.LOG:
                p = np.exp(z - z.max())
                p /= p.sum()
                f -= problem.C * own[yi] * np.log(p[yi])
                g += problem.C * own[yi] * np.outer(p - np.eye(CLASSES)[yi], xi)
                continue
            for k in range(CLASSES):
                s, weight = (1, own[k]) if k == yi else (-1, 1.0)
                gap = max(0.0, 1 - s * z[k])
                f += problem.C * weight * gap * gap
                g[k] -= 2 * problem.C * weight * s * gap * xi
        penalty = w.copy()
        if problem.loss == S.LOG:
            penalty[:, -1] = 0
        return f + 0.5 * (penalty**2).sum(), g + penalty

    return at


def test_every_fit_is_at_its_own_minimum(blocks, data):
    fitted = S.fit_together(blocks, PROBLEMS, {"all": SIZE, "half": SIZE}, CLASSES, tol=1e-9)
    rng = np.random.default_rng(1)
    for problem, w in zip(PROBLEMS, fitted):
        at = plain(problem, *data)
        f, g = at(w)
        assert np.abs(g).max() < 1e-6
        for _ in range(3):
            assert f < at(w + 1e-3 * rng.normal(size=w.shape))[0]


def test_turns_and_sums_on_the_way_change_nothing(blocks, monkeypatch):
    sizes = {"all": SIZE, "half": SIZE}
    want = S.fit_together(blocks, PROBLEMS, sizes, CLASSES, tol=1e-7)
    one = CLASSES * (SIZE + 1)
    alone = S.fit_together(blocks, PROBLEMS, sizes, CLASSES, tol=1e-7, most_weights=one)
    for a, b in zip(want, alone):
        assert a == pytest.approx(b, abs=1e-6)
    for name, value in (("DIRECT", 1), ("FAN_IN", 2), ("SLICE", 20)):
        monkeypatch.setattr(S, name, value)
    spread = blocks.repartition(4).persist()
    found = S.fit_together(spread, PROBLEMS[:2], sizes, CLASSES, tol=1e-7)
    spread.unpersist()
    for a, b in zip(want, found):
        assert a == pytest.approx(b, abs=1e-6)
    with pytest.raises(ValueError, match="more than"):
        S.fit_together(blocks, PROBLEMS, sizes, CLASSES, most_weights=one - 1)


def test_margins_of_blocks_and_vectors(spark, blocks, data):
    x, y, fold = data
    w = np.random.default_rng(2).normal(size=(CLASSES, SIZE + 1))
    found = S.block_margins(blocks, {"all": [w, 2 * w]}).collect()
    assert len(found) == 2 * N
    for r in found:
        i = int(r["id"])
        assert r["margins"] == pytest.approx((1 + r["model"]) * (w[:, :-1] @ x[i] + w[:, -1])) and (r["y"], r["fold"]) == (y[i], fold[i])
    df = spark.createDataFrame([(0, Vectors.sparse(SIZE, [1, 4], [0.5, 2.0])), (1, Vectors.dense(x[0].tolist())), (2, Vectors.sparse(SIZE, [], []))], ["id", "v"])
    got = {r["id"]: r["m"] for r in df.select("id", S.vector_margins(df, w, "v").alias("m")).collect()}
    assert got[0] == pytest.approx(w[:, 1] * 0.5 + w[:, 4] * 2.0 + w[:, -1])
    assert got[1] == pytest.approx(w[:, :-1] @ x[0] + w[:, -1]) and got[2] == pytest.approx(w[:, -1])


def test_small_blocks_make_the_same_fit(spark, data, monkeypatch):
    x, y, _ = data
    df = spark.createDataFrame([(Vectors.dense(a.tolist()), float(b)) for a, b in zip(x, y)], ["features", "y"])
    fits = []
    for rows in (2_000, 7):
        monkeypatch.setattr(S, "BLOCK_ROWS", rows)
        packed = S.spread([S.pack_blocks(df, "d")], 2)
        fits.append(S.fit_together(packed, [S.Problem("d", S.SQUARED_HINGE)], {"d": SIZE}, CLASSES, tol=1e-8)[0])
        packed.unpersist()
    assert fits[0] == pytest.approx(fits[1], abs=1e-5)


def test_blocks_are_small_rows_taken_together(spark, data, blocks):
    """Rows that reach Python are small; a task's blocks of one data are one, so a gradient is not made for each."""
    x, y, fold = data
    assert S.BLOCK_CELLS * 12 < 2 << 20
    batches = blocks.drop("ids").toArrow().to_batches()
    got = dict(S._gathered(batches, {"all", "half"}))
    assert len(got["all"].y) == N and len(got["half"].y) == 60 and len(list(S._gathered(batches, {"half"}))) == 1
    w = np.random.default_rng(2).random((CLASSES, SIZE + 1))
    order = np.lexsort(got["all"].margins(w).T)
    plain_ = x @ w[:, :-1].T + w[:, -1]
    assert got["all"].margins(w)[order] == pytest.approx(plain_[np.lexsort(plain_.T)], abs=1e-9)


def test_common_features_are_one_product(monkeypatch):
    """Margins and gradients of many columns, of features that are dense, rare and not met, and of an empty document."""
    rng = np.random.default_rng(3)
    x = (rng.random((90, 40)) < np.linspace(0.9, 0.0, 40)) * rng.random((90, 40))
    x[5] = 0.0
    cells = [np.flatnonzero(row) for row in x]
    row = {"ids": None, "y": np.zeros(90, "<i4").tobytes(), "fold": np.zeros(90, "<i4").tobytes(), "ends": np.cumsum([len(c) for c in cells]).astype("<i8").tobytes()}
    row |= {"idx": np.concatenate(cells).astype("<i4").tobytes(), "val": x[x > 0].astype("<f8").tobytes()}
    block, w, slopes = S._Block(row), rng.normal(size=(6, 41)), rng.normal(size=(90, 6))
    for share in (0.0, 0.2, 2.0):
        monkeypatch.setattr(S, "COMMON", share)
        matrix = S._Matrix(block, 40)
        assert matrix.margins(w) == pytest.approx(block.margins(w))
        assert len(matrix.common) + len(matrix.rare) == (x > 0).any(axis=0).sum() and (len(matrix.rare) > 0) == (share > 0) and (len(matrix.common) > 0) == (share < 2)
        assert matrix.margins(w) == pytest.approx(x @ w[:, :-1].T + w[:, -1])
        total = np.ones((6, 41))
        matrix.add_gradient(slopes, total)
        cell_by_cell = np.ones((6, 41))
        block.add_gradient(slopes, cell_by_cell)
        assert total == pytest.approx(cell_by_cell)
        assert total[:, :-1] == pytest.approx(1 + slopes.T @ x) and total[:, -1] == pytest.approx(1 + slopes.sum(axis=0))


def test_only_numbers_that_are_not_zero_are_sent(monkeypatch):
    """A task's part of a wide gradient holds the terms that it met, before and after parts are summed."""
    monkeypatch.setattr(S, "FAN_IN", 2)
    few, all_ = np.zeros(1000), np.arange(1.0, 1001.0)
    few[[3, 700]] = [2.0, -1.0]
    rows = [S._part(0, 0, 0, 0.5, few), S._part(0, 0, 1, 1.0, 3 * few), S._part(0, 0, 2, 0.0, few), S._part(1, 0, 0, 0.0, few), S._part(1, 0, 1, 0.0, all_), S._part(2, 0, 0, 0.0, 0 * few)]
    assert [r.column("part")[0].as_py().__len__() for r in rows] == [16, 16, 16, 16, 8000, 0]
    found = {}
    for r in S._summed(iter(rows)):
        r = r.to_pylist()[0]
        total = np.zeros(r["width"])
        S._add(total, r["at"], r["part"])
        found[r["problem"], r["task"]] = (r["loss"], total)
        assert len(r["part"]) == {0: 16, 1: 8000, 2: 0}[r["problem"]]
    assert found.keys() == {(0, 0), (0, 1), (1, 0), (2, 0)}
    assert found[0, 0][0] == 1.5 and found[0, 0][1] == pytest.approx(4 * few) and found[0, 1][1] == pytest.approx(few)
    assert found[1, 0][1] == pytest.approx(few + all_) and not found[2, 0][1].any()


def test_plain_and_calibrated_fits_share_their_steps(spark, data, monkeypatch):
    from corpuslens.operators import fit as M

    x, y, _ = data
    rows = spark.createDataFrame([(i, Vectors.dense(a.tolist()), float(b)) for i, (a, b) in enumerate(zip(x, y))], ["doc_id", "features", "y"]).persist()
    base = M.Classifier("linear_svc", class_weight="balanced", tol=1e-8)
    asked, evaluate = [], S._evaluate
    monkeypatch.setattr(S, "_evaluate", lambda blocks, n, problems: asked.append(len(problems)) or evaluate(blocks, n, problems))
    plain_, calibrated = M.fit_plain_and_calibrated_svc(rows, list(range(CLASSES)), 3, base=base)
    assert asked[0] == 4
    alone = base.fit(rows, N, CLASSES)
    assert plain_.weights == pytest.approx(alone.weights, abs=1e-5)
    again = M.fit_calibrated_svc(rows, list(range(CLASSES)), 3, base=base)
    assert np.array(calibrated.weights) == pytest.approx(np.array(again.weights), abs=1e-5)
    assert np.array(calibrated.sigmoids) == pytest.approx(np.array(again.sigmoids), abs=1e-3)
    rows.unpersist()


def test_blocks_of_texts_hold_the_vectors(spark):
    """The same numbers as the vectors of the features, to the last bit, in a fraction of the space; texts without terms, wide vocabularies and frequent terms too."""
    from corpuslens.operators.fit import text_blocks
    from corpuslens.operators.tfidf import Block, FeatureUnion
    from corpuslens.sources.tables import keep_table

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(i)}" for i in rng.zipf(1.3, 300) % 900) for _ in range(80)] + ["", "unknown", "w1 " * 400]
    docs = spark.createDataFrame([(i, t, i % 2 if i != 3 else None) for i, t in enumerate(texts)], "doc_id long, clean string, y int")
    union = FeatureUnion([Block("word", 1, 2, 2, 1.0, 3000), Block("char_wb", 2, 3, 1, 0.99, 200, sublinear=False)]).fit(docs)
    terms = keep_table(union.terms())
    size = terms.count()
    rows = sorted(union.vectors(docs, terms, size, keep=["y"]).filter("y IS NOT NULL").collect(), key=lambda r: (r["y"], tuple(r["features"].indices), tuple(r["features"].values)))
    blocks = text_blocks(docs, union, terms, size)
    packed = [r.asDict() for r in blocks.collect()]
    blocks.unpersist()
    got = []
    for row in packed:
        b = S._Block(row)
        ends = np.cumsum(b.sizes)
        got += [(int(y), tuple(b.idx[e - n : e]), tuple(b.val[e - n : e])) for y, e, n in zip(b.y, ends, b.sizes, strict=True)]
    assert sorted(got) == [(r["y"], tuple(r["features"].indices), tuple(r["features"].values)) for r in rows]
    cells = sum(len(r["features"].indices) for r in rows)
    assert sum(len(r["coded"]) for r in packed) < 12 * cells / 2


def test_classes_of_the_hinge_loss_end_by_themselves(blocks, monkeypatch):
    """A class that is at its minimum is not asked for again, and folds start from the fit of all documents."""
    asked, evaluate = [], S._evaluate
    monkeypatch.setattr(S, "_evaluate", lambda b, n, problems: asked.append({i: len(w) for i, (_, _, w, _) in problems.items()}) or evaluate(b, n, problems))
    problems = [S.Problem("all", S.SQUARED_HINGE, left_out=1), S.Problem("all", S.SQUARED_HINGE)]
    S.fit_together(blocks, problems, {"all": SIZE}, CLASSES, tol=1e-5)
    assert asked[0] == {0: CLASSES, 1: CLASSES} and all(asked)
    rows = [a.get(1, 0) for a in asked]
    whole = sum(r > 0 for r in rows)
    assert rows[:whole] == sorted(rows[:whole], reverse=True) and all(a == {1: r} for a, r in zip(asked[1:whole], rows[1:whole]))
    warm = len(asked) - whole
    asked.clear()
    S.fit_together(blocks, problems[:1], {"all": SIZE}, CLASSES, tol=1e-5)
    assert warm < len(asked)
