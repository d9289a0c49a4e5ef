"""Co-training: held-out accuracy, agreement of calibration, odd rows."""

import random
import zlib

import numpy as np
import pytest

from corpuslens.llm import cotraining
from corpuslens.llm.cotraining import META_BUCKETS, fit_calibration, fit_logistic, judge_documents, meta_features, text_features

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, score string"


def tables(spark, folder="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    hidden = {d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1}
    rows = judge_documents(docs, labels.filter(~labels.doc_id.isin(list(hidden)))).collect()
    assert len(rows) == docs.count()
    kept = {r.doc_id: r.kept for r in rows}
    good, bad = [kept[d] for d in hidden if truth[d]], [kept[d] for d in hidden if not truth[d]]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        words = [rng.choice(vocabulary) + ("" if good or rng.random() < 0.2 else "%%%") for _ in range(rng.randrange(20, 60))]
        source = rng.choice(["a", "b"]) if good or rng.random() < 0.1 else "spam"
        rows.append((i, " ".join(words), source, "en", 100, "x"))
        labels.append((i, int(good)))
    return rows, labels


def test_views_teach_each_other(spark, monkeypatch):
    seen = []
    plain = cotraining._fitted
    monkeypatch.setattr(cotraining, "_fitted", lambda *a: seen.append([sum(map(len, x)) for x in a[2:]]) or plain(*a))
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = judge_documents(docs, spark.createDataFrame(labels[:160], "doc_id long, quality int")).collect()
    assert seen[0] == [0, 0] and seen[-1][1] > 0  # the text view hands documents to the metadata view
    truth = dict(labels)
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in out if r.doc_id >= 160]) > 0.97


def test_odd_rows(spark):
    rows, labels = corpus()
    long = " ".join(f"word{i % 300}" for i in range(80_000))
    odd = [(None, None, None, None, None, None), (900, "", "a", "en", 0, "x"), (901, " \n\t", "a", None, -5, "x"), (0, rows[0][1], "a", "en", 1, "x"), (0, rows[0][1], "a", "en", 1, "x"), (902, long, "a", "en", None, "x"), (None, rows[1][1], "a", "en", 100, "x")]
    given = [*labels, (None, 1), (5, 7), (6, None), (1, 0), (1, 1)]
    out = judge_documents(spark.createDataFrame(rows + odd, SCHEMA), spark.createDataFrame(given, "doc_id long, quality int")).collect()
    assert len(out) == len(rows) + len(odd)
    by_text = {}
    for r in out:
        assert by_text.setdefault((r.doc_id, r.text, r.source, r.lang, r.n_chars), r.score) == r.score
        if not (r.text or "").split():
            assert r.score == 0 and not r.kept


@pytest.mark.parametrize("labels", [[], [(i, 1) for i in range(400)]])
def test_without_both_classes_all_stay(spark, labels):
    rows, _ = corpus(40)
    out = judge_documents(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == 40 and all(r.kept and r.score is None for r in out)
    assert judge_documents(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect() == []


def test_fits():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.ones((3000, 1)), rng.normal(size=(3000, 3))], axis=1).astype(np.float32)
    p = 1 / (1 + np.exp(-(x @ [0.5, 2.0, -1.0, 0.0])))
    y = (rng.random(3000) < p).astype(float)
    w = fit_logistic(x, y, np.ones(4), l2=1e-6)
    q = 1 / (1 + np.exp(-(x @ w)))
    assert np.abs(x.T @ (q - y) / 3000).max() < 2e-3  # the gradient is near zero
    slope, offset = fit_calibration(3 * (x @ w) + 1, y)
    assert abs(slope - 1 / 3) < 0.02 and abs(offset + 1 / 3) < 0.1
    slope, offset = fit_calibration(np.array([-5.0] * 10 + [5.0] * 30), np.array([0.0] * 10 + [1.0] * 30))
    assert 0.2 < slope < 5


def test_the_driver_holds_what_is_not_zero(spark):
    docs, labels = tables(spark)
    ids = labels.selectExpr("doc_id", "cast(quality as int) as y")
    found = cotraining._features(docs, ids)
    assert len(found) > 100 and sum(len(a) + len(b) for x in (found.t, found.m) for a, b in x.rows) < len(found) * 4_000
    by_id = {r.doc_id: r for r in docs.collect()}
    for side, width in ((found.t, len(cotraining.TEXT_SCALE)), (found.m, META_BUCKETS)):
        x, w = side.fill(np.zeros((len(found), width), np.float32)), np.arange(width) % 7 - 3.0
        assert np.allclose(side @ w, x @ w)
        for i, d in enumerate(found.doc_id.tolist()):
            r = by_id[d]
            assert (x[i] == (text_features(r.text) if side is found.t else meta_features(r.source, r.lang, r.n_chars))).all()
    half = found.where(found.y > 0)
    assert len(half.t.rows) == len(half) == int(found.y.sum())
