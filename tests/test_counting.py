"""Terms counted many documents at a time: equal to plain counting, and never a row per occurrence."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpuslens.functions import counting as K
from corpuslens.operators import ngrams as N, tfidf as X

RNG = random.Random(3)
WIDE = "".join(chr(0x4E00 + RNG.randrange(20_000)) for _ in range(30_000))
TEXTS = ["", "a", "ab", "abcabc", "a\x00\x00b\x00", "naïve 😀😀 é ok", None, " x \n yz \n longer ", WIDE, "aaaaaaa" * 500, "\n", "abcabc"]


def windows(text, lo, hi, lines):
    out = Counter()
    for part in text.split("\n") if lines else [text]:
        out.update(part[i : i + n] for n in range(lo, hi + 1) for i in range(len(part) - n + 1))
        if lines and 0 < len(part) < lo:
            out[part] += 1
    return out


@pytest.mark.parametrize("chars", [1, 100, 500_000])
@pytest.mark.parametrize(("lo", "hi", "lines"), [(3, 5, False), (1, 2, False), (3, 5, True), (5, 6, True), (9, 12, False)])
def test_characters(monkeypatch, chars, lo, hi, lines):
    monkeypatch.setattr(K, "CHARS", chars)
    monkeypatch.setattr(K, "TERMS", chars)
    count = K.count_characters(lo, hi, lines)
    got = [row for part in K.counts_by_text(count)(iter([pa.array(TEXTS), pa.array([], pa.string())])) for row in part.to_pylist()]
    want = [None if t is None else windows(t, lo, hi, lines) for t in TEXTS]
    assert [None if row is None else {c["term"]: c["tf"] for c in row} for row in got] == want
    df, cf = Counter(), Counter()
    for batch in K.sums_by_term(count)(iter([pa.record_batch([pa.array(TEXTS)], names=["t"])])):
        for row in batch.to_pylist():
            df[row["term"]] += row["df"]
            cf[row["term"]] += row["cf"]
    assert cf == sum((w for w in want if w), Counter())
    assert df == sum((Counter(w.keys()) for w in want if w), Counter())


def test_words():
    (got,) = K.counts_by_text(K.count_words(1, 2))(iter([pa.array(["a b a b", "", None, "c"])]))
    assert [r and {c["term"]: c["tf"] for c in r} for r in got.to_pylist()] == [{"a": 2, "b": 2, "a b": 2, "b a": 1}, [], None, {"c": 1}]


def test_no_row_per_occurrence(spark):
    docs = spark.createDataFrame([(i, "some words here " * 50) for i in range(20)], "doc_id long, clean string").repartition(2)
    for channel in ("word", "char", "char_wb"):
        counts = X.Block(channel, 3, 5).counts(docs, "doc_id", "clean")
        # counted in the row: nothing is shuffled for it but the documents
        assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        stats = {r.term: (r.df, r.cf) for r in X.Block(channel, 3, 5).stats(docs, "clean").collect()}
        assert stats == {r.term: (r.df, r.cf) for r in X.term_stats(counts).collect()}
    assert N.char_term_stats(docs, "clean").schema.simpleString() == "struct<term:string,df:bigint,cf:bigint>"


@pytest.mark.parametrize("channel", ["word", "char", "char_wb"])
@pytest.mark.parametrize("sublinear", [True, False])
def test_weights_in_the_row(spark, channel, sublinear):
    rows = [(i, None if i == 3 else "" if i == 4 else " ".join(RNG.choice("alpha beta gamma délta 語 e".split()) for _ in range(i % 9 + 1))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, clean string").repartition(3)
    block = X.Block(channel, 1, 3, 1, 1.0, 30, sublinear=sublinear)
    fitted = block.fit(docs, "doc_id", "clean")
    got = fitted.transform(docs, "doc_id", "clean")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    want = X.weigh(block.counts(docs, "doc_id", "clean"), fitted.vocabulary, sublinear=sublinear)
    cells = lambda df: {(r.doc_id, r.term): r.w for r in df.collect()}
    assert got.columns == want.columns and cells(got) == pytest.approx(cells(want), rel=1e-12)


def test_vectors_scores_and_explanations_stay_with_the_document(spark):
    """No row per cell and no shuffle in the plans, and the rows of the long form."""
    from corpuslens.operators import fit as M, linear_scores as L
    from corpuslens.operators.tfidf import Block, FeatureUnion, as_vectors
    from corpuslens.sources.tables import keep_table

    rows = [(i, "abc"[i % 3], t) for i, t in enumerate(["to be or not to be", "be not", "", None, "caf\u00e9 or tea", "tea tea tea not", "zz"])]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, clean string")
    union = FeatureUnion([Block("word", 1, 2, 1, 1.0, 40), Block("char_wb", 2, 3, 1, 1.0, 60)]).fit(docs)
    terms = keep_table(union.terms())
    size = terms.count()
    vectors = union.vectors(docs, terms, size)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    long = union.transform(docs).join(terms.select("channel", "term", "idx"), ["channel", "term"])
    want = {r["doc_id"]: r["features"] for r in as_vectors(docs.select("doc_id"), long, size).collect()}
    for r in vectors.collect():
        assert r["features"].indices.tolist() == want[r["doc_id"]].indices.tolist() and r["features"].size == size
        assert r["features"].values == pytest.approx(want[r["doc_id"]].values, abs=1e-12)

    rng = np.random.default_rng(1)
    model = M.text_model(M.MarginModel(rng.normal(size=(3, size + 1))), union, terms, ["a", "b", "c"])
    small = {r["doc_id"]: r["scores"] for r in model.scores(docs).collect()}
    plan = model.scores(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
    best = sorted(map(tuple, model.explain(docs, 5).collect()))
    most, L.BROADCAST_WEIGHTS = L.BROADCAST_WEIGHTS, 0
    try:
        large = {r["doc_id"]: r["scores"] for r in model.scores(docs).collect()}
        assert best == [(*r[:4], pytest.approx(r[4], abs=2e-9), *r[5:]) for r in sorted(map(tuple, model.explain(docs, 5).collect()))]
    finally:
        L.BROADCAST_WEIGHTS = most
    assert small.keys() == large.keys() and all(small[i] == pytest.approx(large[i], abs=1e-12) for i in small)


@pytest.mark.parametrize("chars", [1, 60, 500_000])
@pytest.mark.parametrize(("lo", "hi", "min_len"), [(1, 2, 1), (2, 4, 1), (1, 3, 2), (1, 12, 1)])
def test_words_are_counted_as_numbers(monkeypatch, chars, lo, hi, min_len):
    """Equal to plain counting, also where numbers of n-grams run out, and each term's string is made once for many documents."""
    monkeypatch.setattr(K, "CHARS", chars)
    monkeypatch.setattr(K, "TERMS", chars)
    texts = ["a bb a bb a", None, "", " ", " 語 é 語語  bb ", "bb", " ".join(f"w{RNG.randrange(5000)}" for _ in range(4000)), "a bb a bb a"]
    count = K.count_words(lo, hi, min_len)
    want = []
    for t in texts:
        words = [w for w in (t or "").split(" ") if len(w) >= min_len]
        want.append(None if t is None else Counter(" ".join(words[i : i + n]) for n in range(lo, hi + 1) for i in range(len(words) - n + 1)))
    got = [row for part in K.counts_by_text(count)(iter([pa.array(texts)])) for row in part.to_pylist()]
    assert [None if row is None else {c["term"]: c["tf"] for c in row} for row in got] == want
    df, cf = Counter(), Counter()
    for batch in K.sums_by_term(count)(iter([pa.record_batch([pa.array(texts)], names=["t"])])):
        for row in batch.to_pylist():
            df[row["term"]] += row["df"]
            cf[row["term"]] += row["cf"]
    assert cf == sum((w for w in want if w), Counter()) and df == sum((Counter(w.keys()) for w in want if w), Counter())
    _, terms, tf = count(["a bb a", "a bb a"])
    assert len(set(terms.dictionary.to_pylist())) == len(terms.dictionary) and len(terms) == len(tf) == 2 * len(terms.dictionary)


def test_spaced_words_are_the_tokens(spark):
    from pyspark.sql import functions as F

    from corpuslens.functions.text import join_tokens, spaced_words, word_tokens

    odd = ["Éa_1 b-c", "", None, "--", "x", " ² ⅷ́ a​b 語、語 😀", "a\n\tb\x1cc."]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", spaced_words("t").alias("s"), join_tokens(word_tokens("t")).alias("w"))
    for r in rows.collect():
        assert (r["s"] and r["s"].strip(" ")) == r["w"]
        assert r["s"] is None or "  " not in r["s"]


def test_stop_words_leave_before_ngrams():
    """Where words are numbers: an n-gram bridges what is left out, and short words are passed over."""
    count = K.count_words(1, 2, 2, ("the", "of"))
    document, terms, tf = count(["the cat of a the hat cat", "of the", "", "hat hat the hat"])
    got = Counter({(int(d), t): int(n) for d, t, n in zip(document, terms.to_pylist(), tf, strict=True)})
    assert got == {(0, "cat"): 2, (0, "hat"): 1, (0, "cat hat"): 1, (0, "hat cat"): 1, (3, "hat"): 3, (3, "hat hat"): 2}


def test_texts_are_counted_once(spark):
    """Spark must not infer from the rows of a document's terms that there are some: it would count the text again, below the join, to see that."""
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "doc_id long, clean string")
    kept = docs.join(spark.createDataFrame([(1,), (2,), (3,)], "doc_id long"), "doc_id", "left_semi")
    counts = N.count_word_terms(kept, "doc_id", "clean")
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("listed(") == 1 and "size(" not in plan
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 2), (1, "b", 1)]


def test_rows_of_a_batch_are_never_held_together(monkeypatch):
    """Cells take many times the space of their text: they leave a few documents at a time, in order, and an empty batch stays one."""
    texts = [f"abc{i} abd abe" for i in range(600)]
    vocabulary = pa.table({"term": ["abc", "abd", "abe"], "idf": [1.0, 2.0, 3.0], "x": pa.array([0, None, 1], pa.int32()), "idx": pa.array([0, 1, 2], pa.int32())})
    rows = list(K.rows_by_text(K.count_characters(3, 3), vocabulary, ["x"])(iter([pa.array(texts), pa.array([], pa.string())])))
    assert [len(r) for r in rows] == [256, 256, 88, 0]
    assert pa.concat_arrays(rows).field("x").field("idx").to_pylist() == [[0, 1]] * 600
    channel = K.Channel(K.count_characters(3, 3), vocabulary)
    struct = lambda t: pa.StructArray.from_arrays([pa.array(t, pa.string())], names=["c0"])
    vectors = list(K.vectors_by_text([channel], 3)(iter([struct(texts), struct([])])))
    assert [len(v) for v in vectors] == [256, 256, 88, 0] and pa.concat_arrays(vectors).field("indices").to_pylist() == [[0, 1, 2]] * 600
