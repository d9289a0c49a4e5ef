import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import ngrams as N, tfidf as T

TEXTS = [
    "x y z", "a bc", "abcd", "ab", "a", "", "sales and service", "to be or not to be to be",
    "naïve  café\tau lait", "emoji 😀😀 ok", "a  b", "longer words here inside longer words",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, clean string").repartition(3, "doc_id")


def as_counts(df):
    out = defaultdict(Counter)
    for r in df.collect():
        assert r["term"] not in out[r["doc_id"]]
        out[r["doc_id"]][r["term"]] = r["tf"]
    return dict(out)


def word_grams(text, lo, hi, min_len=1, stop=()):
    import regex

    toks = [t for t in regex.findall(r"[\p{L}\p{N}_]+", text.lower()) if len(t) >= min_len and t not in stop]
    return Counter(" ".join(toks[i : i + n]) for n in range(lo, hi + 1) for i in range(len(toks) - n + 1))


def char_grams(text, lo, hi):
    import re

    text = re.sub(r"\s\s+", " ", text.lower())
    return Counter(text[i : i + n] for n in range(lo, hi + 1) for i in range(len(text) - n + 1))


def wb_grams(text, lo, hi):
    out = Counter()
    for w in text.lower().split():
        w = f" {w} "
        for n in range(lo, hi + 1):
            out.update(w[i : i + n] for i in range(len(w) - n + 1))
        if len(w) < lo:
            out[w] += 1
    return out


def brute(grams):
    return {i: c for i, t in enumerate(TEXTS) if (c := grams(t))}


@pytest.mark.parametrize("lo,hi,min_len", [(1, 1, 1), (1, 1, 2), (1, 3, 1), (2, 2, 2)])
def test_word_terms(docs, lo, hi, min_len):
    got = as_counts(N.count_word_terms(docs, "doc_id", "clean", lo, hi, min_len))
    assert got == brute(lambda t: word_grams(t, lo, hi, min_len))


def test_ngrams_bridge_stop_words(docs):
    got = as_counts(N.count_word_terms(docs, "doc_id", "clean", 2, 2, stop_words=["and"]))
    assert got[6] == {"sales service": 1}


@pytest.mark.parametrize("lo,hi", [(3, 5), (2, 2), (4, 7)])
def test_char_terms(docs, lo, hi):
    assert as_counts(N.count_char_terms(docs, "doc_id", "clean", lo, hi)) == brute(lambda t: char_grams(t, lo, hi))


@pytest.mark.parametrize("lo,hi", [(3, 5), (5, 6)])
def test_char_wb_terms(docs, lo, hi):
    assert as_counts(N.count_char_wb_terms(docs, "doc_id", "clean", lo, hi)) == brute(lambda t: wb_grams(t, lo, hi))


def test_short_words_are_emitted_once(docs):
    got = as_counts(N.count_char_wb_terms(docs, "doc_id", "clean", 3, 5))
    assert got[4] == {" a ": 1}
    assert got[3] == {" ab": 1, "ab ": 1, " ab ": 1}


def reference_tfidf(min_df, max_df, k):
    counts = {i: word_grams(t, 1, 2) for i, t in enumerate(TEXTS)}
    df = Counter(t for c in counts.values() for t in c)
    cf = sum(counts.values(), Counter())
    kept = [t for t in df if min_df <= df[t] <= max_df * len(TEXTS)]
    kept = set(sorted(kept, key=lambda t: (-cf[t], t.encode()))[:k])
    out = {}
    for i, c in counts.items():
        raw = {t: (1 + math.log(n)) * (math.log((1 + len(TEXTS)) / (1 + df[t])) + 1) for t, n in c.items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out.update({(i, t): w / norm for t, w in raw.items()})
    return out


@pytest.mark.parametrize("min_df,max_df,k", [(1, 1.0, None), (2, 0.9, None), (1, 1.0, 7), (1, 0.15, 50)])
def test_tfidf_equals_brute_force(docs, min_df, max_df, k):
    block = T.Block("word", 1, 2, min_df, max_df, k)
    got = {(r["doc_id"], r["term"]): r["w"] for r in block.fit(docs, "doc_id", "clean").transform(docs, "doc_id", "clean").collect()}
    want = reference_tfidf(min_df, max_df, k or 10**9)
    assert got.keys() == want.keys()
    assert all(got[key] == pytest.approx(want[key], abs=1e-12) for key in want)


def test_unbounded_vocabulary_with_hot_terms_split(docs):
    counts = N.count_word_terms(docs, "doc_id", "clean", 1, 2)
    vocabulary = T.Vocabulary.fit(counts, T.count_rows(docs))
    plain = {tuple(r) for r in T.weigh(counts, vocabulary).select("doc_id", "term", F.round("w", 9)).collect()}
    split = {tuple(r) for r in T.weigh(counts, vocabulary, hot_rows=1).select("doc_id", "term", F.round("w", 9)).collect()}
    assert plain == split and len(plain) == counts.count()


def test_union_vectors(docs):
    union = T.FeatureUnion([T.word_block(1, 1, 1, 1.0, 100), T.char_block(3, 3, 1, 1.0, 100)]).fit(docs)
    terms = union.terms().persist()
    size = terms.count()
    assert sorted(r["idx"] for r in terms.collect()) == list(range(size))
    vectors = {r["doc_id"]: r["features"] for r in union.vectors(docs, terms, size).collect()}
    assert len(vectors) == len(TEXTS)
    assert vectors[5].numNonzeros() == 0
    assert vectors[0].norm(2) == pytest.approx(math.sqrt(2))  # two channels of norm 1


def test_unknown_feature_type():
    with pytest.raises(ValueError):
        T.feature_blocks("sound")


@pytest.mark.parametrize("k", [0, 1, 2, 5, 7, 8, 20])
def test_most_frequent_equals_sorting(spark, k):
    rows = [(t, 1, cf) for t, cf in [("b", 3), ("a", 3), ("zz", 9), ("aaaab", 2), ("aaaaa", 2), ("aaaac", 2), ("x", 2), ("é", 2)]]
    got = {r["term"] for r in T.most_frequent(spark.createDataFrame(rows, "term string, df long, cf long"), k).collect()}
    assert got == {t for t, _, _ in sorted(rows, key=lambda r: (-r[2], r[0].encode()))[:k]}


def test_top_k_does_not_rank_the_vocabulary(spark, docs):
    counts = N.count_word_terms(docs, "doc_id", "clean", 1, 2)
    plan = T.Vocabulary.fit(counts, F.lit(12), 1, 1.0, 5).terms._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit" not in plan
