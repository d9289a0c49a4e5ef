"""Queries: split and leakage checks, tokens and n-grams, TF-IDF features."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions.text import word_tokens as tokens_of
from corpuslens.operators import ngrams as N, split as P, tfidf as X
from corpuslens.operators.quality import text_key
from corpuslens.plans import sql as S
from corpuslens.plans.corpus import class_rows, cleaned, cleaned_split, corpus, documents, kept_clean, part
from corpuslens.plans.registry import query
from corpuslens.sources.tables import keep_table, read_table

# ---------------------------------------------------------------- split

_SPLIT = S.with_(S.VALID, S.CORPUS, S.split("s", "corpus"))


@query(_SPLIT + "SELECT doc_id, lang, split FROM s")
def stratified_split(spark, d):
    return P.stratified_split(class_rows(spark, d, "doc_id", "lang"))


@query(S.with_(S.VALID, S.CORPUS, S.split("s", "corpus", label="source")) + "SELECT doc_id, source, split FROM s")
def stratified_split_many_classes(spark, d):
    return P.stratified_split(class_rows(spark, d, "doc_id", "source"), label="source")


@query(_SPLIT + "SELECT split, count(*) AS n_docs, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM s GROUP BY split")
def split_sizes(spark, d):
    return P.split_sizes(P.stratified_split(class_rows(spark, d, "doc_id", "lang")))


@query(
    _SPLIT
    + "SELECT lang, train, val, test, round(train * 100.0 / sum(train) OVER (), 6) AS train_pct, round(val * 100.0 / sum(val) OVER (), 6) AS val_pct, "
    "round(test * 100.0 / sum(test) OVER (), 6) AS test_pct FROM (SELECT lang, count(*) FILTER (split = 'train') AS train, "
    "count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM s GROUP BY lang)"
)
def split_class_shares(spark, d):
    return P.split_class_shares(P.stratified_split(class_rows(spark, d, "doc_id", "lang")))


def _leak_sql():
    def one(kind, col, a, b):
        return (
            f"SELECT '{kind}' AS kind, '{a}' AS split_a, '{b}' AS split_b, count(*) AS n_shared FROM "
            f"(SELECT {col} FROM s WHERE split = '{a}' INTERSECT SELECT {col} FROM s WHERE split = '{b}')"
        )

    return " UNION ALL ".join(
        one(kind, col, a, b)
        for kind, col in (("id", "doc_id"), ("text", "text"))
        for a, b in (("train", "val"), ("train", "test"), ("val", "test"))
    )


@query(_SPLIT + _leak_sql())
def split_leakage(spark, d):
    # the check compares hashes of texts; of the texts only their hash is carried through the split
    rows = keep_table(corpus(spark, d).select("doc_id", "lang", text_key("text").alias("text")))
    return P.split_leakage(P.stratified_split(rows))


@query(S.with_(S.split("s", "documents")) + _leak_sql())
def split_leakage_raw(spark, d):
    """The same check on documents split before de-duplication: it finds the copies."""
    return P.split_leakage(P.stratified_split(documents(spark, d)))


@query(_SPLIT + "SELECT doc_id, lang, split FROM s WHERE split <> 'test'")
def union_train_val(spark, d):
    return P.union_train_val(P.stratified_split(class_rows(spark, d, "doc_id", "lang")))


@query("SELECT source, row_number() OVER (ORDER BY source) - 1 AS label_index FROM (SELECT DISTINCT source FROM documents)")
def label_index(spark, d):
    return P.label_index(documents(spark, d), "source")


@query(
    "SELECT quality, n_docs, round(CAST(sum(n_docs) OVER () AS DOUBLE) / (count(*) OVER () * n_docs), 6) AS class_weight "
    "FROM (SELECT quality, count(*) AS n_docs FROM labels GROUP BY quality)"
)
def class_weights(spark, d):
    return P.class_weights(read_table(spark, d, "labels"), "quality")


# ---------------------------------------------------------------- tokens and n-grams


def _token_sql(n):
    return (
        S.with_(f"t AS (SELECT doc_id, regexp_extract_all(lower(text), '[{S.WORD}]{{{n},}}') AS t FROM documents)")
        + "SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct, array_to_string(t, ' ') AS tokens FROM t"
    )


def _tokens(spark, d, n):
    docs = documents(spark, d).select("doc_id", tokens_of(F.lower("text"), n).alias("t"))
    return docs.select(
        "doc_id",
        F.size("t").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("t")).cast("long").alias("n_distinct"),
        F.array_join("t", " ").alias("tokens"),
    )


@query(_token_sql(1))
def word_tokens(spark, d):
    return _tokens(spark, d, 1)


@query(_token_sql(2))
def word_tokens_min2(spark, d):
    return _tokens(spark, d, 2)


@query(S.with_(S.tokens("t", "documents", text="text"), S.word_counts("c", "t", 1, 3)) + "SELECT doc_id, term, tf FROM c")
def word_ngrams(spark, d):
    return N.count_word_terms(documents(spark, d), "doc_id", "text", 1, 3)


_PER_TERM = "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM c GROUP BY term"


@query(S.with_(S.char_counts("c", "documents", 3, 5, text="text")) + _PER_TERM)
def char_ngrams(spark, d):
    return N.char_term_stats(documents(spark, d), "text", 3, 5)


@query(S.with_(S.char_wb_counts("c", "documents", 3, 5, text="text")) + _PER_TERM)
def char_wb_ngrams(spark, d):
    return N.char_wb_term_stats(documents(spark, d), "text", 3, 5)


@query(S.with_(S.char_wb_counts("c", "documents", 5, 6, text="text")) + _PER_TERM)
def char_wb_ngrams_long(spark, d):
    """A range above the shortest words, which are emitted whole."""
    return N.char_wb_term_stats(documents(spark, d), "text", 5, 6)


_WORDS = S.with_(S.CLEANED, S.tokens("t", "docs"), S.word_counts("c", "t", 1, 2))


@query(_WORDS + _PER_TERM)
def term_df(spark, d):
    return N.word_term_stats(cleaned(spark, d), "clean", 1, 2)


def _vocabulary(spark, d, **limits):
    docs = kept_clean(spark, d)
    stats = N.word_term_stats(docs, "clean", 1, 2)
    return X.Vocabulary.from_stats(stats, X.count_rows(docs), **limits).terms.withColumn("idf", F.round("idf", 6))


_VOCABULARY = "SELECT term, df, cf, round(idf, 6) AS idf FROM v"


@query(_WORDS.rstrip() + ",\n" + S.vocabulary("v", "c", "docs", 2, 0.90) + "\n" + _VOCABULARY)
def vocab_pruned(spark, d):
    return _vocabulary(spark, d, min_df=2, max_df=0.90)


@query(_WORDS.rstrip() + ",\n" + S.vocabulary("v", "c", "docs", 2, 0.90, 5000) + "\n" + _VOCABULARY)
def vocab_topk(spark, d):
    return _vocabulary(spark, d, min_df=2, max_df=0.90, max_features=5000)


# ---------------------------------------------------------------- TF-IDF


def _fit_sql(counts, min_df, max_df, k, c="c", v="v", w="w"):
    return S.with_(S.CLEANED, counts, S.vocabulary(v, c, "docs", min_df, max_df, k), S.weights(w, c, v))


_TOTALS = "SELECT term, count(*) AS n_docs, round(sum(w), 6) AS sum_w, round(max(w), 6) AS max_w FROM w GROUP BY term"


def _fit_transform(spark, d, block):
    docs = kept_clean(spark, d)
    return block.fit(docs, "doc_id", "clean").transform(docs, "doc_id", "clean")


@query(_fit_sql(S.tokens("t", "docs") + ",\n" + S.word_counts("c", "t", 1, 2), 2, 0.90, 25_000) + "SELECT doc_id, term, round(w, 6) AS w FROM w")
def tfidf_word(spark, d):
    return _fit_transform(spark, d, X.word_block()).withColumn("w", F.round("w", 6))


@query(_fit_sql(S.tokens("t", "docs") + ",\n" + S.word_counts("c", "t", 1, 2), 2, 0.95, None) + _TOTALS)
def tfidf_word_unbounded(spark, d):
    """No limit on the vocabulary: joined by term instead of broadcast."""
    return X.term_totals(_fit_transform(spark, d, X.word_block(max_df=0.95, max_features=None)))


@query(_fit_sql(S.char_counts("c", "docs", 3, 5), 2, 1.0, 35_000) + _TOTALS)
def tfidf_char(spark, d):
    return X.term_totals(_fit_transform(spark, d, X.char_block(min_df=2, max_df=1.0, channel="char")))


@query(_fit_sql(S.char_wb_counts("c", "docs", 3, 5), 3, 0.90, 35_000) + _TOTALS)
def tfidf_char_wb(spark, d):
    return X.term_totals(_fit_transform(spark, d, X.char_block()))


_HOLDOUT = S.with_(
    S.CLEANED,
    S.split("s", "docs"),
    "train AS MATERIALIZED (SELECT * FROM s WHERE split = 'train')",
    S.tokens("t", "s", keep="split,"),
    S.word_counts("c", "t", 1, 2, "split,"),
    S.vocabulary("v", "c", "train", 2, 0.90, 25_000, "WHERE split = 'train'"),
    S.weights("w", "c", "v", "split,"),
)


@query(_HOLDOUT + "SELECT doc_id, term, round(w, 6) AS w FROM w WHERE split = 'test'")
def tfidf_holdout(spark, d):
    """Vocabulary and IDF from the training part, weights of the test part."""
    docs = cleaned_split(spark, d)
    fitted = X.word_block().fit(part(docs, "train"), "doc_id", "clean")
    return fitted.transform(part(docs, "test"), "doc_id", "clean").withColumn("w", F.round("w", 6))


_UNION = S.with_(
    S.CLEANED,
    S.tokens("t", "docs"),
    S.word_counts("cw", "t", 1, 2),
    S.vocabulary("vw", "cw", "docs", 2, 0.90, 25_000),
    S.weights("ww", "cw", "vw"),
    S.char_wb_counts("cc", "docs", 3, 5),
    S.vocabulary("vc", "cc", "docs", 2, 0.90, 35_000),
    S.weights("wc", "cc", "vc"),
    "u AS (SELECT 'word' AS channel, * FROM ww UNION ALL SELECT 'char_wb', * FROM wc)",
)


def _union(spark, d):
    docs = kept_clean(spark, d)
    return docs, X.FeatureUnion(X.word_char_blocks()).fit(docs)


@query(_UNION + "SELECT channel, doc_id, count(*) AS n_terms, round(sum(w), 6) AS sum_w, round(sum(w * w), 6) AS norm2 FROM u GROUP BY channel, doc_id")
def tfidf_union(spark, d):
    docs, union = _union(spark, d)
    return union.transform(docs).groupBy("channel", "doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("w"), 6).alias("sum_w"), F.round(F.sum(F.col("w") * F.col("w")), 6).alias("norm2")
    )


@query(
    _UNION
    + "SELECT channel, term, df, row_number() OVER (ORDER BY CASE channel WHEN 'word' THEN 0 ELSE 1 END, term) - 1 AS idx FROM "
    "(SELECT 'word' AS channel, * FROM vw UNION ALL SELECT 'char_wb', * FROM vc)"
)
def feature_index(spark, d):
    """Feature names of the union in matrix order."""
    _, union = _union(spark, d)
    return union.terms().select("channel", "term", "df", F.col("idx").cast("long").alias("idx"))


@query(
    _fit_sql(S.tokens("t", "docs") + ",\n" + S.word_counts("c", "t", 1, 2), 2, 0.90, 25_000)
    + "SELECT n_docs, n_terms, nnz, round(CAST(nnz AS DOUBLE) / (n_docs * n_terms), 9) AS density FROM "
    "(SELECT (SELECT count(*) FROM docs) AS n_docs, (SELECT count(*) FROM v) AS n_terms, (SELECT count(*) FROM w) AS nnz)"
)
def feature_shape(spark, d):
    docs = kept_clean(spark, d)
    fitted = X.word_block().fit(docs, "doc_id", "clean")
    return X.feature_shape(fitted.transform(docs, "doc_id", "clean"), X.count_rows(docs), X.count_rows(fitted.vocabulary.terms))


@query(
    _fit_sql(S.tokens("t", "docs") + ",\n" + S.word_counts("c", "t", 1, 2), 2, 0.90, 25_000)
    + "SELECT d.doc_id, count(w.term) AS nnz, round(coalesce(sum(w), 0.0), 6) AS sum_w FROM docs d LEFT JOIN w ON w.doc_id = d.doc_id GROUP BY d.doc_id"
)
def feature_vectors(spark, d):
    """Sparse Spark ML vectors of the factory's word features, summarised per document."""
    from pyspark.ml.functions import vector_to_array

    docs = kept_clean(spark, d)
    union = X.FeatureUnion(X.feature_blocks("word")).fit(docs)
    terms = union.terms().persist()
    vectors = union.vectors(docs, terms, terms.count())
    cells = vectors.select("doc_id", F.filter(vector_to_array("features"), lambda v: v != 0).alias("cells"))
    total = F.aggregate("cells", F.lit(0.0), lambda a, b: a + b)
    return cells.select("doc_id", F.size("cells").cast("long").alias("nnz"), F.round(total, 6).alias("sum_w"))


@query("SELECT doc_id, substr(text, 1, 2500) AS text FROM documents")
def truncate_text(spark, d):
    return N.truncate_text(documents(spark, d)).select("doc_id", "text")
