"""Queries: corpus profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions.fixed import PROFILE_STOP_WORDS, SHORT_STOP_WORDS
from corpuslens.operators import profile as A, quality as Q
from corpuslens.plans import sql as S
from corpuslens.plans.corpus import cleaned, corpus, documents, kept_clean
from corpuslens.plans.registry import query
from corpuslens.sources.tables import keep_table


@query(
    "SELECT source, n_docs, round(n_docs * 100.0 / sum(n_docs) OVER (), 6) AS pct, count(*) OVER () AS n_classes "
    "FROM (SELECT source, count(*) AS n_docs FROM documents GROUP BY source)"
)
def class_distribution(spark, d):
    return A.class_distribution(documents(spark, d), "source")


@query(
    "SELECT row_number() OVER (ORDER BY n_docs DESC, lang) AS rank, lang, n_docs, "
    "round(sum(n_docs) OVER (ORDER BY n_docs DESC, lang) * 100.0 / sum(n_docs) OVER (), 6) AS cumulative_pct "
    "FROM (SELECT lang, count(*) AS n_docs FROM documents GROUP BY lang)"
)
def class_cumulative(spark, d):
    return A.class_cumulative(documents(spark, d))


@query(
    f"""{S.with_(S.VALID, S.CORPUS, "a AS (SELECT source, count(*) AS n FROM documents GROUP BY source)", "b AS (SELECT source, count(*) AS n FROM corpus GROUP BY source)")}
    SELECT coalesce(a.source, b.source) AS source, coalesce(a.n, 0) AS raw_n, coalesce(b.n, 0) AS clean_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS removed
    FROM a FULL OUTER JOIN b ON a.source = b.source"""
)
def class_raw_vs_clean(spark, d):
    return A.class_raw_vs_clean(documents(spark, d), corpus(spark, d), "source")


_LENGTHS = f"lengths AS MATERIALIZED (SELECT doc_id, lang, source, CAST({S.word_count('text')} AS BIGINT) AS word_len, length(text) AS char_len FROM documents)"
_LONG = (
    "m AS MATERIALIZED (SELECT doc_id, lang, source, 'word_len' AS measure, word_len AS value FROM lengths "
    "UNION ALL SELECT doc_id, lang, source, 'char_len', char_len FROM lengths)"
)


@query(
    f"""{S.with_(_LENGTHS, _LONG)} SELECT measure, count(value) AS n_docs, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
    round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max
    FROM m GROUP BY measure"""
)
def length_summary(spark, d):
    return A.length_summary(Q.with_lengths(documents(spark, d)))


@query(f"{S.with_(_LENGTHS, _LONG)} SELECT measure, round(quantile_cont(value, 0.99), 6) AS percentile FROM m GROUP BY measure")
def length_p99(spark, d):
    return A.length_percentile(Q.with_lengths(documents(spark, d)), 0.99)


_SHARES = (0.25, 0.5, 0.75, 0.99)


@query(
    f"""{S.with_(_LENGTHS, _LONG)} SELECT lang, measure, n_docs, share, true AS within_bound
    FROM (SELECT lang, measure, count(value) AS n_docs FROM m GROUP BY lang, measure), (SELECT unnest([{', '.join(f'{q}::DOUBLE' for q in _SHARES)}]) AS share)"""
)
def length_sketches(spark, d):
    """Quantiles from sketches of four increments, kept and merged; whether their exact ranks lie within the stated error."""
    docs = Q.with_lengths(documents(spark, d)).select("lang", *A.LENGTHS, F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("increment"))
    kept = keep_table(A.length_sketches(docs, ["lang", "increment"]))
    found = A.sketch_quantiles(A.merged_sketches(kept, ["lang"]), _SHARES)
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in A.LENGTHS])
    rows = docs.select("lang", F.inline(pairs)).join(F.broadcast(found), ["lang", "measure"])
    exact = rows.groupBy("lang", "measure", "n_docs", "share").agg(
        (F.count_if(F.col("value") < F.col("quantile")) / F.count("*")).alias("below"), (F.count_if(F.col("value") <= F.col("quantile")) / F.count("*")).alias("upto")
    )
    off = F.greatest(F.col("below") - F.col("share"), F.col("share") - F.col("upto"))
    return exact.select("lang", "measure", "n_docs", "share", (off <= A.sketch_error(400)).alias("within_bound"))


def _histogram_sql(measure):
    return f"""{S.with_(_LENGTHS,
        f"e AS (SELECT CAST(min({measure}) AS DOUBLE) AS low, (max({measure}) - min({measure})) / 50.0::DOUBLE AS width FROM lengths)",
        f"h AS (SELECT least(CAST(floor(({measure} - low) / width) AS BIGINT), 49) AS bin, count(*) AS n FROM lengths, e GROUP BY 1)")}
    SELECT b.bin, round(low + b.bin * width, 6) AS bin_start, coalesce(n, 0) AS n_docs FROM (SELECT unnest(range(50)) AS bin) b CROSS JOIN e LEFT JOIN h ON h.bin = b.bin"""


@query(_histogram_sql("word_len"))
def length_histogram(spark, d):
    return A.length_histogram(Q.with_lengths(documents(spark, d)), "word_len")


@query(_histogram_sql("char_len"))
def length_histogram_chars(spark, d):
    return A.length_histogram(Q.with_lengths(documents(spark, d)), "char_len")


@query(f"{S.with_(_LENGTHS)} SELECT source, round(quantile_cont(word_len, 0.5), 6) AS median, count(*) AS n_docs FROM lengths GROUP BY source")
def class_length_median(spark, d):
    return A.class_length_median(Q.with_lengths(documents(spark, d)), "source")


@query(
    f"""{S.with_(_LENGTHS, _LONG,
        "q AS (SELECT source, measure, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q75 FROM m GROUP BY source, measure)",
        "j AS (SELECT m.*, q25, median, q75, value BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside FROM m JOIN q ON m.source = q.source AND m.measure = q.measure)")}
    SELECT source, measure, round(any_value(q25), 6) AS q25, round(any_value(median), 6) AS median, round(any_value(q75), 6) AS q75,
      min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS n_outliers
    FROM j GROUP BY source, measure"""
)
def class_length_boxplot(spark, d):
    return A.class_length_boxplot(Q.with_lengths(documents(spark, d)), "source")


def _top_sql(n, k, stop):
    return (
        S.with_(S.CLEANED, S.tokens("t", "docs", 2, stop), S.word_counts("c", "t", n, n))
        + f"SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 3 ORDER BY cf DESC, term LIMIT {k}"
    )


@query(_top_sql(1, 30, PROFILE_STOP_WORDS))
def top_unigrams(spark, d):
    return A.top_ngrams(cleaned(spark, d), 1)


@query(_top_sql(2, 30, PROFILE_STOP_WORDS))
def top_bigrams(spark, d):
    return A.top_ngrams(cleaned(spark, d), 2)


@query(_top_sql(3, 30, PROFILE_STOP_WORDS))
def top_trigrams(spark, d):
    return A.top_ngrams(cleaned(spark, d), 3)


@query(_top_sql(2, 15, SHORT_STOP_WORDS))
def top_bigrams_short_list(spark, d):
    return A.top_ngrams(cleaned(spark, d), 2, k=15, stop_words=SHORT_STOP_WORDS)


@query(
    S.with_(
        S.CLEANED,
        "sample AS (SELECT * FROM docs ORDER BY md5('42|' || doc_id), doc_id LIMIT 800)",
        S.tokens("t", "sample", 2, PROFILE_STOP_WORDS),
        S.word_counts("c", "t", 1, 1),
    )
    + "SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM c GROUP BY term ORDER BY cf DESC, term LIMIT 200"
)
def corpus_term_freq_sample(spark, d):
    """Frequent words of a seeded sample of 800 documents (the sample is the feature)."""
    return A.term_frequencies(A.seeded_sample(cleaned(spark, d), 800), 200)


@query(
    S.with_(S.CLEANED, S.tokens("t", "docs", 2, PROFILE_STOP_WORDS, "lang,"), S.word_counts("c", "t", 1, 1, "lang,"))
    + "SELECT lang, term, cf, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cf DESC, term) AS rank FROM "
    "(SELECT lang, term, CAST(sum(tf) AS BIGINT) AS cf FROM c WHERE lang IN ('en', 'de', 'fr') GROUP BY lang, term)) WHERE rank <= 100"
)
def class_term_freq(spark, d):
    return A.class_term_frequencies(cleaned(spark, d), ["en", "de", "fr"])


def _centroid_ctes(label):
    return S.with_(
        S.CLEANED,
        S.tokens("t", "docs", 2, PROFILE_STOP_WORDS, f"{label},"),
        S.word_counts("c", "t", 1, 1, f"{label},"),
        S.vocabulary("v", "c", "docs", k=5000),
        S.weights("w", "c", "v", f"{label},"),
        f"sizes AS (SELECT {label}, count(*) AS n FROM docs GROUP BY {label})",
        f"cent AS MATERIALIZED (SELECT w.{label}, term, sum(w) / any_value(n) AS mean_w FROM w JOIN sizes ON w.{label} = sizes.{label} GROUP BY w.{label}, term)",
        f"norms AS (SELECT {label}, sqrt(sum(mean_w * mean_w)) AS norm FROM cent GROUP BY {label})",
        f"sim AS MATERIALIZED (SELECT a.{label} AS class_a, b.{label} AS class_b, round(sum(a.mean_w * b.mean_w) / any_value(na.norm * nb.norm), 6) AS cosine "
        f"FROM cent a JOIN cent b ON a.term = b.term JOIN norms na ON na.{label} = a.{label} JOIN norms nb ON nb.{label} = b.{label} GROUP BY ALL)",
    )


def _centroids(spark, d, label):
    return A.class_centroids(kept_clean(spark, d), label=label, stop_words=PROFILE_STOP_WORDS)


@query(_centroid_ctes("lang") + "SELECT lang, term, round(mean_w, 6) AS mean_w FROM cent")
def class_centroids(spark, d):
    return _centroids(spark, d, "lang").withColumn("mean_w", F.round("mean_w", 6))


@query(_centroid_ctes("source") + "SELECT * FROM sim")
def class_similarity(spark, d):
    return A.class_similarity(keep_table(_centroids(spark, d, "source")), "source")


@query(_centroid_ctes("source") + "SELECT * FROM sim WHERE class_a < class_b ORDER BY cosine DESC, class_a, class_b LIMIT 10")
def top_similar_classes(spark, d):
    return A.top_similar_classes(A.class_similarity(keep_table(_centroids(spark, d, "source")), "source"))


@query(
    _centroid_ctes("lang")
    + "SELECT lang, rank, term, round(mean_w, 6) AS mean_w FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY round(mean_w, 9) DESC, term) AS rank FROM cent) WHERE rank <= 10"
)
def class_top_terms(spark, d):
    """Flagship: raw documents to the terms that tell the classes apart."""
    return A.class_top_terms(_centroids(spark, d, "lang"))
