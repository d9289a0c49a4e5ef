"""Profile of a labelled corpus: class balance, lengths, frequent terms, class similarity.

Everything is aggregated before it is ranked: windows only ever see per-class or per-term rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslens.functions.fixed import PROFILE_STOP_WORDS
from corpuslens.operators.linear_scores import MAX_CLASSES, class_labels
from corpuslens.operators.ngrams import count_word_terms, word_term_stats
from corpuslens.operators.tfidf import Vocabulary, count_rows, weigh
from corpuslens.plans.joins import lookup_join
from corpuslens.sources.tables import keep_table

LENGTHS = ("word_len", "char_len")


def _pct(part: Column, whole: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0)), 6)


def class_distribution(df: DataFrame, label: str = "lang") -> DataFrame:
    """Documents per class, share in percent, number of classes."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_docs"))
    everything = Window.partitionBy()  # over the per-class rows only
    return counts.select(
        label,
        "n_docs",
        _pct(F.col("n_docs"), F.sum("n_docs").over(everything)).alias("pct"),
        F.count("*").over(everything).alias("n_classes"),
    )


def class_cumulative(df: DataFrame, label: str = "lang") -> DataFrame:
    """Classes by size with their cumulative share."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_docs"))
    ranked = Window.orderBy(F.desc("n_docs"), label)
    running = F.sum("n_docs").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.select(
        F.row_number().over(ranked).cast("long").alias("rank"),
        label,
        "n_docs",
        _pct(running, F.sum("n_docs").over(Window.partitionBy())).alias("cumulative_pct"),
    )


def class_raw_vs_clean(raw: DataFrame, clean: DataFrame, label: str = "lang") -> DataFrame:
    """Documents per class before and after cleaning; a class may be missing on one side."""
    a = raw.groupBy(label).agg(F.count("*").alias("raw_n"))
    b = clean.groupBy(label).agg(F.count("*").alias("clean_n"))
    joined = a.join(b, a[label].eqNullSafe(b[label]), "full_outer").select(
        F.coalesce(a[label], b[label]).alias(label),
        F.coalesce("raw_n", F.lit(0)).alias("raw_n"),
        F.coalesce("clean_n", F.lit(0)).alias("clean_n"),
    )
    return joined.withColumn("removed", F.col("raw_n") - F.col("clean_n"))


def _per_measure(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Distribution of each measure: ``measure, value, n``. Far smaller than the rows, and exact."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])
    return df.select(F.inline(pairs)).groupBy("measure", "value").agg(F.count("*").alias("n"))


def length_summary(df: DataFrame, measures: Sequence[str] = LENGTHS) -> DataFrame:
    """count, mean, median, sample deviation, quartiles, extremes of each length."""
    return (
        df.select(F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])))
        .groupBy("measure")
        .agg(
            F.count("value").alias("n_docs"),
            F.round(F.avg("value"), 6).alias("mean"),
            F.round(F.stddev_samp("value"), 6).alias("std"),
            F.min("value").alias("min"),
            F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
            F.max("value").alias("max"),
        )
        .select(
            "measure", "n_docs", "mean", "std", "min",
            F.round(F.get("q", F.lit(0)), 6).alias("q25"),
            F.round(F.get("q", F.lit(1)), 6).alias("median"),
            F.round(F.get("q", F.lit(2)), 6).alias("q75"),
            "max",
        )
    )


def length_percentile(df: DataFrame, share: float = 0.99, measures: Sequence[str] = LENGTHS) -> DataFrame:
    """One exact percentile per length, over its distribution."""
    return (
        _per_measure(df, measures)
        .groupBy("measure")
        .agg(F.round(F.percentile("value", F.lit(share), F.col("n")), 6).alias("percentile"))
    )


def sketch_error(k: int) -> float:
    """How far the rank of a sketch's quantile may be off, as a share of the rows, 99 times of 100."""
    return 2.296 / k**0.9723


def length_sketches(df: DataFrame, by: Sequence[str] = (), measures: Sequence[str] = LENGTHS, k: int = 400) -> DataFrame:
    """``by.., measure, sketch``: one mergeable quantile sketch (KLL) per group and length.

    A sketch has a few kilobytes whatever the rows; kept as a table, sketches of new documents are
    merged with the old ones without reading those documents again.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    return df.select(*by, F.inline(pairs)).groupBy(*by, "measure").agg(F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = 400) -> DataFrame:
    """Sketches of several increments as one per group."""
    return sketches.groupBy(*by, "measure").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The sketch column replaced by ``n_docs, share, quantile``, one row per share."""
    cells = [F.struct(F.lit(float(q)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("quantile")) for q in shares]
    kept = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*kept, F.kll_sketch_get_n_double("sketch").alias("n_docs"), F.inline(F.array(*cells)))


def length_histogram(df: DataFrame, measure: str = "word_len", bins: int = 50) -> DataFrame:
    """Equal-width histogram, empty bins included; the last bin is closed on the right."""
    spark = df.sparkSession
    values = df.groupBy(F.col(measure).alias("value")).agg(F.count("*").alias("n"))
    low = values.agg(F.min("value").cast("double")).scalar()
    width = values.agg((F.max("value") - F.min("value")) / F.lit(float(bins))).scalar()
    binned = F.least(F.floor(F.coalesce(F.try_divide(F.col("value") - low, width), F.lit(0.0))), F.lit(bins - 1))
    filled = values.groupBy(binned.cast("long").alias("bin")).agg(F.sum("n").alias("n_docs"))
    return (
        spark.range(bins).withColumnRenamed("id", "bin")
        .join(filled, "bin", "left")
        .select(
            "bin",
            F.round(low + F.col("bin") * width, 6).alias("bin_start"),
            F.coalesce("n_docs", F.lit(0)).alias("n_docs"),
        )
    )


def _class_lengths(df: DataFrame, label: str, measures: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])
    return df.select(label, F.inline(pairs)).groupBy(label, "measure", "value").agg(F.count("*").alias("n"))


def class_length_median(df: DataFrame, label: str = "lang", measure: str = "word_len") -> DataFrame:
    """Median length per class, longest class first."""
    return (
        _class_lengths(df, label, [measure])
        .groupBy(label)
        .agg(F.round(F.percentile("value", F.lit(0.5), F.col("n")), 6).alias("median"), F.sum("n").alias("n_docs"))
        .orderBy(F.desc("median"), label)
    )


def class_length_boxplot(df: DataFrame, label: str = "lang", measures: Sequence[str] = LENGTHS) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR of the box) and outliers per class and length."""
    lengths = _class_lengths(df, label, measures)
    box = (
        lengths.groupBy(label, "measure")
        .agg(F.percentile("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"))
        .select(
            label, "measure",
            F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("median"), F.get("q", F.lit(2)).alias("q75"),
        )
        .withColumn("low_fence", F.col("q25") - 1.5 * (F.col("q75") - F.col("q25")))
        .withColumn("high_fence", F.col("q75") + 1.5 * (F.col("q75") - F.col("q25")))
    )
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return (
        lookup_join(lengths, box, [label, "measure"])
        .groupBy(label, "measure")
        .agg(
            F.round(F.first("q25"), 6).alias("q25"),
            F.round(F.first("median"), 6).alias("median"),
            F.round(F.first("q75"), 6).alias("q75"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )


def top_ngrams(
    df: DataFrame,
    n: int,
    k: int = 30,
    id_col: str = "doc_id",
    text: str = "clean",
    stop_words: Sequence[str] = PROFILE_STOP_WORDS,
    min_df: int = 3,
) -> DataFrame:
    """The k most frequent n-word terms. Stop words go first, so an n-gram may bridge one."""
    stats = word_term_stats(df, text, n, n, min_len=2, stop_words=stop_words)
    return stats.select("term", "cf", "df").filter(F.col("df") >= min_df).orderBy(F.desc("cf"), "term").limit(k)


def seeded_sample(df: DataFrame, n: int, id_col: str = "doc_id", seed: str = "42") -> DataFrame:
    """At most n documents, the same ones for the same seed on any layout: smallest keyed hashes.

    The top-n runs on ids alone; the texts are fetched for the n survivors (a bounded broadcast).
    """
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
    chosen = df.select(F.col(id_col)).orderBy(key, id_col).limit(n)
    return df.join(F.broadcast(chosen), id_col, "left_semi")


def term_frequencies(
    df: DataFrame,
    k: int,
    id_col: str = "doc_id",
    text: str = "clean",
    stop_words: Sequence[str] = PROFILE_STOP_WORDS,
) -> DataFrame:
    """The k most frequent words."""
    counts = count_word_terms(df, id_col, text, 1, 1, min_len=2, stop_words=stop_words)
    return counts.groupBy("term").agg(F.sum("tf").alias("cf")).orderBy(F.desc("cf"), "term").limit(k)


def class_term_frequencies(
    df: DataFrame,
    classes: Sequence[str],
    k: int = 100,
    id_col: str = "doc_id",
    text: str = "clean",
    label: str = "lang",
    stop_words: Sequence[str] = PROFILE_STOP_WORDS,
) -> DataFrame:
    """The k most frequent words of each of the given classes."""
    chosen = df.filter(F.col(label).isin(list(classes)))
    counts = count_word_terms(chosen, id_col, text, 1, 1, min_len=2, stop_words=stop_words, keep=[label])
    totals = counts.groupBy(label, "term").agg(F.sum("tf").alias("cf"))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(F.desc("cf"), "term"))
    # Rank <= k is cut inside each map task before the shuffle, so a hot class stays small.
    return totals.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k)


def class_centroids(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "clean",
    label: str = "lang",
    max_features: int | None = 5000,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """Mean TF-IDF weight per (class, term); documents without the term count as zero."""
    counts = count_word_terms(df, id_col, text, 1, 1, min_len=2, stop_words=stop_words, keep=[label])
    vocabulary = Vocabulary.fit(counts, count_rows(df), min_df=1, max_df=1.0, max_features=max_features)
    weights = weigh(counts, vocabulary, id_col, keep=[label])
    sizes = df.groupBy(label).agg(F.count("*").alias("class_docs"))
    sums = weights.groupBy(label, "term").agg(F.sum("w").alias("sum_w"))
    return lookup_join(sums, sizes, label).select(
        label, "term", (F.col("sum_w") / F.col("class_docs")).alias("mean_w")
    )


#: Terms that are multiplied at a time.
TERM_BLOCK = 4096


def class_similarity(centroids: DataFrame, label: str = "lang", max_classes: int = MAX_CLASSES) -> DataFrame:
    """Cosine of every pair of class centroids, both orders and the diagonal.

    Terms are dealt to tasks and packed into blocks of terms by classes; a block is multiplied with
    itself, and the products add up to one matrix a task. More than ``max_classes`` classes are refused,
    which bounds that matrix.
    """
    labels = class_labels(centroids, label, max_classes)
    n = len(labels)
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)).cast("int") - 1
    cells = centroids.filter(F.col(label).isNotNull()).select("term", position.alias("class"), F.col("mean_w").cast("double").alias("w"))
    dealt = cells.repartition("term").sortWithinPartitions("term")

    def multiplied(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((n, n))
        block, row, last = np.zeros((TERM_BLOCK, n)), -1, None
        for batch in batches:
            for term, k, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if term != last:
                    last, row = term, row + 1
                    if row == TERM_BLOCK:
                        total += block.T @ block
                        block[:], row = 0.0, 0
                block[row, k] = w
        total += block.T @ block
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype("int32")), pa.array(b.astype("int32")), pa.array(total[a, b])], names=["a", "b", "dot"])

    dots = keep_table(dealt.mapInArrow(multiplied, "a int, b int, dot double").groupBy("a", "b").agg(F.sum("dot").alias("dot")))
    norm = dots.filter("a = b").select("a", F.sqrt("dot").alias("norm"))
    norms = [norm.withColumnsRenamed({"a": side, "norm": f"norm_{side}"}) for side in "ab"]
    shared = dots.join(F.broadcast(norms[0]), "a").join(F.broadcast(norms[1]), "b")
    names = F.array(*[F.lit(v) for v in labels])
    # classes without a term in common have no row, as their product is empty
    return shared.select(
        F.get(names, F.col("a")).alias("class_a"), F.get(names, F.col("b")).alias("class_b"), F.round(F.col("dot") / (F.col("norm_a") * F.col("norm_b")), 6).alias("cosine")
    )


def top_similar_classes(similarity: DataFrame, k: int = 10) -> DataFrame:
    """The k most similar pairs of different classes, each pair once."""
    return (
        similarity.filter(F.col("class_a") < F.col("class_b"))
        .orderBy(F.desc("cosine"), "class_a", "class_b")
        .limit(k)
    )


def class_top_terms(centroids: DataFrame, k: int = 10, label: str = "lang") -> DataFrame:
    """The k heaviest terms of each class centroid. Ties go by term; weights are compared at 9 digits
    so that the summation order cannot change the ranking."""
    weight = F.round(F.col("mean_w"), 9)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(weight.desc(), "term"))
    return (
        centroids.withColumn("rank", rank.cast("long"))
        .filter(F.col("rank") <= k)
        .select(label, "rank", "term", F.round("mean_w", 6).alias("mean_w"))
    )
