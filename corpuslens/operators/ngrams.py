"""Term counts per document, in long form ``(id, term, tf)``: words, word n-grams, character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from corpuslens.functions.counting import Count, count_characters, count_words, counts_by_text, sums_by_term, weights_by_text
from corpuslens.functions.fixed import EMBEDDING_PREFIX
from corpuslens.functions.text import pad_words, spaced_words, squeeze_spaces


#: What a document's terms are counted into.
COUNTS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]))


WEIGHTS = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("w", T.DoubleType())]))


def _in_row(text: Column, lists, kind: T.DataType) -> Column:
    @F.arrow_udf(kind)
    def listed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return lists(texts)

    return listed(text)


def _inlined(df: DataFrame, id_col: str, text: Column, lists, kind: T.DataType, keep: Sequence[str]) -> DataFrame:
    terms = df.select(id_col, *keep, text.alias("__text")).select(id_col, *keep, _in_row(F.col("__text"), lists, kind).alias("__terms"))
    # of a plain column Spark infers that it is not empty, and counts every text a second time below the joins to see that
    return terms.select(id_col, *keep, F.inline(F.coalesce("__terms", F.array().cast(kind))))


def _rows(df: DataFrame, id_col: str, text: Column, count: Count, keep: Sequence[str]) -> DataFrame:
    """A document's terms are counted where the document is: no shuffle, no row per occurrence."""
    return _inlined(df, id_col, text, counts_by_text(count), COUNTS, keep)


def weigh_in_row(df: DataFrame, id_col: str, text: Column, count: Count, vocabulary: pa.Table, sublinear: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, term, w)``: TF-IDF by a bounded vocabulary ``term, idf``, normalised where the document is."""
    return _inlined(df, id_col, text, weights_by_text(count, vocabulary, sublinear), WEIGHTS, keep)


def _sums(df: DataFrame, text: Column, count: Count) -> DataFrame:
    """``term, df, cf`` over all documents: tasks sum many documents before anything is shuffled."""
    sums = df.select(text.alias("__text")).mapInArrow(sums_by_term(count), "term string, df long, cf long")
    return sums.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _words(text: str, lo: int, hi: int, min_len: int, stop_words: Sequence[str]) -> tuple[Column, Count]:
    return spaced_words(F.lower(F.col(text))), count_words(lo, hi, min_len, tuple(stop_words))


def count_word_terms(
    df: DataFrame,
    id_col: str,
    text: str,
    lo: int = 1,
    hi: int = 1,
    min_len: int = 1,
    stop_words: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Word n-grams per document. ``keep`` columns are carried along."""
    return _rows(df, id_col, *_words(text, lo, hi, min_len, stop_words), keep)


def word_term_stats(df: DataFrame, text: str, lo: int = 1, hi: int = 1, min_len: int = 1, stop_words: Sequence[str] = ()) -> DataFrame:
    """``term, df, cf`` of word n-grams."""
    return _sums(df, *_words(text, lo, hi, min_len, stop_words))


def count_char_terms(
    df: DataFrame, id_col: str, text: str, lo: int = 3, hi: int = 5, keep: Sequence[str] = ()
) -> DataFrame:
    """Character n-grams per document, spaces included."""
    return _rows(df, id_col, squeeze_spaces(F.lower(F.col(text))), count_characters(lo, hi), keep)


def char_term_stats(df: DataFrame, text: str, lo: int = 3, hi: int = 5) -> DataFrame:
    """``term, df, cf`` of character n-grams, spaces included."""
    return _sums(df, squeeze_spaces(F.lower(F.col(text))), count_characters(lo, hi))


def count_char_wb_terms(
    df: DataFrame, id_col: str, text: str, lo: int = 3, hi: int = 5, keep: Sequence[str] = ()
) -> DataFrame:
    """Character n-grams inside space-padded words, per document."""
    return _rows(df, id_col, pad_words(F.lower(F.col(text))), count_characters(lo, hi, lines=True), keep)


def char_wb_term_stats(df: DataFrame, text: str, lo: int = 3, hi: int = 5) -> DataFrame:
    """``term, df, cf`` of character n-grams inside space-padded words."""
    return _sums(df, pad_words(F.lower(F.col(text))), count_characters(lo, hi, lines=True))


def truncate_text(df: DataFrame, text: str = "text", n: int = EMBEDDING_PREFIX) -> DataFrame:
    """First ``n`` characters of the text, for encoders with a bounded input."""
    return df.withColumn(text, F.substr(F.col(text), F.lit(1), F.lit(n)))
