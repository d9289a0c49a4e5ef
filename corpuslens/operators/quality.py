"""Audit, filter and exact de-duplication of a labelled corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuslens.functions.fixed import MIN_WORDS
from corpuslens.functions.text import char_count, has_words, is_blank, word_count
from corpuslens.plans.joins import HOT_ROWS, salted_join


def with_lengths(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``char_len`` and ``word_len``."""
    return df.withColumn("char_len", char_count(text)).withColumn("word_len", word_count(text))


def is_invalid(text: str = "text", min_words: int = MIN_WORDS) -> Column:
    """Blank, or fewer than ``min_words`` words. A null text is invalid; the result is never null."""
    return is_blank(text) | ~has_words(text, min_words)


def invalid_docs(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    return df.filter(is_invalid(text, min_words))


def valid_docs(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    return df.filter(~is_invalid(text, min_words))


def text_key(text: str = "text") -> Column:
    """The text as a short key: only this is shuffled, never the text, when copies are looked for.

    Null texts are copies of each other; their key is empty."""
    return F.coalesce(F.sha2(F.col(text), 256), F.lit(""))


def _copies(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per text: ``text_key, kept_id, copies``. Aggregated on the map side, so the copies of a
    hot text collapse before the shuffle."""
    return (
        df.select(F.col(id_col), text_key(text).alias("text_key"))
        .groupBy("text_key")
        .agg(F.min(id_col).alias("kept_id"), F.count("*").alias("copies"))
    )


def dedup_exact(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep the row with the smallest id of each distinct text. ``id_col`` must be unique.

    Survivors are found on (id, hash) and fetched by a semi-join on the unique id: neither step has a
    hot key, whatever the sizes of the groups of copies.
    """
    survivors = _copies(df, id_col, text).select(F.col("kept_id").alias(id_col))
    return df.join(survivors, id_col, "left_semi")


def _in_copy_groups(
    df: DataFrame, id_col: str, text: str, columns: list[Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    groups = _copies(df, id_col, text).filter("copies > 1")
    rows = df.select(F.col(id_col), *columns, text_key(text).alias("text_key"))
    return salted_join(rows, groups, "text_key", "copies", F.col(id_col), hot_rows)


def removed_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    snippet: int = 60,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows that :func:`dedup_exact` drops, with the id they are a copy of."""
    short = F.substr(F.col(text), F.lit(1), F.lit(snippet)).alias("snippet")
    rows = _in_copy_groups(df, id_col, text, [F.col(label), short], hot_rows)
    return rows.filter(F.col(id_col) != F.col("kept_id")).select(id_col, label, "kept_id", "snippet")


def duplicate_groups(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All members of groups of copies, with the group's smallest id and size."""
    rows = _in_copy_groups(df, id_col, text, [F.col(label)], hot_rows)
    return rows.select(id_col, label, F.col("kept_id").alias("group_id"), "copies")


def duplicate_label_conflicts(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang"
) -> DataFrame:
    """Groups of copies: how many labels they carry and which. The set is bounded by the classes."""
    return (
        df.select(F.col(id_col), F.col(label), text_key(text).alias("text_key"))
        .groupBy("text_key", label)
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("n"))
        .groupBy("text_key")
        .agg(
            F.min("first_id").alias("group_id"),
            F.sum("n").alias("copies"),
            F.count(label).alias("n_labels"),
            F.array_join(F.sort_array(F.collect_set(label)), ",").alias("labels"),
        )
        .filter("copies > 1")
        .select("group_id", "copies", "n_labels", "labels", (F.col("n_labels") > 1).alias("conflict"))
    )


def row_accounting(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Rows after each cleaning step and the change against the step before."""
    valid = ~is_invalid(text, min_words)
    totals = df.agg(
        F.count("*").alias("raw"),
        F.count_if(valid).alias("valid"),
        F.count_distinct(F.when(valid, text_key(text))).alias("deduplicated"),
    )
    steps = totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).cast("long").alias("step"), F.lit(name).alias("stage"), F.col(name).alias("n_rows"), delta.alias("delta"))
                    for i, (name, delta) in enumerate(
                        [
                            ("raw", F.lit(0).cast("long")),
                            ("valid", F.col("valid") - F.col("raw")),
                            ("deduplicated", F.col("deduplicated") - F.col("valid")),
                        ],
                        start=1,
                    )
                ]
            )
        )
    )
    return steps


def column_audit(df: DataFrame) -> DataFrame:
    """Per column: type, nulls, null share and distinct values.

    One aggregate per column, each reading that column only: several distinct counts in a single
    aggregate would copy every row once per column. Long values are counted by their hash.
    """
    parts = None
    for field in df.schema.fields:
        value = F.col(field.name)
        if field.dataType.typeName() == "string":
            value = F.sha2(value, 256)
        part = df.agg(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.count_if(F.col(field.name).isNull()).alias("nulls"),
            F.round(F.coalesce(F.try_divide(F.count_if(F.col(field.name).isNull()) * 100.0, F.count("*")), F.lit(0.0)), 6).alias("null_pct"),
            F.count_distinct(value).alias("distinct_values"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def clean_corpus(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Valid rows, one per distinct text: the corpus every later step starts from."""
    return dedup_exact(valid_docs(df, text, min_words), id_col, text)
