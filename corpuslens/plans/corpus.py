"""The corpora that registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.functions.cleaning import clean_text
from corpuslens.operators.quality import clean_corpus
from corpuslens.operators.split import stratified_split
from corpuslens.sources.tables import keep_table, read_table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents", spread="doc_id")


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Valid, de-duplicated documents, hash-partitioned by document as the semi-join leaves them."""
    return clean_corpus(documents(spark, folder)).select("doc_id", "text", "lang", "source")


def class_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Only the given columns of the corpus, kept: what a split needs moves without the text."""
    return keep_table(corpus(spark, folder).select(*columns))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus with its cleaned text, for plans that read it once."""
    return clean_text(corpus(spark, folder), "text", "clean")


def kept_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned corpus as a table bucketed by document: cleaned once, read by every later pass."""
    return keep_table(cleaned(spark, folder), "doc_id")


def cleaned_split(spark: SparkSession, folder: str, label: str = "lang") -> DataFrame:
    """The kept corpus with its stratified split.

    The split is made from ids and labels only and joined back by document; both tables are bucketed
    alike, so the join moves nothing and needs no sort.
    """
    docs = kept_clean(spark, folder)
    assigned = stratified_split(docs.select("doc_id", label), label=label).select("doc_id", "split")
    return docs.join(keep_table(assigned, "doc_id").hint("shuffle_hash"), "doc_id")


def part(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("split").isin(*names))
