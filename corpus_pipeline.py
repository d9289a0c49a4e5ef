"""From raw documents to packed token windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps or changes, with the
columns of ``documents``; the last returns the pieces of the packed windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read
from corpuslens.llm.cotraining import judge_documents
from corpuslens.llm.line_dedup import drop_shared_lines
from corpuslens.llm.mixing import repeated
from corpuslens.llm.packing import pack
from corpuslens.llm.shingle_join import one_of_each_group


def _set_aside(docs: DataFrame, *results: str) -> tuple[DataFrame, list]:
    """The documents with columns called like the operator's results renamed, and all columns under their own names again."""
    held = {c: f"__own_{c}" for c in docs.columns if c in results}
    return docs.withColumnsRenamed(held), [F.col(held.get(c, c)).alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers reject go."""
    docs, columns = _set_aside(docs, "p_text", "p_meta", "score", "kept")
    return judge_documents(docs, read(spark, sf_dir, "labels")).filter("kept").select(*columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; a document that loses all its lines stays, with an empty text."""
    docs, columns = _set_aside(docs, "kept", "n_lines", "n_dropped")
    cut = drop_shared_lines(docs)
    return cut.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}).select(*columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, Jaccard similarity 0.8."""
    return one_of_each_group(docs, similarity=(8, 10), words=5)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return repeated(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows, as pieces of documents with their ids."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("packing", windows),
]

#: The first and the last stage can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
