"""Scoring on a stream: the batch results by projections alone, without state, so it runs in append mode on any source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from corpuslens.functions.cleaning import clean_text
from corpuslens.operators.linear_scores import LinearTextModel
from corpuslens.operators.scoring import score_rows, validate_inputs, with_tags


def annotate_stream(stream: DataFrame, text: str = "text") -> DataFrame:
    """Clean, check and tag each document: a projection, valid on batch and streaming input alike."""
    return with_tags(validate_inputs(clean_text(stream, text, "clean"), text), text)


def scored_stream(stream: DataFrame, model: LinearTextModel, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Class, confidence and top classes of each document, as a projection."""
    return score_rows(clean_text(stream, text, "clean"), model, id_col, text)


def score_stream(
    stream: DataFrame, model: LinearTextModel, out: str, checkpoint: str, id_col: str = "doc_id", text: str = "text"
) -> StreamingQuery:
    """Score every available document and append to the parquet table ``out``, each exactly once."""
    return (
        scored_stream(stream, model, id_col, text)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
