"""The registry: names, contracts and a few plans."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries

#: Metrics of iterative fits; see test_shared_fit and test_models.
WITHOUT_SQL = {"experiment_ranking", "comparison_ranking", "optimisation_reports", "embedding_fits_held_out", "confidence_types"}


def test_every_query_has_sql():
    own = {name for name in queries() if name != "pipeline" and not re.match(r"op\d+_", name)} - WITHOUT_SQL
    assert own <= set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    rows = entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"lang", "rank", "term", "mean_w"}


@pytest.mark.parametrize("name", ["doc_lengths", "class_distribution", "label_index"])
def test_scans_read_only_their_columns(spark, name):
    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    assert "n_chars" not in schema
    if name != "doc_lengths":
        assert "text" not in schema


def test_stream_equals_batch(spark):
    from pyspark.sql import functions as F

    from corpuslens.streaming.score_stream import annotate_stream
    from corpuslens.sources.tables import shared_folder

    import uuid

    path = f"{shared_folder(spark)}/s-{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1, "Python and SQL for the C++ team here"), (2, "short")], "doc_id long, text string")
    rows.write.parquet(path)
    stream = annotate_stream(spark.readStream.schema(rows.schema).parquet(path)).select("doc_id", "success", F.array_join("skills", ",").alias("s"))
    name = f"out_{uuid.uuid4().hex}"
    q = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(map(tuple, spark.table(name).collect()))
    assert got == [(1, True, "C++,Python,SQL"), (2, False, "")]
