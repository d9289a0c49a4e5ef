"""Text files: one per document, written at their last names by the tasks."""

import os

from corpuslens.plans import corpus_queries as Q
from corpuslens.sources import tables as IO

ROWS = [(1, "é ü €\n😀 x", "a/b %=ü", "de"), (2, "é ü €\n😀 x", "s 1+", "de"), (3, None, None, "en"), (4, "", "", "en"), (-5, " plain ", "s", "fr"), (None, "x", "s", "fr")]


def test_files_of_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.source, r.n_words, r.n_chars) for r in Q.ingest_text_files(spark, str(tmp_path)).collect()}
    none = "__HIVE_DEFAULT_PARTITION__"
    assert got == {1: ("a/b %=ü", 5, 9), 2: ("s 1+", 5, 9), 3: (none, 0, 0), 4: (none, 0, 0), -5: ("s", 1, 5)}
    path = f"{tmp_path}/files"
    Q._write_files(docs, path)
    text = {r.path.rsplit("=", 1)[1]: r.text for r in IO.read_text_files(spark, path).collect()}
    assert text["1.txt"] == "é ü ? ? x" and text["2.txt"] == "é ü € 😀 x"


def test_no_folder_for_a_file_alone(spark, tmp_path):
    docs = spark.range(300).selectExpr("id as doc_id", "'some text' as text", "'s' as source", "'en' as lang")
    Q._write_files(docs, f"{tmp_path}/files")
    found = [(folder, names) for folder, _, names in os.walk(f"{tmp_path}/files") if names]
    assert len(found) == 2 and sum(len(names) for _, names in found) == 300
    assert IO.write_text_files(docs.limit(0).selectExpr("'a/b' as name", "cast('x' as binary) as content"), f"{tmp_path}/none") == 0
