import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import cleaning as C, text as X

CASES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    (
        "Expert in C++, C#, .NET, Python, SQL, and Docker. Contact: test@example.com, https://github.com",
        "expert in cplusplus csharp dotnet python sql and docker contact emailaddr weburl",
    ),
    ("a \n b", "a   b"),
    ("R&amp;D <b>lead</b>", "r d lead"),
    ("résumé", "re sume"),
    ("asp.net", "aspdotnet"),
    ("xc++ y", "xc y"),
    ("c++ c++ x", "cplusplus cplusplus x"),
    ("(555) 123-4567", "phonenum"),
    ("555.123.4567 and 5551234567", "phonenum and phonenum"),
    ("www.x.y/z", "weburl"),
    ("snake_case", "snake_case"),
    ("• one – two — three", "one two three"),
    ("ﬁne &eacute;t&eacute; ½", "fine e te 1 2"),
    ("日本語 text", "日本語 text"),
    ("a  b\x1cc", "a b\x1cc"),
]


@pytest.mark.parametrize("partitions", [1, 4])
def test_cleaner_literals(spark, partitions):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(partitions)
    got = {r["id"]: r["clean"] for r in C.clean_text(df, "text", "clean").collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_cleaner_keeps_case_on_request(spark):
    df = spark.createDataFrame([("Ab c++ D",)], "text string")
    assert C.clean_text(df, "text", "clean", lower=False).first()["clean"] == "Ab cplusplus D"


def test_cleaner_leaves_no_punctuation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for (clean,) in C.clean_text(docs, "text", "clean").select("clean").collect():
        assert re.fullmatch(r"[\w\s]*", clean)
        assert clean == clean.strip()
        assert not any(unicodedata.combining(ch) for ch in clean)


def test_transformer_round_trip(spark, tmp_path):
    stage = C.TextCleaner(inputCol="t", outputCol="c", lower=False)
    stage.save(str(tmp_path / "cleaner"))
    loaded = C.TextCleaner.load(str(tmp_path / "cleaner"))
    assert loaded.transform(spark.createDataFrame([("A & b",)], "t string")).first()["c"] == "A b"


def test_space_and_word_classes_equal_python(spark):
    """Every code point below U+3100, once, against Python's own classes."""
    points = [cp for cp in range(1, 0x3100)]
    df = spark.createDataFrame([(cp, chr(cp)) for cp in points], "cp int, c string")
    got = df.select("cp", F.col("c").rlike(f"{X.UNICODE}[{X.SPACE}]").alias("s"), X.strip("c").alias("stripped")).collect()
    for r in got:
        assert r["s"] == chr(r["cp"]).isspace(), hex(r["cp"])
        assert (r["stripped"] == "") == chr(r["cp"]).isspace(), hex(r["cp"])


def test_word_counts(spark):
    texts = ["", " a  b ", "one two\x1cthree", "x" * 50, " ".join("w" * 3 for _ in range(12))]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    rows = df.select("t", X.word_count("t").alias("n"), X.has_words("t", 10).alias("ten"), X.is_blank("t").alias("blank")).collect()
    for r in rows:
        words = len((r["t"] or "").split())
        assert (r["n"], r["ten"], r["blank"]) == (words, words >= 10, words == 0)


def test_preview_and_display(spark):
    df = spark.createDataFrame([("HUMAN-RESOURCES", "abcdef")], "l string, t string")
    row = df.select(X.display_label("l").alias("l"), X.preview("t", 3).alias("p"), X.preview("t", 6).alias("q")).first()
    assert tuple(row) == ("Human Resources", "abc...", "abcdef")
