import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import quality as Q, split as P
from corpuslens.plans.joins import lookup_join, salted_join

LONG = "one two three four five six seven eight nine ten"
ROWS = [
    (1, LONG, "a"), (2, LONG, "b"), (3, LONG, "a"), (4, None, "a"), (5, "   ", "a"), (6, "too short", "b"),
    (7, LONG + " x", "b"), (8, LONG + " x", "b"), (9, LONG + " y", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_invalid_valid_and_corpus(docs):
    assert ids(Q.invalid_docs(docs)) == [4, 5, 6]
    assert ids(Q.valid_docs(docs)) == [1, 2, 3, 7, 8, 9]
    clean = Q.clean_corpus(docs)
    assert ids(clean) == [1, 7, 9]
    assert ids(Q.clean_corpus(clean)) == [1, 7, 9]


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_copies_with_hot_groups_split(docs, hot_rows):
    removed = Q.removed_duplicates(docs.filter("text is not null"), hot_rows=hot_rows)
    assert sorted((r["doc_id"], r["kept_id"]) for r in removed.collect()) == [(2, 1), (3, 1), (8, 7)]
    groups = Q.duplicate_groups(docs.filter("text is not null"), hot_rows=hot_rows)
    assert sorted((r["doc_id"], r["group_id"], r["copies"]) for r in groups.collect()) == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (7, 7, 2), (8, 7, 2)]


def test_label_conflicts_and_accounting(docs):
    got = {r["group_id"]: (r["copies"], r["n_labels"], r["labels"], r["conflict"]) for r in Q.duplicate_label_conflicts(docs.filter("doc_id <> 4")).collect()}
    assert got == {1: (3, 2, "a,b", True), 7: (2, 1, "b", False)}
    steps = [(r["stage"], r["n_rows"], r["delta"]) for r in Q.row_accounting(docs).orderBy("step").collect()]
    assert steps == [("raw", 9, 0), ("valid", 6, -3), ("deduplicated", 3, -3)]


def test_column_audit_counts_nulls(docs):
    got = {r["column_name"]: (r["nulls"], r["distinct_values"]) for r in Q.column_audit(docs).collect()}
    assert got == {"doc_id": (0, 9), "text": (1, 5), "lang": (0, 2)}


def test_salted_join_is_exact_on_a_hot_key(spark):
    big = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    plain = big.join(small, "k").select("id", "k", "n")
    for hot_rows, hot_keys in ((100, 10), (10, 3), (10**6, 10)):
        got = salted_join(big, small, "k", "n", F.col("id"), hot_rows, hot_keys).select("id", "k", "n")
        assert got.exceptAll(plain).count() == 0 and got.count() == 5000


def test_salting_spreads_the_hot_key(spark):
    big = spark.range(4000).select("id", F.lit(7).alias("k"))
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    joined = salted_join(big, small, "k", "n", F.col("id"), hot_rows=100)
    assert joined.count() == 4000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "__piece" in plan


def test_lookup_join_beyond_the_broadcast_limit(spark):
    big = spark.range(200).select("id", (F.col("id") % 4).alias("k"))
    small = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "k long, v string")
    for how in ("inner", "left"):
        want = sorted(map(str, lookup_join(big, small, "k", how).collect()))
        assert sorted(map(str, lookup_join(big, small, "k", how, max_rows=1).collect())) == want


def quotas(counts, share):
    total = sum(counts.values())
    target = math.ceil(round(share * total, 9))
    exact = {k: round(n * target / total, 9) for k, n in counts.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    order = sorted(exact, key=lambda k: (-round(exact[k] - out[k], 9), k))
    for k in order[: target - sum(out.values())]:
        out[k] += 1
    return out


@pytest.mark.parametrize("digits", [1, 2, 4])
@pytest.mark.parametrize("partitions", [1, 5])
def test_split_equals_ranking_each_class(spark, digits, partitions):
    rows = [(i, "abc"[0 if i % 3 else i % 7 % 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, lang string").repartition(partitions)
    got = {r["doc_id"]: r["split"] for r in P.stratified_split(df, bucket_digits=digits).collect()}
    holdout = quotas(Counter(l for _, l in rows), 0.3)
    test = quotas(holdout, 0.5)
    members = defaultdict(list)
    for i, l in rows:
        members[l].append((hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
    want = {}
    for l, m in members.items():
        for rank, (_, i) in enumerate(sorted(m), start=1):
            want[i] = "test" if rank <= test[l] else "val" if rank <= holdout[l] else "train"
    assert got == want
    assert Counter(want.values())["train"] == 280


def test_published_class_counts_give_published_sizes():
    counts = [120, 119, 118, 118, 118, 118, 117, 117, 116, 116, 115, 115, 115, 112, 111, 110, 107, 103, 102, 97, 96, 63, 36, 22]
    holdout = quotas(dict(enumerate(counts)), 0.3)
    assert sum(holdout.values()) == 745
    assert sum(quotas(holdout, 0.5).values()) == 373


def test_ratios_must_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, lang string")
    with pytest.raises(ValueError):
        P.stratified_split(df, train=0.8)


def test_leakage_is_found(spark):
    df = spark.createDataFrame([(1, "t", "train"), (2, "t", "test"), (2, "u", "val")], "doc_id long, text string, split string")
    got = {(r["kind"], r["split_a"], r["split_b"]): r["n_shared"] for r in P.split_leakage(df).collect()}
    assert got[("text", "train", "test")] == 1 and got[("id", "val", "test")] == 1 and sum(got.values()) == 2


def test_null_texts_are_copies_of_each_other(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, None, "a"), (4, "x", "a")], "doc_id long, text string, lang string")
    assert ids(Q.dedup_exact(df)) == [1, 4]
    assert ids(Q.removed_duplicates(df)) == [2, 3]
    assert sorted((r["doc_id"], r["group_id"], r["copies"]) for r in Q.duplicate_groups(df).collect()) == [(1, 1, 3), (2, 1, 3), (3, 1, 3)]


def test_null_labels_are_a_class(spark):
    rows = [(i, "a" if i % 5 else None) for i in range(100)]
    out = P.stratified_split(spark.createDataFrame(rows, "doc_id long, lang string")).collect()
    assert len(out) == 100 and out[0].__fields__ == ["doc_id", "lang", "split"]
    sizes = Counter((r["lang"], r["split"]) for r in out)
    assert sizes == {(None, "train"): 14, (None, "val"): 3, (None, "test"): 3, ("a", "train"): 56, ("a", "val"): 12, ("a", "test"): 12}
