"""Deterministic stratified split with exact sizes, and the checks around it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslens.operators.quality import text_key
from corpuslens.plans.joins import lookup_join

# Hash buckets per class. A class is never sorted as a whole: only the bucket a cut falls into is.
BUCKET_DIGITS = 4


def split_hash(id_col: str, seed: str = "42") -> Column:
    """The random order of the documents: a keyed hash of the id, the same on any layout."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def _quota(counts: DataFrame, label: str, n_col: str, share: Column, out: str) -> DataFrame:
    """Distribute ``ceil(share * total)`` over the classes by largest remainder (ties by label)."""
    everything = Window.partitionBy()
    total = F.sum(n_col).over(everything)
    # The share is rounded first: 0.3 * 10 must be 3, not 4.
    target = F.ceil(F.round(share * total, 9))
    exact = F.round(F.col(n_col) * target / total, 9)
    counts = counts.withColumn("__target", target).withColumn("__exact", exact)
    floor = F.floor("__exact")
    counts = counts.withColumn("__rest", F.col("__target") - F.sum(floor).over(everything))
    rank = F.row_number().over(Window.orderBy(F.round(F.col("__exact") - floor, 9).desc(), label))
    bonus = F.when(rank <= F.col("__rest"), 1).otherwise(0)
    return counts.withColumn(out, (floor + bonus).cast("long")).drop("__target", "__exact", "__rest")


def split_quotas(
    counts: DataFrame, label: str = "lang", train: float = 0.70, val: float = 0.15, test: float = 0.15
) -> DataFrame:
    """From ``(label, n)``: documents held out from training, and how many of those are for the test."""
    if abs(train + val + test - 1.0) > 1e-8:
        raise ValueError("Split ratios must sum to 1.0")
    held_out = _quota(counts, label, "n", F.lit(val + test), "n_holdout")
    return _quota(held_out, label, "n_holdout", F.lit(test / (val + test)), "n_test")


def stratified_split(
    df: DataFrame,
    id_col: str = "doc_id",
    label: str = "lang",
    train: float = 0.70,
    val: float = 0.15,
    test: float = 0.15,
    seed: str = "42",
    bucket_digits: int = BUCKET_DIGITS,
) -> DataFrame:
    """Add ``split``: in hash order each class gives its first documents to the test, the next to the
    validation set and the rest to training; sizes are exact.

    Equal to ranking each class by hash, without sorting a class in one task: per (class, hash
    bucket) counts locate the bucket each cut falls into. Documents in other buckets are decided
    where they are; only the cut buckets, a 16^-digits share of a class, are ranked. ``df`` is read
    three times: keep it, or write it to a table, when it is costly to make. Rows without a label are
    a class of their own, the first in label order.
    """
    # as a struct, a null label equals itself in joins
    named, label = label, "__label"
    df = df.withColumn(label, F.struct(named))
    buckets = df.select(label, _bucket(split_hash(id_col, seed), bucket_digits).alias("__bucket"))
    # At most classes x 16^digits rows: kept, because the quotas and the cuts both come from it.
    counts = buckets.groupBy(label, "__bucket").agg(F.count("*").alias("__n")).persist()
    up_to = F.sum("__n").over(Window.partitionBy(label).orderBy("__bucket"))
    filled = counts.select(label, "__bucket", (up_to - F.col("__n")).alias("__before"), up_to.alias("__up_to"))
    sizes = counts.groupBy(label).agg(F.sum("__n").alias("n"))
    quotas = lookup_join(filled, split_quotas(sizes, label, train, val, test), label)

    def cut(quota: str) -> Column:
        holds = (F.col("__before") < F.col(quota)) & (F.col(quota) <= F.col("__up_to"))
        return F.max(F.when(holds, F.struct(F.col("__bucket").alias("b"), (F.col(quota) - F.col("__before")).alias("need"))))

    cuts = quotas.groupBy(label).agg(cut("n_test").alias("__test"), cut("n_holdout").alias("__holdout"))
    rows = df.withColumn("__hash", split_hash(id_col, seed)).withColumn("__bucket", _bucket(F.col("__hash"), bucket_digits))
    rows = lookup_join(rows, cuts, label)

    bucket, none = F.col("__bucket"), F.lit(-1)
    test_b, hold_b = F.coalesce("__test.b", none), F.coalesce("__holdout.b", none)
    is_cut = (bucket == test_b) | (bucket == hold_b)
    by_bucket = F.when(bucket < test_b, "test").when(bucket < hold_b, "val").otherwise("train")
    decided = rows.filter(~is_cut).withColumn("split", by_bucket)

    rank = F.row_number().over(Window.partitionBy(label, "__bucket").orderBy("__hash", id_col))
    in_test = (bucket < test_b) | ((bucket == test_b) & (F.col("__rank") <= F.col("__test.need")))
    in_hold = (bucket < hold_b) | ((bucket == hold_b) & (F.col("__rank") <= F.col("__holdout.need")))
    ranked = rows.filter(is_cut).withColumn("__rank", rank)
    ranked = ranked.withColumn("split", F.when(in_test, "test").when(in_hold, "val").otherwise("train"))
    return decided.unionByName(ranked.drop("__rank")).drop("__hash", "__bucket", "__test", "__holdout", label)


def _bucket(hashed: Column, digits: int) -> Column:
    return F.conv(F.substr(hashed, F.lit(1), F.lit(digits)), 16, 10).cast("int")


def split_sizes(df: DataFrame) -> DataFrame:
    """Documents and share per split."""
    counts = df.groupBy("split").agg(F.count("*").alias("n_docs"))
    share = F.col("n_docs") * 100.0 / F.sum("n_docs").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(share, 6))


def split_class_shares(df: DataFrame, label: str = "lang") -> DataFrame:
    """Documents of each class per split, and the class's share inside each split."""
    wide = df.groupBy(label).pivot("split", ["train", "val", "test"]).count().fillna(0)
    everything = Window.partitionBy()
    shares = [
        F.round(F.coalesce(F.try_divide(F.col(s) * 100.0, F.sum(s).over(everything)), F.lit(0.0)), 6).alias(f"{s}_pct")
        for s in ("train", "val", "test")
    ]
    return wide.select(label, "train", "val", "test", *shares)


def split_leakage(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and texts that two splits share; all six counts are 0 for a sound split.

    One aggregate per key: splits seen per id (or text hash), so copies collapse before the shuffle.
    """
    pairs = [("train", "val"), ("train", "test"), ("val", "test")]
    parts = None
    for kind, key in (("id", F.col(id_col).cast("string")), ("text", text_key(text))):
        seen = df.select(key.alias("__key"), "split").groupBy("__key").agg(
            *[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "val", "test")]
        )
        row = seen.agg(*[F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}_{b}") for a, b in pairs])
        part = row.select(
            F.lit(kind).alias("kind"),
            F.inline(
                F.array(*[F.struct(F.lit(a).alias("split_a"), F.lit(b).alias("split_b"), F.col(f"{a}_{b}").alias("n_shared")) for a, b in pairs])
            ),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def union_train_val(df: DataFrame) -> DataFrame:
    """Training and validation rows as one set: the input of the final model."""
    return df.filter(F.col("split") == "train").unionByName(df.filter(F.col("split") == "val"))


def label_index(df: DataFrame, label: str = "lang") -> DataFrame:
    """Classes in alphabetical order with their index, from 0."""
    classes = df.select(label).distinct()
    return classes.withColumn("label_index", F.row_number().over(Window.orderBy(label)).cast("long") - 1)


def class_weights(df: DataFrame, label: str = "lang") -> DataFrame:
    """Balanced class weights: documents / (classes * documents of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n_docs"))
    everything = Window.partitionBy()
    weight = F.sum("n_docs").over(everything) / (F.count("*").over(everything) * F.col("n_docs"))
    return counts.withColumn("class_weight", F.round(weight, 6))
