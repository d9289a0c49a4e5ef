"""Sources mixed to target weights by weighted sampling without replacement.

Every document gets an exponential key, scaled by its quality weight (Efraimidis and Spirakis): the
documents with the smallest keys of a source are a weighted sample of any size. A source first takes
its complete epochs, then the documents in key order up to what is left of its budget. Prefix sums are
taken over key ranges first, and document by document only in the one range where a budget ends, so no
task orders a whole source. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpuslens.llm.common import Scratch, WORD, count_words, read, with_small
from corpuslens.llm.registry import query

WEIGHTS = (3, 1, 2)
SYMBOLS = "[#*$%&|<>!0-9]"
#: Key ranges: so many to one unit of the key, and in all.
RANGES, LAST_RANGE = 1024, 65_535
SEED = "mix"


def quality_weight(text: Column) -> Column:
    """1 for plain text, less by the fourth power of the share of signs and digits, 0.05 at least."""
    n = F.length(text)
    plain = (n - F.regexp_count(text, F.lit(SYMBOLS))) / n
    return F.when(n > 0, F.greatest(F.lit(0.05), plain * plain * plain * plain)).otherwise(F.lit(1.0))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight, with u in (0, 1) from the MD5 of seed and id: the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``source_key, source_size, target`` from ``source_key, source_size``, one row per source.

    Sources in code point order, null last, take the weights in turn. They share ``share`` times all
    sizes (a fraction) by weight; none gets more than ``most`` times its size, and what is above goes to
    the others by weight, again and again: sorted by size per weight, a prefix of the sources is full.
    The windows hold one row per source.
    """
    num, den = share
    by_name = Window.orderBy("source_key")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", weight.cast("long"))
    filled = Window.orderBy(F.col("source_size") / F.col("w"), "source_key")
    rows = rows.select(
        "*",
        F.sum("source_size").over(Window.partitionBy()).alias("total"),
        (F.sum("source_size").over(filled) - F.col("source_size")).alias("before"),
        (F.sum("w").over(Window.partitionBy()) - F.sum("w").over(filled) + F.col("w")).alias("w_left"),
    )
    # all in units of 1 / den, so that the comparison is exact
    left = F.lit(num) * F.col("total") - F.lit(den * most) * F.col("before")
    rows = rows.withColumn("left", left).withColumn("full", F.col("w") * left > F.lit(den * most) * F.col("source_size") * F.col("w_left"))
    everywhere = Window.partitionBy()
    # "before" grows along the order, so the first open source has the largest "left" and "w_left"
    open_left = F.max(F.when(~F.col("full"), F.col("left"))).over(everywhere)
    open_w = F.max(F.when(~F.col("full"), F.col("w_left"))).over(everywhere)
    target = F.when(F.col("full"), F.col("source_size") * F.lit(float(most))).otherwise(F.col("w") * (open_left / F.lit(float(den))) / open_w)
    return rows.select("source_key", "source_size", target.cast("double").alias("target"))


def _keyed(docs: DataFrame, seed: str) -> DataFrame:
    """The documents with ``size, key, source_key`` and ``slot``, the range their key falls in."""
    key = sampling_key(F.col("doc_id"), quality_weight(F.col("text")), seed)
    source_key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    rows = docs.select("*", count_words(F.col("text")).alias("size"), key.alias("key"), source_key.alias("source_key"))
    return rows.withColumn("slot", F.least(F.floor(F.col("key") * RANGES), F.lit(LAST_RANGE)).cast("int"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2, seed: str = SEED, texts: bool = False
) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, part, taken``, one row per document row.

    ``size`` is the number of words, 0 for a null text; ``epochs`` whole copies and ``part`` more words
    are taken, so that the words of a source add up to its target, rounded down; one document per source
    is taken in part. Null sources are one source. Equal ids have equal keys, and ties go by size;
    a null id has a key like any other. With ``texts`` all columns of the documents come along, but those
    named like a result; of the texts only those in the range where a budget ends are moved.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    docs = docs.drop("size", "key", "source_key", "slot", "source_size", "target", "epochs", "part", "taken", "rest", "end_slot", "end_before")
    rows = scratch.keep(_keyed(docs.select("doc_id", "source", "text"), seed).drop("text"))

    slots = scratch.keep(rows.groupBy("source_key", "slot").agg(F.sum("size").alias("n")))
    sizes = slots.groupBy("source_key").agg(F.sum("n").alias("source_size"))
    goals = source_targets(sizes, weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goals = goals.withColumn("epochs", epochs).withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    so_far = F.sum("n").over(Window.partitionBy("source_key").orderBy("slot"))
    ends = slots.withColumn("upto", so_far).join(goals.select("source_key", "rest"), "source_key").filter("upto > rest")
    ends = ends.groupBy("source_key").agg(F.min("slot").alias("end_slot"), F.min_by(F.col("upto") - F.col("n"), "slot").alias("end_before"))
    goals = scratch.keep(goals.join(ends, "source_key", "left"))

    rows = with_small(_keyed(docs, seed) if texts else rows, goals, ["source_key"])
    at_end = F.coalesce(F.col("slot") == F.col("end_slot"), F.lit(False))
    before = F.sum("size").over(Window.partitionBy("source_key").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("rest") - F.col("end_before") - F.coalesce(before, F.lit(0))
    inside = rows.filter(at_end).withColumn("part", F.least(F.greatest(left, F.lit(0)), "size"))
    chosen = (F.col("rest") > 0) & (F.col("end_slot").isNull() | (F.col("slot") < F.col("end_slot")))
    outside = rows.filter(~at_end).withColumn("part", F.when(chosen, F.col("size")).otherwise(F.lit(0)).cast("long"))
    taken = F.col("epochs") * F.col("size") + F.col("part")
    columns = docs.columns if texts else ["doc_id", "source"]
    return inside.unionByName(outside).select(*columns, "size", "source_size", "target", "epochs", "part", taken.alias("taken"))


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves, each row as often as it is taken; the one taken in part is whole or not, whichever is nearer."""
    mixed = mix(docs.select("doc_id", "source", "text", F.struct("*").alias("__row")), texts=True, **options)
    copies = F.col("epochs") + ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("int")
    each = F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int")))
    return mixed.select("__row", F.explode(each)).select("__row.*")


SQL = f"""
WITH plain AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    CASE WHEN length(text) > 0 THEN (length(text) - len(regexp_extract_all(text, '{SYMBOLS}'))) / length(text) END AS p,
    (('0x' || md5('{SEED}|' || coalesce(doc_id::VARCHAR, 'null'))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), keyed AS (SELECT doc_id, source, size, -ln(u) / coalesce(greatest(0.05::DOUBLE, p * p * p * p), 1.0::DOUBLE) AS key FROM plain
), sizes AS (SELECT source, sum(size)::BIGINT AS s FROM keyed GROUP BY source
), weighed AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1] AS w FROM sizes
), filling AS (
  SELECT *, sum(s) OVER () AS total, sum(s) OVER o - s AS before, sum(w) OVER () - sum(w) OVER o + w AS w_left
  FROM weighed WINDOW o AS (ORDER BY s / w, source IS NULL, source)
), cut AS (SELECT *, 3 * total - 4 * before AS l, w * (3 * total - 4 * before) > 4 * s * w_left AS is_full FROM filling
), goals AS (
  SELECT source, s, CASE WHEN is_full THEN s * 2.0::DOUBLE
    ELSE w * ((max(l) FILTER (NOT is_full) OVER ())::DOUBLE / 2.0::DOUBLE) / (max(w_left) FILTER (NOT is_full) OVER ())::DOUBLE END AS target FROM cut
), planned AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END::BIGINT AS epochs FROM goals
), placed AS (
  SELECT k.doc_id, k.size, g.s, g.target, g.epochs, floor(g.target - g.epochs * g.s)::BIGINT AS rest,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN planned g ON k.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, s AS source_size, target::DOUBLE AS target, (epochs * size + least(greatest(rest - before, 0), size))::BIGINT AS taken FROM placed
"""


@query(SQL)
def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
