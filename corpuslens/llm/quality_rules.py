"""Rules on words and lines, and a log-likelihood ratio between trusted and raw text.

Words are reduced to their forms: runs of small letters, capitals, digits and equal signs become one
character each. Uni- and bigrams of forms are hashed to buckets. Two multinomials over the buckets, one
from trusted documents and one from all, give every bucket a weight; a document's score is the mean weight
of its n-grams. Forms are few, and new words bring hardly any new ones, so that buckets do not fill up as
the corpus grows; an n-gram that trusted text is too small to show weighs next to nothing. The bound comes
from trusted documents that were held out of the counts. The weights are one array, a scalar subquery, so
scoring is arithmetic inside the row: texts never move. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslens.llm.common import SPACE, Scratch, flagged, read
from corpuslens.llm.registry import query

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
BUCKETS = 1 << 18
#: Occurrences added to a bucket's count in trusted text and to the count that its share of all text predicts.
SMOOTHING = 5.0
#: One of so many trusted documents is held out of the counts.
HELD_OUT = 5
#: The bound lies so many standard deviations of the held-out scores below their mean, so at most one in
#: 25 documents like them falls below it (Chebyshev's inequality), and at least this far.
DEVIATIONS, LEAST_GAP = 5.0, 0.1


def words_of(text: Column) -> Column:
    """Words of a text; blanks are made one kind first, because splitting at a single character is fast."""
    even = F.coalesce(text, F.lit(""))
    for c in SPACE[1:]:
        even = F.replace(even, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(even, " "), "")


def forms_of(text: Column) -> Column:
    """The forms of a text's words."""
    c = F.coalesce(text, F.lit(""))
    for kind, sign in ((r"[a-z\p{Ll}\p{Lo}\p{Lm}\p{M}]+", "a"), (r"[A-Z\p{Lu}\p{Lt}]+", "A"), (r"[0-9\p{N}]+", "0"), (r"([^aA0\x20\x09-\x0D])\1+", "$1")):
        c = F.regexp_replace(c, kind, sign)
    return words_of(c)


def gram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of the uni- and bigrams, from 64-bit hashes."""
    pairs = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(hashes, i + 1)))
    return F.transform(F.concat(hashes, pairs), lambda x: F.pmod(x, F.lit(buckets)).cast("int"))


def held_out(doc_id: Column) -> Column:
    """Whether a trusted document takes no part in the counts."""
    return F.pmod(F.xxhash64(doc_id), F.lit(HELD_OUT)) == 0


def bucket_weights(docs: DataFrame, trusted_ids: DataFrame, scratch: Scratch, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """``bucket, w``: for every bucket, the log of its count in trusted documents over the count that its share of all text predicts, both smoothed.

    Counts cover all documents and add up on the map side; the result has ``buckets`` rows. Trusted
    documents that are held out count as part of all text only.
    """
    counted = trusted_ids.filter(~held_out(F.col("doc_id")))
    marked = flagged(docs.select("doc_id", "text"), counted, "doc_id", "trusted")
    hashes = marked.select("trusted", F.transform(forms_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    counts = hashes.select("trusted", F.explode(gram_buckets(F.col("h"), buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("trusted").alias("target"))
    counts = scratch.keep(counts)
    total = counts.agg(F.sum("raw"), F.sum("target")).first()
    part = (total[1] or 0) / (total[0] or 1)
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    ratio = F.log((count("target") + smoothing) / (count("raw") * F.lit(float(part)) + smoothing))
    return scratch.keep(every.join(counts, "bucket", "left").select("bucket", ratio.alias("w")))


def covered(places: Column) -> Column:
    """Number of words in the windows that begin at the places, which are sorted."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct((i + WINDOW).alias("end"), (s["n"] + i + WINDOW - F.greatest(i, s["end"])).alias("n")),
        lambda s: s["n"],
    )


def base_columns(docs: DataFrame) -> DataFrame:
    """The documents with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``__h``, the words' hashes.

    Windows are compared by 64-bit hash. Sorting is linear-logarithmic in the words of one text, and
    only texts with a repeated window are sorted with places.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.withColumn("__words", words_of(F.col("text")))
    df = df.withColumns(
        {
            "__h": F.transform("__words", lambda w: F.xxhash64(w)),
            "__lines": lines,
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        }
    )
    h = F.col("__h")
    window = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    df = df.withColumns(
        {
            "n_words": F.size(h).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__w": F.when(F.size(h) >= WINDOW, window).otherwise(F.array().cast("array<bigint>")),
        }
    )
    w = F.col("__w")
    twice = F.size(F.array_distinct(w)) < F.size(w)
    placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("__s", F.when(twice, placed))
    s = F.col("__s")
    near = lambda i, x: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
    repeats = F.filter(s, lambda x, i: near(i - 1, x) | near(i + 1, x))
    places = F.sort_array(F.transform(repeats, lambda x: x["i"]))
    df = df.withColumn("n_repeat_words", F.when(s.isNull(), F.lit(0)).otherwise(covered(places)).cast("long"))
    return df.drop("__words", "__lines", "__w", "__s")


def judge_quality(docs: DataFrame, trusted_ids: DataFrame, threshold: float | None = None, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row per document: ``doc_id``, the base columns, ``base_failed``, ``score``, ``bound`` and ``kept``.

    ``trusted_ids (doc_id)`` names the trusted documents; repeated and null ids there count once and not
    at all. Too few words (under 20) or too many in repeated windows (over 30 %) fail the base rules;
    others are kept if ``score >= bound``, which is ``threshold`` if given, and else follows from the
    trusted documents that were held out (those that fail the base rules left out). Without any, their
    mean counts as 0. A text without words, or null, has a null score and fails. Without trusted documents
    all weights are 0. Rows that share an id are judged each by its own text. Columns named like the
    results are not carried over.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    ids = scratch.keep(trusted_ids.filter("doc_id is not null").select("doc_id").distinct())
    weights = bucket_weights(docs, ids, scratch, buckets, smoothing)
    # one array of a fixed number of values, in bucket order
    row = weights.agg(F.sort_array(F.collect_list(F.struct("bucket", "w"))).alias("all")).select(F.transform("all", lambda x: x["w"]).alias("w"))
    # a subquery can't be written into a lambda; named and used once, it is put there by Catalyst, and no row carries the array
    df = base_columns(docs.select("doc_id", "text")).withColumn("__all", scratch.keep(row).scalar())
    df = df.withColumn("__f", F.transform(forms_of(F.col("text")), lambda w: F.xxhash64(w)))
    total = F.aggregate(gram_buckets(F.col("__f"), buckets), F.lit(0.0), lambda a, g: a + F.get("__all", g))
    df = df.withColumn("score", F.when(F.col("n_words") > 0, F.round(total / (2 * F.size("__f") - 1), 9)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = scratch.keep(df.select(*columns, failed.alias("base_failed"), "score"))
    if threshold is None:
        held = flagged(rows.filter("not base_failed"), ids.filter(held_out(F.col("doc_id"))), "doc_id", "held").filter("held")
        mean, spread = held.agg(F.avg("score"), F.stddev_pop("score")).first()
        threshold = round((mean or 0.0) - max(DEVIATIONS * (spread or 0.0), LEAST_GAP), 6)
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))
    return rows.select(*columns, "base_failed", kept.alias("kept"), "score", F.lit(threshold).alias("bound"))


@query()
def op7_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted documents are those labelled as of good quality."""
    trusted = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return judge_quality(read(spark, sf_dir, "documents"), trusted)
