"""Classification metrics and error analysis, all from the confusion counts.

Predictions are read once, into one row per (true, predicted) pair; every metric is arithmetic on
those few rows, so nothing here grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from time import perf_counter

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslens.functions.text import word_count

METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")


def _ratio(a: Column, b: Column) -> Column:
    """``a / b``, 0 where undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(predictions: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    """``(by.., y_true, y_pred, n)`` for the pairs that occur."""
    pairs = predictions.select(*by, F.col(y_true).cast("string").alias("y_true"), F.col(y_pred).cast("string").alias("y_pred"))
    return pairs.groupBy(*by, "y_true", "y_pred").agg(F.count("*").alias("n"))


def per_class(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unrounded precision, recall, F1 and support of every class that is true or predicted somewhere."""
    hit = F.col("y_true") == F.col("y_pred")
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), zero.alias("predicted"), F.when(hit, F.col("n")).otherwise(zero).alias("tp")),
        F.struct(F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
    )
    totals = confusion.select(*by, F.inline(sides)).groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    rates = totals.withColumn("precision", _ratio(F.col("tp"), F.col("predicted"))).withColumn("recall", _ratio(F.col("tp"), F.col("support")))
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rates.select(*by, "label", "precision", "recall", f1.alias("f1"), "support", "tp")


def overall(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unrounded accuracy and macro / weighted precision, recall and F1."""
    rates = per_class(confusion, by)
    columns = [_ratio(F.sum("tp"), F.sum("support")).alias("accuracy")]
    columns += [F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    columns += [_ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    return rates.groupBy(*by).agg(*columns, F.sum("support").alias("n_docs"))


def metrics_overall(confusion: DataFrame, digits: int = 6, by: Sequence[str] = ()) -> DataFrame:
    return overall(confusion, by).select(*by, *[F.round(m, digits).alias(m) for m in METRICS], "n_docs")


def metrics_per_class(confusion: DataFrame, digits: int = 6) -> DataFrame:
    rates = per_class(confusion)
    return rates.select("label", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")], "support")


def classification_report(confusion: DataFrame, digits: int = 6) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    classes = metrics_per_class(confusion, digits)
    total = overall(confusion)

    def summary(name: str, precision: str, recall: str, f1: str) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            F.round(precision, digits).alias("precision"),
            F.round(recall, digits).alias("recall"),
            F.round(f1, digits).alias("f1"),
            F.col("n_docs").alias("support"),
        )

    rows = F.array(
        summary("accuracy", "accuracy", "accuracy", "accuracy"),
        summary("macro avg", "macro_precision", "macro_recall", "macro_f1"),
        summary("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1"),
    )
    return classes.unionByName(total.select(F.inline(rows)))


def confusion_matrix(confusion: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Every (true, predicted) pair of the classes, zeros kept, in long form.

    The classes are the ``labels`` given, also those without documents, or else all that occur.
    """
    if labels is not None:
        labels = confusion.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    else:
        labels = confusion.select(F.explode(F.array("y_true", "y_pred")).alias("label")).distinct()
    # The list of classes is one value; exploding it gives the classes x classes frame of the matrix.
    everything = labels.agg(F.sort_array(F.collect_list("label"))).scalar()
    frame = labels.select(F.col("label").alias("y_true"), F.explode(everything).alias("y_pred"))
    return frame.join(confusion, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("n", F.lit(0)).alias("n")
    )


def metrics_document(confusion: DataFrame, labels: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """One row: overall metrics, the report by class as a map, and the matrix as an array of arrays in label order."""
    report = metrics_per_class(confusion, digits).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", F.struct("precision", "recall", "f1", "support"))))).alias("report")
    )
    cells = confusion_matrix(confusion, labels).groupBy("y_true").agg(F.sort_array(F.collect_list(F.struct("y_pred", "n"))).alias("row"))
    rows = cells.agg(F.sort_array(F.collect_list(F.struct("y_true", F.col("row.n").alias("n")))).alias("rows"))
    matrix = rows.select(F.col("rows.y_true").alias("labels"), F.col("rows.n").alias("confusion_matrix"))
    one = F.lit(1).alias("__one")
    parts = [metrics_overall(confusion, digits).select("*", one), report.select("*", one), matrix.select("*", one)]
    return parts[0].join(parts[1], "__one").join(parts[2], "__one").drop("__one")


def confusion_wide(matrix: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The matrix with one column per predicted class."""
    return matrix.groupBy("y_true").pivot("y_pred", list(labels)).agg(F.first("n")).fillna(0)


def confusion_normalized(matrix: DataFrame, digits: int = 6) -> DataFrame:
    """Rows of the matrix as shares; rows without documents stay 0."""
    row = F.sum("n").over(Window.partitionBy("y_true"))
    return matrix.select("y_true", "y_pred", F.round(_ratio(F.col("n"), row), digits).alias("share"))


def top_confusions(confusion: DataFrame, k: int = 10, digits: int = 6) -> DataFrame:
    """The k most frequent mistakes with their share of the true class, ties by name."""
    row = F.sum("n").over(Window.partitionBy("y_true"))
    rates = confusion.withColumn("error_pct", F.round(_ratio(F.col("n") * 100.0, row), digits))
    return rates.filter(F.col("y_true") != F.col("y_pred")).orderBy(F.desc("n"), "y_true", "y_pred").limit(k)


def strong_weak_classes(confusion: DataFrame, k: int = 5, digits: int = 6) -> DataFrame:
    """The k classes with the highest and the k with the lowest F1."""
    rates = per_class(confusion).select("label", F.round("f1", digits).alias("f1"), "support")
    best = F.row_number().over(Window.orderBy(F.desc("f1"), "label")).cast("long")
    worst = F.row_number().over(Window.orderBy("f1", "label")).cast("long")
    ranked = rates.withColumn("best", best).withColumn("worst", worst)
    strong = ranked.filter(F.col("best") <= k).select(F.lit("strong").alias("kind"), F.col("best").alias("rank"), "label", "f1", "support")
    weak = ranked.filter(F.col("worst") <= k).select(F.lit("weak").alias("kind"), F.col("worst").alias("rank"), "label", "f1", "support")
    return strong.unionByName(weak)


def error_samples(predictions: DataFrame, texts: DataFrame, k: int = 6, id_col: str = "doc_id", text: str = "text", snippet: int = 250) -> DataFrame:
    """The first k misclassified documents by id, with a one-line snippet and their length.

    The k ids are chosen before any text is read.
    """
    chosen = predictions.filter(F.col("y_true") != F.col("y_pred")).orderBy(id_col).limit(k).select(id_col, "y_true", "y_pred")
    rows = texts.select(id_col, text).join(F.broadcast(chosen), id_col)
    line = F.replace(F.substr(F.col(text), F.lit(1), F.lit(snippet)), F.lit("\n"), F.lit(" "))
    return rows.select(id_col, "y_true", "y_pred", F.trim(line).alias("snippet"), word_count(text).alias("word_len"))


def compare_splits(confusion: DataFrame, split: str = "split", digits: int = 4) -> DataFrame:
    """One row: validation and test metrics side by side."""
    rows = metrics_overall(confusion, digits, by=[split])

    def of(name: str, metric: str) -> Column:
        return F.max(F.when(F.col(split) == name, F.col(metric)))

    val = [of("val", m).alias(f"val_{m}") for m in ("accuracy", "macro_f1", "weighted_f1")]
    test = [of("test", m).alias(f"test_{m}") for m in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")]
    return rows.agg(*val, *test)


def latency_ms(scored: DataFrame, n_docs: int, iterations: int = 5) -> float:
    """Mean milliseconds per document of a full scoring run whose rows are discarded."""
    start = perf_counter()
    for _ in range(iterations):
        scored.write.format("noop").mode("overwrite").save()
    return (perf_counter() - start) / (n_docs * iterations) * 1000.0
