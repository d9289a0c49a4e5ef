"""Linear text models held as a table, and closed-form ways to fill it.

A model is ``(channel, term, idf, weights)`` with one weight per class, in label order. One row per
document term meets one row of weights, and the class scores are sums over that row: no row per
(term, class) is ever made.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from corpuslens.functions.counting import Channel, best_by_text, scores_by_text, sums_by_class
from corpuslens.operators.tfidf import FeatureUnion, FittedBlock
from corpuslens.sources.tables import keep_table

# How the confidence of a prediction is to be read.
PROBABILITY, MARGINS, DISCRETE = "calibrated_probability", "calibrated_decision_softmax", "uncalibrated_discrete"

MAX_CLASSES = 1_000
# A table of class weights of at most this many numbers may be sent to every task.
BROADCAST_WEIGHTS = 16_000_000


def class_counts(df: DataFrame, label: str = "lang", max_classes: int = MAX_CLASSES) -> dict:
    """Documents per class, in label order, on the driver. Refuses a column that is not a class label."""
    rows = df.filter(F.col(label).isNotNull()).groupBy(label).count().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} values: not a class label")
    return dict(sorted((r[0], r[1]) for r in rows))


def class_labels(df: DataFrame, label: str = "lang", max_classes: int = MAX_CLASSES) -> list:
    """The classes in order."""
    return list(class_counts(df, label, max_classes))


def calibrated_shares(margins: Column, sigmoids: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """Mean over the folds of each class's share, from margins fold by fold and a sigmoid for every one.

    A fold whose classes all get nothing says that each is as likely as any other.
    """
    n = len(sigmoids[0])
    a, b = (F.array(*[F.lit(float(ab[j])) for fold in sigmoids for ab in fold]) for j in (0, 1))
    raw = F.transform(F.arrays_zip(margins.alias("m"), a.alias("a"), b.alias("b")), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-(x["a"] * x["m"] + x["b"]))))
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    share = lambda p: F.transform(p, lambda x: F.coalesce(F.try_divide(x, total(p)), F.lit(1.0 / n)))
    folds = F.transform(F.sequence(F.lit(0), F.lit(len(sigmoids) - 1)), lambda k: share(F.slice(raw, k * n + 1, F.lit(n))))
    nothing = F.array_repeat(F.lit(0.0), n)
    summed = F.aggregate(folds, nothing, lambda s, p: F.zip_with(s, p, lambda x, y: x + y))
    return F.transform(summed, lambda x: x / len(sigmoids))


@dataclass
class LinearTextModel:
    """``table``: ``channel, term, idf, weights``; ``intercepts``: one number per class.

    With ``sigmoids``, per fold one (a, b) per class, weights and intercepts run through the folds, and
    probabilities are the folds' mean.
    """

    union: FeatureUnion
    table: DataFrame
    labels: list
    intercepts: list[float]
    confidence_type: str
    sigmoids: list[list[tuple[float, float]]] | None = None

    def _is_small(self) -> bool:
        """Whether the weights may be broadcast; the table is counted once."""
        if not hasattr(self, "_rows"):
            self._rows = self.table.count()
        return self._rows * max(1, len(self.intercepts)) <= BROADCAST_WEIGHTS

    def _weighed(self, df: DataFrame, id_col: str, text: str) -> DataFrame:
        """Document terms with their TF-IDF weight before normalisation and the class weights."""
        out = None
        for part in self.union.fitted:
            channel = part.block.channel
            counts = part.block.counts(df, id_col, text)
            table = self.table.filter(F.col("channel") == channel).select("term", "idf", "weights")
            tf = F.log("tf") + F.lit(1.0) if part.block.sublinear else F.col("tf").cast("double")
            # A large table is joined by term, in plain shuffled form: skewed terms are split at run time.
            rows = counts.join(F.broadcast(table) if self._is_small() else table, "term").select(
                id_col, F.lit(channel).alias("channel"), "term", (tf * F.col("idf")).alias("x"), "weights"
            )
            out = rows if out is None else out.unionByName(rows)
        return out

    def scores(self, df: DataFrame, id_col: str = "doc_id", text: str = "clean") -> DataFrame:
        """``(id, scores)`` of every document: one score per class in label order, fold by fold if there are any.

        A small table of weights goes to every task, and a document is scored where it is.
        """
        if self._is_small():
            return df.select(id_col, self.row_scores(text).alias("scores"))
        rows = self._weighed(df, id_col, text)
        sums = [F.sum(F.col("x") * F.get("weights", F.lit(i))).alias(f"s{i}") for i in range(len(self.intercepts))]
        # Dividing the sums by the norm equals normalising each cell, without a second pass.
        per_channel = rows.groupBy(id_col, "channel").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"), *sums)
        if len(self.union.fitted) == 1:
            totals = per_channel.select(id_col, *[(F.col(f"s{i}") / F.col("norm")).alias(f"s{i}") for i in range(len(self.intercepts))])
        else:
            totals = per_channel.groupBy(id_col).agg(
                *[F.sum(F.col(f"s{i}") / F.col("norm")).alias(f"s{i}") for i in range(len(self.intercepts))]
            )
        final = [
            (F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(self.intercepts[i])) for i in range(len(self.intercepts))
        ]
        return df.select(id_col).join(totals, id_col, "left").select(id_col, F.array(*final).alias("scores"))

    def _in_row(self, text: str, of_texts, kind: T.DataType, *more: Column) -> Column:
        """``of_texts(channels, weights)`` over one row's texts and ``more``; ``weights``: a channel's, one row a term."""
        texts, channels = self.union.channels(self.table.select("channel", "term", "idf", "weights"), text)
        counting, n = [(c.count, c.sublinear) for c in channels], len(self.intercepts)
        weights = [np.array(c.vocabulary["weights"].combine_chunks().flatten(), dtype=float).reshape(-1, n) for c in channels]
        sent = self.table.sparkSession.sparkContext.broadcast(([c.vocabulary.select(["term", "idf"]) for c in channels], weights))

        @F.arrow_udf(kind)
        def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabularies, weights = sent.value
            return of_texts([Channel(c, v, s) for (c, s), v in zip(counting, vocabularies, strict=True)], weights)(batches)

        return found(F.struct(*texts, *more))

    def row_scores(self, text: str = "clean") -> Column:
        """The scores as an expression over one row: no join, no group, no state.

        The table of weights goes to every task, so it must be as small as ``BROADCAST_WEIGHTS`` allows.
        """
        if not self._is_small():
            raise ValueError("the table of weights is too large to be sent to every task")
        intercepts = np.array(self.intercepts, dtype=float)
        return self._in_row(text, lambda channels, weights: scores_by_text(channels, weights, intercepts), T.ArrayType(T.DoubleType()))

    def predict(self, df: DataFrame, id_col: str = "doc_id", text: str = "clean") -> DataFrame:
        """``(id, scores, prediction)``; equal scores go to the first label. Scores of folds become probabilities."""
        scored = self.scores(df, id_col, text).withColumn("scores", self.class_scores(F.col("scores")))
        return scored.withColumn("prediction", argmax_label(F.col("scores"), self.labels))

    def class_scores(self, scores: Column) -> Column:
        """One number per class: the scores, or the probability that the folds' scores make."""
        return calibrated_shares(scores, self.sigmoids) if self.sigmoids else scores

    def explain(self, df: DataFrame, k: int = 8, id_col: str = "doc_id", text: str = "clean") -> DataFrame:
        """``(id, prediction, rank, feature, score, type)``: the k terms that raise the predicted class most.

        The class is found first; then each term keeps only its weight for that class, the mean of the
        folds' weights if there are any.
        """
        names = F.array(*[F.lit(v) for v in self.labels])
        position = lambda scores: F.array_position(scores, F.array_max(scores)).cast("int") - 1
        if self._is_small():
            rows = df.select(id_col, text, self.row_scores(text).alias("__raw")).withColumn("__scores", self.class_scores(F.col("__raw")))
            return self.explain_class(rows.select(id_col, text, position("__scores").alias("best")), k, id_col, text)
        scored = self.scores(df, id_col, text).select(id_col, self.class_scores(F.col("scores")).alias("scores"))
        best = scored.select(id_col, (F.array_position("scores", F.array_max("scores")).cast("int") - 1).alias("best"))
        rows = self._weighed(df, id_col, text).join(best, id_col)
        folds = len(self.sigmoids) if self.sigmoids else 1
        own = sum((F.get("weights", F.col("best") + k * len(self.labels)) for k in range(1, folds)), F.get("weights", F.col("best"))) / folds
        rows = rows.select(id_col, "channel", "term", "best", "x", own.alias("weight"))
        norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(id_col, "channel")))
        rows = rows.withColumn("score", F.round(F.col("x") / norm * F.col("weight"), 9)).filter("score > 0")
        return self._ranked(rows, k, id_col, names)

    def explain_class(self, df: DataFrame, k: int = 8, id_col: str = "doc_id", text: str = "clean", best: str = "best") -> DataFrame:
        """The same for documents whose class is known, by its position in ``best``; the weights must be few enough to be sent to every task."""
        n, names = len(self.labels), F.array(*[F.lit(v) for v in self.labels])
        kind = T.ArrayType(T.StructType([T.StructField("channel", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("score", T.DoubleType())]))
        found = self._in_row(text, lambda channels, weights: best_by_text(channels, weights, n, k), kind, F.col(best))
        rows = df.select(id_col, F.col(best).alias("best"), F.inline(found))
        channel = F.get(F.array(*[F.lit(p.block.channel) for p in self.union.fitted]), F.col("channel"))
        # a document's candidates are a handful of rows, and ranking moves no others
        rows = rows.select(id_col, "best", channel.alias("channel"), "term", F.round("score", 9).alias("score")).filter("score > 0")
        return self._ranked(rows, k, id_col, names)

    @staticmethod
    def _ranked(rows: DataFrame, k: int, id_col: str, names: Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("score"), "term", "channel"))
        return rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= k).select(
            id_col,
            F.get(names, F.col("best")).alias("prediction"),
            "rank",
            F.col("term").alias("feature"),
            "score",
            F.when(F.col("channel") == "word", "word_token").otherwise("subword_ngram").alias("type"),
        )


def argmax_label(scores: Column, labels: Sequence) -> Column:
    return F.get(F.array(*[F.lit(v) for v in labels]), F.array_position(scores, F.array_max(scores)).cast("int") - 1)


def _class_sums(train: DataFrame, fitted: FittedBlock, labels: Sequence, label: str, id_col: str, text: str, extra: Sequence[str] = ()) -> DataFrame:
    """Per term (and ``extra`` column): summed TF-IDF weight of each class, ``c0 .. cK``.

    By a bounded vocabulary the weights are summed where the documents are, one row per term and task.
    """
    names = [f"c{i}" for i in range(len(labels))]
    if fitted.vocabulary.bounded and not extra:
        known = fitted.vocabulary.terms.select("term", "idf").toArrow()
        if len(known) * len(labels) <= BROADCAST_WEIGHTS:
            text_col, count = fitted.block.counting(text)
            position = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(label)) - 1
            rows = train.select(text_col.alias("t"), F.when(position >= 0, position).cast("int").alias("y"))
            found = rows.mapInArrow(sums_by_class(count, known, len(labels), fitted.block.sublinear), ", ".join(["term string", *(f"{c} double" for c in names)]))
            return found.groupBy("term").agg(*[F.sum(c).alias(c) for c in names])
    rows = fitted.transform(train, id_col, text, keep=[label, *extra])
    sums = [F.sum(F.when(F.col(label) == v, F.col("w")).otherwise(0.0)).alias(name) for name, v in zip(names, labels, strict=True)]
    return rows.groupBy("term", *extra).agg(*sums)


def nb_weights(kind: str, counts: DataFrame, alpha: float, n_classes: int) -> DataFrame:
    """``term, weights`` from ``term, c0..cK``. Totals come back as scalar subqueries of one row."""
    names = [f"c{i}" for i in range(n_classes)]
    if kind == "multinomial":
        totals = counts.agg(F.array(*[F.sum(F.col(c) + F.lit(alpha)) for c in names])).scalar()
        weights = [F.log((F.col(c) + F.lit(alpha)) / F.get(totals, F.lit(i))) for i, c in enumerate(names)]
        return counts.select("term", F.array(*weights).alias("weights"))
    if kind == "complement":
        everything = sum((F.col(c) for c in names[1:]), F.col(names[0]))
        rest = counts.select("term", *[(everything + F.lit(alpha) - F.col(c)).alias(c) for c in names])
        totals = rest.agg(F.array(*[F.sum(c) for c in names])).scalar()
        logged = rest.select("term", *[F.log(F.col(c) / F.get(totals, F.lit(i))).alias(c) for i, c in enumerate(names)])
        summed = logged.agg(F.array(*[F.sum(c) for c in names])).scalar()
        return logged.select("term", F.array(*[F.col(c) / F.get(summed, F.lit(i)) for i, c in enumerate(names)]).alias("weights"))
    raise ValueError(f"unknown kind: {kind}")


def fit_naive_bayes(
    train: DataFrame,
    fitted: FittedBlock,
    labels: Sequence,
    kind: str = "multinomial",
    alpha: float = 0.1,
    label: str = "lang",
    id_col: str = "doc_id",
    text: str = "clean",
) -> LinearTextModel:
    """Naive Bayes on TF-IDF weights, in closed form.

    ``multinomial`` adds log class shares; ``complement`` uses each class's complement with normalised
    weights and no class share.
    """
    return fit_bayes_grid(train, fitted, labels, [(kind, alpha)], label, id_col, text)[0]


def fit_bayes_grid(
    train: DataFrame, fitted: FittedBlock, labels: Sequence, grid: Sequence[tuple[str, float]], label: str = "lang", id_col: str = "doc_id", text: str = "clean"
) -> list[LinearTextModel]:
    """Naive Bayes for every ``(kind, alpha)``, from one table of class sums."""
    counts = keep_table(_class_sums(train, fitted, labels, label, id_col, text))
    sizes = class_counts(train, label) if any(kind == "multinomial" for kind, _ in grid) else {}
    out = []
    for kind, alpha in grid:
        weights = nb_weights(kind, counts, alpha, len(labels))
        table = fitted.vocabulary.terms.select("term", "idf").join(weights, "term")
        table = keep_table(table.select(F.lit(fitted.block.channel).alias("channel"), "term", "idf", "weights"))
        intercepts = [0.0] * len(labels)
        if kind == "multinomial":
            intercepts = [math.log(sizes[v] / sum(sizes.values())) if v in sizes else -math.inf for v in labels]
        out.append(LinearTextModel(FeatureUnion([fitted.block], [fitted]), table, list(labels), intercepts, PROBABILITY))
    return out


def scores_together(models: Sequence[LinearTextModel], df: DataFrame, id_col: str = "doc_id", text: str = "clean") -> DataFrame:
    """``(id, scores)`` of models of the same terms and labels, model after model: a document is counted once for all."""
    first = models[0]
    table = first.table
    for i, model in enumerate(models[1:]):
        table = table.join(model.table.select("channel", "term", F.col("weights").alias(f"__w{i}")), ["channel", "term"])
    weights = F.concat("weights", *[f"__w{i}" for i in range(len(models) - 1)])
    table = keep_table(table.select("channel", "term", "idf", weights.alias("weights")))
    intercepts = [x for model in models for x in model.intercepts]
    return LinearTextModel(first.union, table, first.labels, intercepts, first.confidence_type).scores(df, id_col, text)


def fold_weights(
    train: DataFrame,
    fitted: FittedBlock,
    labels: Sequence,
    folds: int = 5,
    kind: str = "complement",
    alpha: float = 0.1,
    label: str = "lang",
    id_col: str = "doc_id",
    text: str = "clean",
    fold: str = "fold",
) -> DataFrame:
    """``(label, term, avg_w)``: mean weight over models that each leave one fold out.

    A fold's training sums are the totals less its own sums, so no document is read more than once.
    """
    per_fold = _class_sums(train, fitted, labels, label, id_col, text, extra=[fold])
    names = [f"c{i}" for i in range(len(labels))]
    own = per_fold.groupBy("term").agg(
        *[F.sum(F.when(F.col(fold) == k, F.col(c)).otherwise(0.0)).alias(f"{c}_{k}") for c in names for k in range(folds)],
        *[F.sum(c).alias(c) for c in names],
    )
    own = keep_table(own)  # terms x classes x folds, read once per fold
    out = None
    for k in range(folds):
        # Subtraction may leave dust where a class has no weight outside the fold.
        left = [F.greatest(F.round(F.col(c) - F.col(f"{c}_{k}"), 12), F.lit(0.0)).alias(c) for c in names]
        weights = nb_weights(kind, own.select("term", *left), alpha, len(labels))
        out = weights if out is None else out.unionByName(weights)
    pairs = F.array(*[F.struct(F.lit(v).alias(label), F.get("weights", F.lit(i)).alias("w")) for i, v in enumerate(labels)])
    return out.select("term", F.inline(pairs)).groupBy(label, "term").agg(F.avg("w").alias("avg_w"))


def fit_centroids(train: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per class: ``label, centroid``. Means per (class, position) combine on the map side."""
    cells = train.select(label, F.posexplode(vector).alias("pos", "v"))
    means = cells.groupBy(label, "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    packed = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("cells"))
    return packed.select(label, F.col("cells.v").alias("centroid"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def centroid_classify(df: DataFrame, centroids: DataFrame, label: str = "label", vector: str = "embedding", out_col: str = "prediction") -> DataFrame:
    """Class whose centroid has the highest cosine with the vector; equal cosines go to the first label.

    The classes-by-dimensions table arrives as one value; rows are neither joined nor multiplied.
    """
    norm = F.sqrt(_dot(F.col("centroid"), F.col("centroid")))
    unit = centroids.select(label, F.transform("centroid", lambda x: x / norm).alias("centroid"))
    packed = unit.agg(F.sort_array(F.collect_list(F.struct(F.col(label), F.col("centroid"))))).scalar()
    rows = df.withColumn("__centroids", packed).withColumn("__norm", F.sqrt(_dot(F.col(vector), F.col(vector))))
    scored = F.transform(
        F.col("__centroids"),
        lambda c: F.struct((-F.round(_dot(F.col(vector), c["centroid"]) / F.col("__norm"), 9)).alias("minus"), c[label].alias("label")),
    )
    return rows.withColumn("__best", F.array_min(scored)).select(*df.columns, F.col("__best.label").alias(out_col), (-F.col("__best.minus")).alias("cosine"))
