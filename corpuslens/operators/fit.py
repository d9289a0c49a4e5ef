"""Spark ML classifiers on TF-IDF vectors or dense embeddings.

``C`` is the inverse regularisation of the usual linear-model libraries; with n training documents it
corresponds to Spark's ``regParam = 1 / (C * n)`` on the mean loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslens.operators.linear_scores import DISCRETE, MARGINS, PROBABILITY, LinearTextModel, calibrated_shares
from corpuslens.operators.shared_fit import LOG, SQUARED_HINGE, TASKS, Problem, block_margins, fit_together, kept_blocks, pack_blocks, pack_texts, spread, vector_margins
from corpuslens.operators.split import BUCKET_DIGITS, split_hash
from corpuslens.operators.tfidf import FeatureUnion
from corpuslens.plans.joins import lookup_join
from corpuslens.sources.tables import keep_table


def with_label_index(df: DataFrame, labels: Sequence, label: str = "lang", out_col: str = "y") -> DataFrame:
    """Class position in ``labels`` as a double: a chain of comparisons, no join."""
    index = F.lit(None).cast("double")
    for i, v in reversed(list(enumerate(labels))):
        index = F.when(F.col(label) == v, F.lit(float(i))).otherwise(index)
    return df.withColumn(out_col, index)


def with_class_weight(df: DataFrame, y: str = "y", out_col: str = "weight") -> DataFrame:
    """Balanced weight of each row's class."""
    counts = df.groupBy(y).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    return lookup_join(df, counts, y).withColumn(out_col, total / (classes * F.col("__n"))).drop("__n")


ROWS_PER_TASK = 2_000
#: Penalty of the log-loss classifier, on the mean loss.
SGD_ALPHA = 1e-4
#: Kinds that are fitted together.
LINEAR = ("linear_svc", "logreg", "sgd_log")


def vector_size(df: DataFrame, features: str = "features") -> int:
    """Length of a vector column."""
    v = F.unwrap_udt(F.col(features))
    return df.select(F.coalesce(v["size"], F.size(v["values"]))).first()[0]


def best_position(scores: str) -> Column:
    """Position of the highest score, the first among equals, as Spark ML writes a prediction."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


@dataclass
class MarginModel:
    """``weights``: one row per class, the last column the intercepts."""

    weights: np.ndarray

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``margins`` and ``prediction``."""
        return df.withColumn("margins", vector_margins(df, self.weights, features)).withColumn("prediction", best_position("margins"))


@dataclass
class Classifier:
    """Settings of one fit; ``kind``: linear_svc, logreg, sgd_log, mlp, or, in the grids, multinomial_nb and complement_nb."""

    kind: str
    C: float = 1.0
    class_weight: str | None = None
    max_iter: int = 1000
    tol: float = 1e-4  # fits stop here; the steps are far more than they need
    alpha: float = 0.1
    layers: tuple[int, ...] = (256, 128)

    def problem(self, data: str, n_docs: int = 0, left_out: int | None = None) -> Problem:
        """The same settings for a fit together with others; ``n_docs`` matters to ``sgd_log`` only."""
        if self.kind == "linear_svc":
            return Problem(data, SQUARED_HINGE, self.C, self.class_weight == "balanced", left_out)
        if self.kind == "logreg":
            return Problem(data, LOG, self.C, self.class_weight == "balanced", left_out)
        if self.kind == "sgd_log":
            return Problem(data, LOG, 1.0 / (SGD_ALPHA * n_docs), self.class_weight == "balanced", left_out)
        raise ValueError(f"not a linear classifier: {self.kind}")

    def fit(self, train: DataFrame, n_docs: int, n_classes: int, n_features: int | None = None, features: str = "features", y: str = "y"):
        if self.kind == "linear_svc":
            size = n_features or vector_size(train, features)
            blocks = spread([pack_blocks(train, "train", features, y, n_rows=n_docs)], train.sparkSession.sparkContext.defaultParallelism)
            weights = fit_together(blocks, [self.problem("train")], {"train": size}, n_classes, self.tol, self.max_iter)
            blocks.unpersist()
            return MarginModel(weights[0])
        # An optimiser step is one job over the rows: tasks of a few rows would be all scheduling, and every
        # task shuffles a gradient, so their number must not grow with the data.
        train = train.coalesce(min(n_docs // ROWS_PER_TASK + 1, TASKS * train.sparkSession.sparkContext.defaultParallelism))
        columns = dict(featuresCol=features, labelCol=y)
        weight = {}
        if self.class_weight == "balanced":
            train = with_class_weight(train, y)
            weight = dict(weightCol="weight")
        if self.kind == "logreg":
            return LogisticRegression(
                family="multinomial", maxIter=self.max_iter, tol=self.tol, regParam=1.0 / (self.C * n_docs), elasticNetParam=0.0,
                standardization=False, **columns, **weight,
            ).fit(train)
        if self.kind == "sgd_log":
            return LogisticRegression(
                family="multinomial", maxIter=self.max_iter, tol=self.tol, regParam=SGD_ALPHA, standardization=False, **columns, **weight
            ).fit(train)
        if self.kind == "mlp":
            if n_features is None:
                raise ValueError("the network needs the number of features")
            return MultilayerPerceptronClassifier(
                layers=[n_features, *self.layers, n_classes], maxIter=self.max_iter, seed=42, **columns
            ).fit(train)
        raise ValueError(f"unknown classifier: {self.kind}")


def text_blocks(docs: DataFrame, union: FeatureUnion, terms: DataFrame, size: int, y: str = "y", id_col: str = "doc_id", text: str = "clean", fold: Column | None = None) -> DataFrame:
    """Blocks of the labelled documents, kept, to be unpersisted; ``terms`` are the union's terms with their positions.

    Bounded vocabularies go to every task and texts become blocks where they are: no vector is written.
    """
    if all(part.vocabulary.bounded for part in union.fitted):
        texts, channels = union.channels(terms.select("channel", "term", "idf", "idx"), text)
        return kept_blocks(pack_texts(docs, "train", texts, channels, size, y, fold))
    keep = [y] if fold is None else [y, "fold"]
    vectors = keep_table(union.vectors(docs, terms, size, id_col, text, keep=keep), id_col)
    return kept_blocks(pack_blocks(vectors, "train", y=y, fold=fold))


def text_model(model, union: FeatureUnion, terms: DataFrame, labels: Sequence, classes_only: bool = False) -> LinearTextModel:
    """A fitted linear classifier as a table of class weights, to be saved, scored, streamed and explained.

    ``terms`` are the union's terms with their positions. Margins of an SVC are compared by softmax, as
    are the scores of a logistic regression, whose softmax is its probability. A calibrated SVC keeps the
    weights and sigmoids of every fold, and its probability is their mean. With ``classes_only`` a class
    is all that scoring gives.
    """
    sigmoids = None
    if isinstance(model, CalibratedSVC):
        weights, kind, sigmoids = np.vstack(model.weights), PROBABILITY, model.sigmoids
    elif isinstance(model, MarginModel):
        weights, kind = model.weights, MARGINS
    else:
        weights, kind = np.column_stack([model.coefficientMatrix.toArray(), model.interceptVector.toArray()]), PROBABILITY
    if len(weights) != len(labels) * (len(sigmoids) if sigmoids else 1):
        raise ValueError("one row of weights per label is needed")
    rows = weight_rows(terms.sparkSession, weights)
    table = keep_table(terms.join(rows, "idx").select("channel", "term", "idf", "weights"))
    return LinearTextModel(union, table, list(labels), [float(x) for x in weights[:, -1]], DISCRETE if classes_only else kind, sigmoids)


def weight_rows(spark, weights: np.ndarray) -> DataFrame:
    """``idx, weights``: one row per feature, handed over as one Arrow table."""
    n, size = len(weights), weights.shape[1] - 1
    flat = pa.array(np.ascontiguousarray(weights[:, :-1].T).ravel())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * size + 1, n, dtype=np.int32)), flat)
    return spark.createDataFrame(pa.table({"idx": pa.array(np.arange(size, dtype=np.int32)), "weights": lists}))


def predict_labels(model, df: DataFrame, labels: Sequence, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns and ``y_pred`` as a class label."""
    names = F.array(*[F.lit(v) for v in labels])
    return model.transform(df).select(*keep, F.get(names, F.col("prediction").cast("int")).alias("y_pred"))


def embedding_vectors(df: DataFrame, embedding: str = "embedding", out_col: str = "features") -> DataFrame:
    """Dense vectors for Spark ML from an array column."""
    return df.withColumn(out_col, array_to_vector(F.col(embedding).cast("array<double>")))


def fold_id(id_col: str, folds: int = 5, seed: str = "fold") -> Column:
    """Deterministic fold of a document, by keyed hash."""
    digits = F.substr(split_hash(id_col, seed), F.lit(1), F.lit(8))
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(folds)).cast("int")


def stratified_folds(df: DataFrame, folds: int = 5, id_col: str = "doc_id", y: str = "y", seed: str = "fold") -> DataFrame:
    """Add ``fold``: each class dealt out in hash order, so folds differ by one document per class at most.

    As in the stratified split, no class is sorted as a whole: hash buckets are counted, and documents
    are ranked inside theirs.
    """
    rows = df.withColumn("__h", split_hash(id_col, seed)).withColumn("__b", F.substr("__h", F.lit(1), F.lit(BUCKET_DIGITS)))
    sizes = rows.groupBy(y, "__b").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(y).orderBy("__b")) - F.col("__n")
    rank = F.row_number().over(Window.partitionBy(y, "__b").orderBy("__h", id_col))
    ranked = rows.withColumn("__rank", rank).join(sizes.select(y, "__b", before.alias("__before")), [y, "__b"])
    return ranked.withColumn("fold", F.pmod(F.col("__before") + F.col("__rank") - 1, F.lit(folds)).cast("int")).drop("__h", "__b", "__rank", "__before")


@dataclass
class CalibratedSVC:
    """Per fold: weights as in MarginModel, and a sigmoid (a, b) per class fitted outside its training part."""

    weights: list[np.ndarray]
    sigmoids: list[list[tuple[float, float]]]

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Add ``probability`` (array, label order) and ``prediction``."""
        df = df.withColumn("__m", vector_margins(df, np.vstack(self.weights), features))
        df = df.withColumn("probability", calibrated_shares(F.col("__m"), self.sigmoids)).drop("__m")
        return df.withColumn("prediction", best_position("probability"))


def fit_calibrated_svc(
    train: DataFrame, labels: Sequence, folds: int = 5, id_col: str = "doc_id", base: Classifier | None = None,
    features: str = "features", y: str = "y",
) -> CalibratedSVC:
    """Sigmoid-calibrated one-vs-rest SVC. The folds' fits share one job per step.

    Each fold's margins on the left-out part calibrate that fold's model; targets are smoothed by the
    class sizes.
    """
    return _fit_vectors(train, labels, folds, id_col, base, features, y)[1]


def fit_svc_on_blocks(blocks: DataFrame, size: int, n_classes: int, base: Classifier | None = None, folds: int = 0) -> tuple[MarginModel, CalibratedSVC | None]:
    """The SVC of all documents of the ``train`` blocks, and the calibrated one if they are dealt into folds."""
    return _fit_folds(blocks, size, n_classes, folds, base or Classifier("linear_svc", class_weight="balanced"))


def fit_plain_and_calibrated_svc(
    train: DataFrame, labels: Sequence, folds: int = 5, id_col: str = "doc_id", base: Classifier | None = None,
    features: str = "features", y: str = "y",
) -> tuple[MarginModel, CalibratedSVC]:
    """The SVC of all documents and the calibrated one: the fit without a fold takes the same steps as those of the folds."""
    return _fit_vectors(train, labels, folds, id_col, base, features, y)


def dealt(train: DataFrame, folds: int = 5, id_col: str = "doc_id", y: str = "y") -> DataFrame:
    """Add ``fold``: dealt from ids and classes, and joined back by document, so that nothing else is ranked."""
    given = keep_table(stratified_folds(train.select(id_col, y), folds, id_col, y).select(id_col, "fold"), id_col)
    return train.join(given.hint("shuffle_hash"), id_col)


def _fit_vectors(train: DataFrame, labels: Sequence, folds: int, id_col: str, base: Classifier | None, features: str, y: str) -> tuple[MarginModel, CalibratedSVC]:
    rows = dealt(train, folds, id_col, y).select(id_col, y, "fold", features)
    blocks = spread([pack_blocks(rows, "train", features, y, F.col("fold"), n_rows=rows.count())])
    found = fit_svc_on_blocks(blocks, vector_size(train, features), len(labels), base, folds)
    blocks.unpersist()
    return found


def _fit_folds(blocks: DataFrame, size: int, n_classes: int, folds: int, base: Classifier) -> tuple[MarginModel, CalibratedSVC | None]:
    """The fit of all documents comes first: those of the folds start from it."""
    problems = [base.problem("train", left_out=k) for k in [*range(folds), None]]
    fitted = fit_together(blocks, problems, {"train": size}, n_classes, base.tol, base.max_iter)
    if not folds:
        return MarginModel(fitted[-1]), None
    weights = fitted[:folds]
    held = block_margins(blocks, {"train": weights}).filter("fold = model")
    margins = keep_table(held.select("fold", "y", "margins"))
    return MarginModel(fitted[-1]), CalibratedSVC(weights, _fit_sigmoids(margins, folds, n_classes))


def _fit_sigmoids(margins: DataFrame, folds: int, n: int, steps: int = 30) -> list[list[tuple[float, float]]]:
    """``(a, b)`` per fold and class of ``1 / (1 + exp(-(a * margin + b)))`` by Newton steps on smoothed targets.

    ``margins (fold, y, margins)``. All folds and classes advance together: a step is one aggregate over
    the margins and brings back five sums for each, which do not grow with the data.
    """
    sizes = np.zeros((folds, n))
    for r in margins.groupBy("fold", "y").count().collect():
        sizes[r["fold"], r["y"]] = r["count"]
    rest = sizes.sum(axis=1, keepdims=True) - sizes
    ab = np.stack([np.zeros((folds, n)), np.log((sizes + 1.0) / (rest + 1.0))], axis=-1)
    high, low = (sizes + 1.0) / (sizes + 2.0), 1.0 / (rest + 2.0)
    names = [f"s{i}" for i in range(5 * n)]
    for _ in range(steps):
        sent = margins.sparkSession.sparkContext.broadcast((ab, high, low))

        def sums(batches):
            ab, high, low = sent.value
            total = np.zeros((folds, n, 5))
            for batch in batches:
                fold, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "y"))
                m = np.asarray(batch.column("margins").flatten()).reshape(-1, n)
                for k in np.unique(fold):
                    own = fold == k
                    target = np.where(np.arange(n) == y[own, None], high[k], low[k])
                    p = 1.0 / (1.0 + np.exp(-(ab[k, :, 0] * m[own] + ab[k, :, 1])))
                    gap, curve = target - p, p * (1.0 - p)
                    total[k] += np.stack([(gap * m[own]).sum(0), gap.sum(0), (curve * m[own] * m[own]).sum(0), (curve * m[own]).sum(0), curve.sum(0)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(range(folds), pa.int32()), *(pa.array(c) for c in total.reshape(folds, -1).T)], names=["fold", *names])

        found = margins.select("fold", "y", "margins").mapInArrow(sums, ", ".join(["fold int", *(f"{c} double" for c in names)]))
        moved = 0.0
        for row in found.groupBy("fold").agg(*[F.sum(c) for c in names]).collect():
            k = row["fold"]
            for i in range(n):
                ga, gb, haa, hab, hbb = (row[1 + 5 * i + j] or 0.0 for j in range(5))
                haa, hbb = haa + 1e-9, hbb + 1e-9
                det = haa * hbb - hab * hab
                da, db = ((hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det) if det > 0 else (0.0, 0.0)
                # A damped step keeps separable classes from running away.
                scale = min(1.0, 5.0 / max(abs(da), abs(db), 1e-12))
                ab[k, i] += scale * da, scale * db
                moved = max(moved, abs(da), abs(db))
        sent.destroy()
        if moved < 1e-6:
            break
    return [[(float(a), float(b)) for a, b in fold] for fold in ab]
