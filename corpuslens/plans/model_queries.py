"""Queries: closed-form classifiers, Spark ML fits, model selection."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslens.operators import evaluate as E, experiments as G, fit as M, linear_scores as L, split as P
from corpuslens.operators.tfidf import FeatureUnion, word_block, word_char_blocks
from corpuslens.plans import sql as S
from corpuslens.plans.corpus import cleaned, cleaned_split, part
from corpuslens.plans.registry import query
from corpuslens.sources.models import load_first, save_model
from corpuslens.sources.tables import append_records, keep_table, read_csv, read_table, shared_folder, start_results, write_csv

# ---------------------------------------------------------------- shared plans

FEATURES = (1, 2, 2, 0.90, 25_000)  # word (1,2), min_df, max_df, max_features


def trained(spark, d, kind="multinomial", alpha=0.1, label="lang"):
    """Split corpus and a Naive Bayes model fitted on its training part."""
    docs = cleaned_split(spark, d, label)
    train = part(docs, "train")
    labels = L.class_labels(docs, label)
    fitted = word_block().fit(train, "doc_id", "clean")
    return docs, L.fit_naive_bayes(train, fitted, labels, kind, alpha, label)


def nb_sql(kind, alpha="0.1", where="split <> 'train'", label="lang"):
    return [
        S.CLEANED,
        S.split("s", "docs", label=label),
        "train AS MATERIALIZED (SELECT * FROM s WHERE split = 'train')",
        f"eval AS MATERIALIZED (SELECT * FROM s WHERE {where})",
        S.tokens("t", "s", keep=f"split, {label},"),
        S.word_counts("c", "t", 1, 2, f"split, {label},"),
        S.vocabulary("v", "c", "train", 2, 0.90, 25_000, "WHERE split = 'train'"),
        S.weights("w", "c", "v", f"split, {label},"),
        "tw AS (SELECT * FROM w WHERE split = 'train')",
        S.naive_bayes(kind, "tw", "v", "train", label=label, alpha=alpha),
        S.scores("sc", "eval", "w", label=label),
        S.argmax("best", "sc"),
    ]


def text_predictions(spark, d, kind="multinomial", label="source"):
    """``doc_id, split, y_true, y_pred`` of the validation and test documents."""
    docs, model = trained(spark, d, kind, label=label)
    held = part(docs, "val", "test")
    return docs, model.predict(held).join(held.select("doc_id", "split", label), "doc_id").select(
        "doc_id", "split", F.col(label).alias("y_true"), F.col("prediction").alias("y_pred")
    )


TEXT_PREDS = "preds AS MATERIALIZED (SELECT b.doc_id, e.split, e.source AS y_true, b.prediction AS y_pred FROM best b JOIN eval e ON e.doc_id = b.doc_id)"


def vector_predictions(spark, d):
    """``vec_id, split, y_true, y_pred`` from nearest centroids of the embeddings."""
    vectors = P.stratified_split(read_table(spark, d, "embeddings", spread="vec_id"), "vec_id", "label").persist()
    centroids = L.fit_centroids(part(vectors, "train"))
    found = L.centroid_classify(part(vectors, "val", "test"), centroids)
    return found.select("vec_id", "split", F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"), "cosine")


VECTOR_PREDS = [
    S.split("vs", "embeddings", "vec_id", "label"),
    "cells AS (SELECT vec_id, label, split, unnest(range(1, 65)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM vs)",
    "cen AS MATERIALIZED (SELECT label, pos, avg(v) AS v FROM cells WHERE split = 'train' GROUP BY label, pos)",
    "cn AS (SELECT label, sqrt(sum(v * v)) AS norm FROM cen GROUP BY label)",
    "vn AS (SELECT vec_id, sqrt(sum(v * v)) AS norm FROM cells GROUP BY vec_id)",
    "dots AS (SELECT c.vec_id, c.split, c.label AS y_true, m.label AS cand, sum(c.v * m.v) AS dot FROM cells c JOIN cen m ON c.pos = m.pos WHERE c.split <> 'train' GROUP BY ALL)",
    "cosines AS (SELECT d.vec_id, d.split, y_true, cand, dot / (vn.norm * cn.norm) AS cosine FROM dots d JOIN cn ON cn.label = d.cand JOIN vn ON vn.vec_id = d.vec_id)",
    "preds AS MATERIALIZED (SELECT vec_id, split, y_true, cand AS y_pred, cosine FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(cosine, 9) DESC, cand) AS rk FROM cosines) WHERE rk = 1)",
]


# ---------------------------------------------------------------- closed-form classifiers


_NB_RESULT = "SELECT b.doc_id, e.split, e.lang AS y_true, b.prediction AS y_pred, round(b.score, 6) AS score FROM best b JOIN eval e ON e.doc_id = b.doc_id"


def _nb_result(spark, d, kind):
    docs, model = trained(spark, d, kind)
    held = part(docs, "val", "test")
    found = model.predict(held).join(held.select("doc_id", "split", "lang"), "doc_id")
    return found.select(
        "doc_id", "split", F.col("lang").alias("y_true"), F.col("prediction").alias("y_pred"), F.round(F.array_max("scores"), 6).alias("score")
    )


@query(S.with_(*nb_sql("multinomial")) + _NB_RESULT)
def nb_multinomial(spark, d):
    return _nb_result(spark, d, "multinomial")


@query(S.with_(*nb_sql("complement")) + _NB_RESULT)
def nb_complement(spark, d):
    return _nb_result(spark, d, "complement")


@query(S.with_(*VECTOR_PREDS) + "SELECT vec_id, split, y_true, y_pred, round(cosine, 6) AS cosine FROM preds")
def centroid_classify(spark, d):
    return vector_predictions(spark, d).withColumn("cosine", F.round("cosine", 6))


def _folds_sql():
    fold = "CAST(('0x' || substr(md5('fold|' || doc_id), 1, 8))::BIGINT % 5 AS INTEGER)"
    per_fold = []
    for k in range(5):
        train_w = f"(SELECT * FROM tw WHERE fold <> {k})"
        per_fold.append(S.naive_bayes("complement", train_w, "v", "train", out=f"m{k}"))
    models = " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(5))
    return S.with_(
        S.CLEANED,
        S.split("s", "docs"),
        "train AS MATERIALIZED (SELECT * FROM s WHERE split = 'train')",
        S.tokens("t", "train", keep="lang,"),
        S.word_counts("c", "t", 1, 2, "lang,"),
        S.vocabulary("v", "c", "train", 2, 0.90, 25_000),
        S.weights("w", "c", "v", "lang,"),
        f"tw AS MATERIALIZED (SELECT *, {fold} AS fold FROM w)",
        *per_fold,
    ) + f"SELECT lang, term, round(avg(w) * 1000, 6) AS avg_w FROM ({models}) GROUP BY lang, term"


@query(_folds_sql())
def avg_fold_weights(spark, d):
    """Class weights averaged over five leave-one-fold-out fits."""
    train = part(cleaned_split(spark, d), "train").withColumn("fold", M.fold_id("doc_id"))
    fitted = word_block().fit(train, "doc_id", "clean")
    weights = L.fold_weights(train, fitted, L.class_labels(train))
    return weights.select("lang", "term", F.round(F.col("avg_w") * 1000, 6).alias("avg_w"))


# ---------------------------------------------------------------- selection among closed-form models


ALPHAS = (0.01, 0.1, 1.0)


def _records(spark, d):
    """One validation record per (kind, alpha): vocabulary and sums are shared by all of them, and a document is scored once for all."""
    docs = cleaned_split(spark, d)
    train, val = part(docs, "train"), part(docs, "val")
    labels = L.class_labels(docs)
    fitted = word_block().fit(train, "doc_id", "clean")
    grid = [(kind, alpha) for kind in ("multinomial", "complement") for alpha in ALPHAS]
    scores = L.scores_together(L.fit_bayes_grid(train, fitted, labels, grid), val)
    n, found = len(labels), []
    for order, (kind, alpha) in enumerate(grid, start=1):
        best = L.argmax_label(F.slice("scores", (order - 1) * n + 1, n), labels)
        found.append(F.struct(F.lit(order).cast("long").alias("run_order"), F.lit(kind).alias("classifier"), F.lit(alpha).alias("alpha"), best.alias("prediction")))
    rows = scores.join(val.select("doc_id", "lang"), "doc_id").select("lang", F.inline(F.array(*found)))
    by = ["run_order", "classifier", "alpha"]
    metrics = E.metrics_overall(E.confusion_counts(rows, "lang", "prediction", by=by), digits=4, by=by)
    return metrics.select(*by, "accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1")


def _records_sql():
    ctes = nb_sql("multinomial", where="split = 'val'")[:-3]
    parts = []
    for order, (kind, alpha) in enumerate([(k, a) for k in ("multinomial", "complement") for a in ALPHAS], start=1):
        m = f"m{order}"
        ctes += [
            S.naive_bayes(kind, "tw", "v", "train", out=m, alpha=str(alpha)),
            S.scores(f"{m}_sc", "eval", "w", model=m),
            S.argmax(f"{m}_b", f"{m}_sc"),
        ]
        parts.append(f"SELECT {order} AS run_order, '{kind}' AS classifier, {alpha}::DOUBLE AS alpha, e.lang AS y_true, b.prediction AS y_pred FROM {m}_b b JOIN eval e ON e.doc_id = b.doc_id")
    by = "run_order, classifier, alpha,"
    ctes += [f"preds AS ({' UNION ALL '.join(parts)})", S.confusion("preds", by), S.per_class(by), S.overall(by)]
    ctes += [
        "records AS MATERIALIZED (SELECT CAST(run_order AS BIGINT) AS run_order, classifier, alpha, round(accuracy, 4) AS accuracy, round(macro_precision, 4) AS macro_precision, "
        "round(macro_recall, 4) AS macro_recall, round(macro_f1, 4) AS macro_f1, round(weighted_f1, 4) AS weighted_f1 FROM total)"
    ]
    return S.with_(*ctes)


@query(_records_sql() + "SELECT *, row_number() OVER (ORDER BY macro_f1 DESC, accuracy DESC, run_order) AS rank FROM records")
def leaderboard(spark, d):
    return G.leaderboard(_records(spark, d))


@query(
    _records_sql() + "SELECT rank, classifier AS model, accuracy, macro_f1, weighted_f1 FROM "
    "(SELECT *, row_number() OVER (ORDER BY macro_f1 DESC, accuracy DESC, run_order) AS rank FROM records) WHERE rank <= 4"
)
def top_models(spark, d):
    return G.top_models(G.leaderboard(_records(spark, d)), 4)


@query(_records_sql() + "SELECT * FROM records ORDER BY macro_f1 DESC, run_order LIMIT 1")
def best_experiment(spark, d):
    return G.best_experiment(_records(spark, d))


# ---------------------------------------------------------------- Spark ML


def _ml(spark, d, blocks, label="lang"):
    docs = cleaned_split(spark, d)
    train = part(docs, "train")
    labels = L.class_labels(docs, label)
    union = FeatureUnion(blocks).fit(train)
    terms = keep_table(union.terms())
    size = terms.count()
    vectors = union.vectors(docs, terms, size, keep=[label, "split"])
    # Optimisers read their input dozens of times: a table behind it, memory in front of it.
    vectors = keep_table(M.with_label_index(vectors, labels, label), "doc_id").persist()
    return vectors, labels, size


def _svc_texts(spark, d, *fitted_on):
    """The split corpus, its labels, word and character features of its training documents, and the documents to be fitted with their class positions."""
    docs = cleaned_split(spark, d)
    labels = L.class_labels(docs)
    union = FeatureUnion(word_char_blocks()).fit(part(docs, "train"))
    terms = keep_table(union.terms())
    return docs, labels, union, terms, M.with_label_index(part(docs, *fitted_on), labels)


def svc_model(spark, d):
    """One-vs-rest SVC on word and character features of the training documents, as a table of weights."""
    docs, labels, union, terms, train = _svc_texts(spark, d, "train")
    size = terms.count()
    blocks = M.text_blocks(train, union, terms, size)
    model, _ = M.fit_svc_on_blocks(blocks, size, len(labels))
    blocks.unpersist()
    return docs, M.text_model(model, union, terms, labels)


def _calibrated(spark, d, *fitted_on, folds=5):
    docs, labels, union, terms, train = _svc_texts(spark, d, *fitted_on)
    size = terms.count()
    blocks = M.text_blocks(M.dealt(train, folds), union, terms, size, fold=F.col("fold"))
    plain, calibrated = M.fit_svc_on_blocks(blocks, size, len(labels), folds=folds)
    blocks.unpersist()
    return docs, labels, union, terms, plain, calibrated


def svc_models(spark, d):
    """The calibrated SVC, the plain one, and the plain one as a model that gives classes only."""
    docs, labels, union, terms, plain, calibrated = _calibrated(spark, d, "train")
    as_table = lambda model, **options: M.text_model(model, union, terms, labels, **options)
    return docs, {"calibrated": as_table(calibrated), "margins": as_table(plain), "classes": as_table(plain, classes_only=True)}


def _majority(rows, fitted_on, measured_on, label):
    """One row: sizes, classes, and how often the commonest fitted class is right."""
    fitted = F.col("split").isin(*fitted_on)
    top = rows.filter(fitted).groupBy(label).agg(F.count("*").alias("n")).agg(F.min_by(label, F.struct(-F.col("n"), label))).scalar()
    held = F.col("split").isin(*measured_on)
    return rows.agg(
        F.count_if(fitted).alias("n_train"),
        F.count_if(held).alias("n_held"),
        F.count_distinct(label).alias("n_classes"),
        F.round(F.count_if(held & (F.col(label) == top)) / F.count_if(held), 6).alias("majority_accuracy"),
    )


def _majority_sql(ctes, fitted_on, measured_on, label, rows="s"):
    fitted, held = (f"split IN ({', '.join(S.quote(x) for x in part_)})" for part_ in (fitted_on, measured_on))
    top = f"(SELECT {label} FROM {rows} WHERE {fitted} GROUP BY {label} ORDER BY count(*) DESC, {label} LIMIT 1)"
    return (
        S.with_(*ctes).rstrip()
        + f""",
    summary AS (SELECT count(*) FILTER ({fitted}) AS n_train, count(*) FILTER ({held}) AS n_held, count(DISTINCT {label}) AS n_classes,
      round(CAST(count(*) FILTER ({held} AND {label} = {top}) AS DOUBLE) / count(*) FILTER ({held}), 6) AS majority_accuracy FROM {rows})
    """
    )


_SPLIT = [S.CLEANED, S.split("s", "docs")]
_VSPLIT = [S.split("vs", "embeddings", "vec_id", "label")]
_HELD = ("val", "test")


def _verdict(rows, predictions, fitted_on, measured_on, label="lang"):
    """Sizes and the majority's accuracy, and whether the fit beats it."""
    accuracy = E.metrics_overall(E.confusion_counts(predictions)).first()["accuracy"]
    return _majority(rows, fitted_on, measured_on, label).withColumn("beats_majority", F.col("majority_accuracy") < accuracy)


def _fit(spark, d, classifier, blocks=None):
    vectors, labels, size = _ml(spark, d, blocks or [word_block()])
    train = part(vectors, "train")
    model = classifier.fit(train, train.count(), len(labels), size)
    predictions = M.predict_labels(model, part(vectors, *_HELD), labels, [F.col("lang").alias("y_true")])
    return _verdict(vectors.select("lang", "split"), predictions, ["train"], _HELD)


_FIT_SQL = _majority_sql(_SPLIT, ["train"], _HELD, "lang") + "SELECT *, true AS beats_majority FROM summary"


@query(_FIT_SQL)
def fit_linear_svc(spark, d):
    """One-vs-rest linear SVC on word TF-IDF."""
    return _fit(spark, d, M.Classifier("linear_svc"))


@query(_FIT_SQL)
def fit_logreg(spark, d):
    return _fit(spark, d, M.Classifier("logreg", C=2.0))


@query(_FIT_SQL)
def fit_sgd_log(spark, d):
    return _fit(spark, d, M.Classifier("sgd_log", class_weight="balanced"))


@query(_majority_sql(_SPLIT, ["train", "val"], ["test"], "lang") + "SELECT *, true AS beats_majority FROM summary")
def fit_calibrated_svc(spark, d):
    """Calibrated SVC on word and character features, trained on training plus validation documents."""
    docs, labels, union, terms, _, model = _calibrated(spark, d, "train", "val")
    found = M.text_model(model, union, terms, labels).predict(part(docs, "test")).select("doc_id", F.col("prediction").alias("y_pred"))
    predictions = part(docs, "test").select("doc_id", F.col("lang").alias("y_true")).join(found, "doc_id")
    return _verdict(docs.select("lang", "split"), predictions, ["train", "val"], ["test"])


def _embeddings(spark, d):
    vectors = P.stratified_split(read_table(spark, d, "embeddings", spread="vec_id"), "vec_id", "label")
    labels = L.class_labels(vectors, "label")
    return keep_table(M.with_label_index(M.embedding_vectors(vectors), labels, "label"), "vec_id").persist(), labels


def _fit_embeddings(spark, d, classifier):
    """Measured on the training vectors: the labels of these tables say nothing about vectors not seen."""
    vectors, labels = _embeddings(spark, d)
    train = part(vectors, "train")
    model = classifier.fit(train, train.count(), len(labels), 64)
    predictions = M.predict_labels(model, train, labels, [F.col("label").alias("y_true")])
    return _verdict(vectors.select("label", "split"), predictions, ["train"], ["train"], "label")


_EMBEDDING_SQL = _majority_sql(_VSPLIT, ["train"], ["train"], "label", "vs") + "SELECT *, true AS beats_majority FROM summary"


@query(_EMBEDDING_SQL)
def fit_embedding_logreg(spark, d):
    return _fit_embeddings(spark, d, M.Classifier("logreg", C=2.0))


@query(_EMBEDDING_SQL)
def fit_mlp(spark, d):
    """Two hidden layers on the embeddings."""
    return _fit_embeddings(spark, d, M.Classifier("mlp", max_iter=80, layers=(256, 128)))


@query()
def embedding_fits_held_out(spark, d):
    """Both fits measured on vectors that they did not see, beside the commonest class; the labels of the given tables say nothing about those."""
    vectors, labels = _embeddings(spark, d)
    train, held = part(vectors, "train"), part(vectors, *_HELD)
    sizes = _majority(vectors.select("label", "split"), ["train"], _HELD, "label")
    out = None
    for classifier in (M.Classifier("logreg", C=2.0), M.Classifier("mlp", max_iter=80, layers=(256, 128))):
        model = classifier.fit(train, train.count(), len(labels), 64)
        confusion = E.confusion_counts(M.predict_labels(model, held, labels, [F.col("label").alias("y_true")]))
        row = E.metrics_overall(confusion, 4).first()
        rows = sizes.select(F.lit(classifier.kind).alias("classifier"), "*", F.lit(row["accuracy"]).alias("accuracy"), F.lit(row["macro_f1"]).alias("macro_f1"))
        out = rows if out is None else out.unionByName(rows)
    vectors.unpersist()
    return out


def _board(spark, d, grid, blocks):
    """Runs a grid; records are appended to a results table as they come, and the table is read back and ranked."""
    docs = cleaned_split(spark, d).select("doc_id", "lang", "clean", "split")
    path = f"{shared_folder(spark).rstrip('/')}/results-{uuid.uuid4().hex}"
    start_results(spark, path, G.RECORD)
    G.run_experiments(docs, grid, blocks, on_record=lambda r: append_records(r, path))
    return docs, G.leaderboard(spark.read.schema(G.RECORD).parquet(path))


def _run(spark, d, grid, blocks):
    """What SQL can say of a grid: its configurations, the sizes, and that each beats the commonest class."""
    docs, board = _board(spark, d, grid, blocks)
    summary = _majority(docs.select("lang", "split"), ["train"], ["val"], "lang")
    rows = board.select("experiment_id", "feature_type", "classifier", "C", "class_weight", "accuracy").withColumn("one", F.lit(1))
    rows = rows.join(F.broadcast(summary.withColumn("one", F.lit(1))), "one").drop("one")
    return rows.withColumn("beats_majority", F.col("majority_accuracy") < F.col("accuracy")).drop("accuracy")


_RANKED = ["rank", "experiment_id", "feature_type", "classifier", "C", "class_weight", "n_features", "accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"]


# Ranks and metrics of fits can't be said in SQL; the tests hold the fits against a plain solver.
@query()
def experiment_ranking(spark, d):
    """The 15 configurations with their ranks and metrics."""
    return _board(spark, d, G.experiment_grid(), G.GRID_BLOCKS)[1].select(_RANKED)


@query()
def comparison_ranking(spark, d):
    """Model families by feature set with their ranks and metrics."""
    return _board(spark, d, G.comparison_grid(), G.COMPARISON_BLOCKS)[1].select(_RANKED)


@query()
def optimisation_reports(spark, d):
    """The ranking of the 21 candidates and the winner's report tables, written as CSV and read back, cell by cell: ``report, row, name, value``."""
    docs, board = _board(spark, d, G.optimisation_grid(), G.OPTIMISATION_BLOCKS)
    winner = G.best_experiment(board.drop("rank"))
    experiment = next(e for e in G.optimisation_grid() if e.experiment_id == winner.first()["experiment_id"])
    tables = {"leaderboard": board.select(_RANKED)} | G.candidate_reports(docs, winner, experiment, G.OPTIMISATION_BLOCKS)
    path = f"{shared_folder(spark).rstrip('/')}/reports-{uuid.uuid4().hex}"
    out = None
    for name, table in tables.items():
        write_csv(table, f"{path}/{name}")
        n_keys = 2 if "y_pred" in table.columns else 1
        cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in table.columns[n_keys:]])
        rows = read_csv(spark, f"{path}/{name}", table.schema).select(F.lit(name).alias("report"), F.concat_ws(" / ", *table.columns[:n_keys]).alias("row"), F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out


def _grid_sql(grid, blocks):
    rows = []
    for e in grid:
        channels = {blocks[k].channel[:4] for k in e.blocks}
        kind = "word_char_fusion" if len(channels) > 1 else f"{channels.pop()}_tfidf"
        clf = e.classifier
        c = f"{clf.C}::DOUBLE" if clf.kind in G.HAS_C else "NULL::DOUBLE"
        rows.append(f"({S.quote(e.experiment_id)}, {S.quote(kind)}, {S.quote(clf.kind)}, {c}, {S.quote(clf.class_weight or 'None')})")
    head = _majority_sql(_SPLIT, ["train"], ["val"], "lang")
    return head + f"SELECT e.*, summary.*, true AS beats_majority FROM (VALUES {', '.join(rows)}) e(experiment_id, feature_type, classifier, C, class_weight), summary"


@query(_grid_sql(G.experiment_grid(), G.GRID_BLOCKS))
def experiment_grid(spark, d):
    """The 15 configurations."""
    return _run(spark, d, G.experiment_grid(), G.GRID_BLOCKS)


@query(_grid_sql(G.optimisation_grid(), G.OPTIMISATION_BLOCKS))
def optimisation_grid(spark, d):
    """The 21 candidates around the winner."""
    return _run(spark, d, G.optimisation_grid(), G.OPTIMISATION_BLOCKS)


@query(_grid_sql(G.comparison_grid(), G.COMPARISON_BLOCKS))
def model_comparison(spark, d):
    """Model families by feature set; the network sees NETWORK_TERMS terms of each channel."""
    return _run(spark, d, G.comparison_grid(), G.COMPARISON_BLOCKS)


@query(S.with_(*nb_sql("multinomial", where="true")) + "SELECT doc_id, prediction, round(score, 6) AS score FROM best")
def model_roundtrip(spark, d):
    """A saved model, found again by the fallback order, scores all documents."""
    docs, model = trained(spark, d)
    path = f"{shared_folder(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    save_model(model, f"{path}/final")
    loaded = load_first(spark, [f"{path}/best", f"{path}/final"])
    return loaded.predict(docs).select("doc_id", "prediction", F.round(F.array_max("scores"), 6).alias("score"))
