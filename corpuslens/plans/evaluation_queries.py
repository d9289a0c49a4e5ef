"""Queries: metrics, error analysis, scoring and dictionary tags."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslens.functions import cleaning as C
from corpuslens.functions.fixed import EMPTY_MESSAGE, EVIDENCE_CANDIDATES, PREVIEW_CHARS, SHORT_MESSAGE, SKILLS
from corpuslens.functions.text import display_label, literal_pattern, preview
from corpuslens.operators import evaluate as E, scoring as X
from corpuslens.plans import sql as S
from corpuslens.plans.corpus import documents, part
from corpuslens.plans.model_queries import TEXT_PREDS, VECTOR_PREDS, nb_sql, svc_model, svc_models, text_predictions, trained, vector_predictions
from corpuslens.plans.registry import query
from corpuslens.sources.models import load_model, save_model
from corpuslens.sources.tables import keep_table, read_csv, read_json, read_table, shared_folder, write_csv, write_json
from corpuslens.streaming.score_stream import score_stream

# ---------------------------------------------------------------- metrics

_METRICS = ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1")
_VECTOR = S.with_(*VECTOR_PREDS, S.confusion("preds"), S.per_class(), S.overall())
_TEXT = S.with_(*nb_sql("multinomial", label="source"), TEXT_PREDS, S.confusion("preds"), S.per_class(), S.overall())
_OVERALL = "SELECT " + ", ".join(f"round({m}, 6) AS {m}" for m in _METRICS) + ", n_docs FROM total"


def _vector_confusion(spark, d):
    return E.confusion_counts(vector_predictions(spark, d))


@query(_VECTOR + _OVERALL)
def metrics_overall(spark, d):
    return E.metrics_overall(_vector_confusion(spark, d))


@query(_TEXT + _OVERALL)
def metrics_overall_text(spark, d):
    return E.metrics_overall(E.confusion_counts(text_predictions(spark, d)[1]))


@query(_VECTOR + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM classes")
def metrics_per_class(spark, d):
    return E.metrics_per_class(_vector_confusion(spark, d))


@query(
    _VECTOR
    + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM classes "
    "UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n_docs FROM total "
    "UNION ALL SELECT 'macro avg', round(macro_precision, 6), round(macro_recall, 6), round(macro_f1, 6), n_docs FROM total "
    "UNION ALL SELECT 'weighted avg', round(weighted_precision, 6), round(weighted_recall, 6), round(weighted_f1, 6), n_docs FROM total"
)
def classification_report(spark, d):
    return E.classification_report(_vector_confusion(spark, d))


_MATRIX = (
    _VECTOR.rstrip()
    + ",\nml AS (SELECT y_true AS l FROM conf UNION SELECT y_pred FROM conf),\n"
    "matrix AS (SELECT a.l AS y_true, b.l AS y_pred, coalesce(n, 0) AS n FROM ml a CROSS JOIN ml b LEFT JOIN conf ON conf.y_true = a.l AND conf.y_pred = b.l)\n"
)


@query(_MATRIX + "SELECT * FROM matrix")
def confusion_matrix(spark, d):
    return E.confusion_matrix(_vector_confusion(spark, d).persist())


_CLASSES = "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM classes"


@query(
    _MATRIX.rstrip()
    + ", given AS (SELECT l FROM ml UNION SELECT 'none'), grid AS (SELECT a.l AS y_true, b.l AS y_pred, coalesce(n, 0) AS n FROM given a CROSS JOIN given b "
    "LEFT JOIN conf ON conf.y_true = a.l AND conf.y_pred = b.l), "
    "lines AS (SELECT y_true, string_agg(n::VARCHAR, ',' ORDER BY y_pred) AS matrix_row FROM grid GROUP BY y_true) "
    "SELECT y_true AS label, round(coalesce(precision, 0.0), 6) AS precision, round(coalesce(recall, 0.0), 6) AS recall, round(coalesce(f1, 0.0), 6) AS f1, "
    "coalesce(support, 0)::BIGINT AS support, matrix_row, "
    "(SELECT round(accuracy, 6) FROM total) AS accuracy FROM lines LEFT JOIN classes ON label = y_true"
)
def metrics_document(spark, d):
    """The nested metrics document, with a class that does not occur, written as JSON and read back."""
    confusion = _vector_confusion(spark, d).persist()
    labels = sorted([str(i) for i in range(10)] + ["none"])
    document = E.metrics_document(confusion, labels)
    path = f"{shared_folder(spark).rstrip('/')}/metrics-{uuid.uuid4().hex}"
    write_json(document, path)
    read = read_json(spark, path, document.schema)
    lines = read.select("accuracy", "report", F.explode(F.arrays_zip("labels", "confusion_matrix")).alias("m"))
    found = F.col("report")[F.col("m.labels")]
    rates = [F.coalesce(found[c], F.lit(0.0)).alias(c) for c in ("precision", "recall", "f1")]
    return lines.select(
        F.col("m.labels").alias("label"), *rates, F.coalesce(found["support"], F.lit(0)).alias("support"), F.array_join(F.transform("m.confusion_matrix", lambda n: n.cast("string")), ",").alias("matrix_row"), "accuracy",
    )


@query(_VECTOR + _CLASSES)
def report_csv(spark, d):
    """A report table written as CSV and read back with its schema."""
    report = E.metrics_per_class(_vector_confusion(spark, d))
    path = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    write_csv(report, path)
    return read_csv(spark, path, report.schema)


@query(_MATRIX + "SELECT y_true, " + ", ".join(f"CAST(sum(n) FILTER (y_pred = '{i}') AS BIGINT) AS \"{i}\"" for i in range(10)) + " FROM matrix GROUP BY y_true")
def confusion_matrix_wide(spark, d):
    matrix = E.confusion_matrix(_vector_confusion(spark, d).persist())
    return E.confusion_wide(matrix, [str(i) for i in range(10)])


@query(_MATRIX + "SELECT y_true, y_pred, CASE WHEN sum(n) OVER (PARTITION BY y_true) = 0 THEN 0.0 ELSE round(n / CAST(sum(n) OVER (PARTITION BY y_true) AS DOUBLE), 6) END AS share FROM matrix")
def confusion_normalized(spark, d):
    return E.confusion_normalized(E.confusion_matrix(_vector_confusion(spark, d).persist()))


@query(
    _VECTOR
    + "SELECT y_true, y_pred, n, error_pct FROM (SELECT *, round(n * 100.0 / CAST(sum(n) OVER (PARTITION BY y_true) AS DOUBLE), 6) AS error_pct FROM conf) "
    "WHERE y_true <> y_pred ORDER BY n DESC, y_true, y_pred LIMIT 20"
)
def top_confusions(spark, d):
    return E.top_confusions(_vector_confusion(spark, d), 20)


@query(
    _VECTOR
    + "SELECT kind, rank, label, round(f1, 6) AS f1, support FROM (SELECT 'strong' AS kind, *, row_number() OVER (ORDER BY round(f1, 6) DESC, label) AS rank FROM classes "
    "UNION ALL SELECT 'weak', *, row_number() OVER (ORDER BY round(f1, 6), label) FROM classes) WHERE rank <= 5"
)
def strong_weak_classes(spark, d):
    return E.strong_weak_classes(_vector_confusion(spark, d))


@query(
    S.with_(*nb_sql("complement", label="source"), TEXT_PREDS)
    + f"SELECT p.doc_id, y_true, y_pred, trim(replace(substr(d.text, 1, 250), chr(10), ' ')) AS snippet, CAST({S.word_count('d.text')} AS BIGINT) AS word_len "
    "FROM (SELECT * FROM preds WHERE y_true <> y_pred ORDER BY doc_id LIMIT 6) p JOIN docs d ON d.doc_id = p.doc_id"
)
def error_samples(spark, d):
    docs, found = text_predictions(spark, d, "complement")
    return E.error_samples(found, docs)


_COMPARE = S.with_(*VECTOR_PREDS, S.confusion("preds", "split,"), S.per_class("split,"), S.overall("split,"))


@query(
    _COMPARE
    + "SELECT "
    + ", ".join(f"max(round({m}, 4)) FILTER (split = 'val') AS val_{m}" for m in ("accuracy", "macro_f1", "weighted_f1"))
    + ", "
    + ", ".join(f"max(round({m}, 4)) FILTER (split = 'test') AS test_{m}" for m in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_f1"))
    + " FROM total"
)
def val_test_compare(spark, d):
    return E.compare_splits(E.confusion_counts(vector_predictions(spark, d), by=["split"]))


@query(S.with_(S.VALID, S.CORPUS) + "SELECT count(*) AS n_docs, true AS timed FROM corpus")
def scoring_latency(spark, d):
    """Documents scored, and whether the milliseconds per document were measured."""
    docs, model = trained(spark, d)
    n = docs.count()
    ms = E.latency_ms(model.predict(docs), n, iterations=2)
    return spark.createDataFrame([(n, ms > 0)], "n_docs long, timed boolean")


# ---------------------------------------------------------------- scoring


_CHECKED = S.with_(
    f"c AS MATERIALIZED (SELECT doc_id, text, CAST({S.word_count(S.clean('text'))} AS BIGINT) AS n FROM documents)",
    f"checked AS (SELECT doc_id, n AS cleaned_word_count, CASE WHEN trim(coalesce(text, '')) = '' THEN {S.quote(EMPTY_MESSAGE)} WHEN n < 5 THEN {S.quote(SHORT_MESSAGE)} END AS error_message FROM c)",
)


@query(_CHECKED + "SELECT doc_id, cleaned_word_count, error_message, error_message IS NULL AS success FROM checked")
def validate_inputs(spark, d):
    docs = C.clean_text(documents(spark, d), "text", "clean")
    return X.validate_inputs(docs).select("doc_id", "cleaned_word_count", "error_message", "success")


_NB = S.with_(*nb_sql("multinomial", where="true"))
_SOFT = (
    _NB.rstrip()
    + ",\nsoft AS MATERIALIZED (SELECT doc_id, label, score, exp(score - max(score) OVER (PARTITION BY doc_id)) / "
    "sum(exp(score - m)) OVER (PARTITION BY doc_id) AS share FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS m FROM sc)),\n"
    "ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank FROM soft)\n"
)


def _all_scores(spark, d):
    docs, model = trained(spark, d)
    return model, model.scores(docs)


def _by_label(df, labels, values, name):
    pairs = F.arrays_zip(F.array(*[F.lit(v) for v in labels]).alias("label"), values.alias("value"))
    return df.select("doc_id", F.inline(pairs).alias("label", "value")).select("doc_id", "label", F.round("value", 6).alias(name))


@query(_SOFT + "SELECT doc_id, label, round(share, 6) AS share FROM soft")
def softmax_scores(spark, d):
    model, scores = _all_scores(spark, d)
    return _by_label(scores.withColumn("s", X.softmax(F.col("scores"))), model.labels, F.col("s"), "share")


@query(_SOFT + "SELECT doc_id, rank, label, round(score, 4) AS score FROM ranked WHERE rank <= 3")
def top3_classes(spark, d):
    model, scores = _all_scores(spark, d)
    top = scores.select("doc_id", F.posexplode(X.top_classes(F.col("scores"), model.labels)).alias("pos", "c"))
    return top.select("doc_id", (F.col("pos") + 1).cast("long").alias("rank"), "c.label", F.round("c.score", 4).alias("score"))


@query(
    _SOFT
    + "SELECT doc_id, rank, round(CASE WHEN hi - lo > 1e-6 THEN 100.0 - 55.0 * (hi - score) / (hi - lo) ELSE 100.0 END, 6) AS margin FROM "
    "(SELECT *, max(score) OVER (PARTITION BY doc_id) AS hi, min(score) OVER (PARTITION BY doc_id) AS lo FROM ranked WHERE rank <= 3)"
)
def relative_margins(spark, d):
    model, scores = _all_scores(spark, d)
    top = scores.select("doc_id", X.top_classes(F.col("scores"), model.labels)["score"].alias("s"))
    bars = top.select("doc_id", F.posexplode(X.relative_margins(F.col("s"))).alias("pos", "margin"))
    return bars.select("doc_id", (F.col("pos") + 1).cast("long").alias("rank"), F.round("margin", 6).alias("margin"))




def _score_sql(rows):
    """Class scores of raw ``rows (doc_id, text)`` by the model of the clean corpus."""
    return (
        S.with_(
            *nb_sql("multinomial")[:-2],
            f"raw AS MATERIALIZED (SELECT doc_id, text, {S.clean('text')} AS clean FROM ({rows}))",
            S.tokens("rt", "raw"),
            S.word_counts("rc", "rt", 1, 2),
            S.weights("rw", "rc", "v"),
            S.scores("sc", "raw", "rw"),
        ).rstrip()
        + _RANKED
    )


_RANKED = (
    ",\nsoft AS MATERIALIZED (SELECT doc_id, label, score, exp(score - m) / sum(exp(score - m)) OVER (PARTITION BY doc_id) AS share FROM (SELECT *, max(score) OVER (PARTITION BY doc_id) AS m FROM sc)),\n"
    "ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank FROM soft),\n"
    f"n AS (SELECT doc_id, trim(coalesce(text, '')) = '' AS blank, CAST({S.word_count('clean')} AS BIGINT) AS n FROM raw)\n"
    "SELECT n.doc_id, n >= 5 AS success, CASE WHEN n >= 5 THEN r1.label END AS predicted_category, CASE WHEN n >= 5 THEN round(r1.share, 4) END AS confidence, "
    "CASE WHEN n >= 5 THEN 'calibrated_probability' END AS confidence_type, CASE WHEN n >= 5 THEN r2.label END AS second, CASE WHEN n >= 5 THEN r3.label END AS third, "
    f"n AS cleaned_word_count, CASE WHEN blank THEN {S.quote(EMPTY_MESSAGE)} WHEN n < 5 THEN {S.quote(SHORT_MESSAGE)} END AS error_message FROM n "
    "LEFT JOIN ranked r1 ON r1.doc_id = n.doc_id AND r1.rank = 1 LEFT JOIN ranked r2 ON r2.doc_id = n.doc_id AND r2.rank = 2 LEFT JOIN ranked r3 ON r3.doc_id = n.doc_id AND r3.rank = 3"
)


def _flat(scored):
    return scored.select(
        "doc_id", "success", "predicted_category", "confidence", "confidence_type",
        F.get("top_classes", F.lit(1))["label"].alias("second"), F.get("top_classes", F.lit(2))["label"].alias("third"),
        "cleaned_word_count", "error_message",
    )


@query(_score_sql("SELECT doc_id, text FROM documents"))
def score_docs(spark, d):
    """The batch form of scoring one text, for all raw documents: checks, class, confidence, runners-up, messages."""
    _, model = trained(spark, d)
    return _flat(X.score_docs(C.clean_text(documents(spark, d), "text", "clean"), model))


@query(_score_sql("SELECT conv_id * 4294967296 + turn AS doc_id, text FROM conversations"))
def score_stream_docs(spark, d):
    """The same scoring on a stream of conversation texts, run until the input is used up."""
    _, model = trained(spark, d)
    path = f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    source = read_table(spark, d, "conversations")
    key = (F.shiftleft("conv_id", 32) + F.col("turn")).alias("doc_id")
    source.select(key, "text").write.parquet(f"{path}/in")
    stream = spark.readStream.schema("doc_id long, text string").parquet(f"{path}/in")
    score_stream(stream, model, f"{path}/out", f"{path}/state").awaitTermination()
    return _flat(spark.read.parquet(f"{path}/out"))


_EXPLAIN = S.with_(*nb_sql("complement", where="true"))


@query(
    _EXPLAIN
    + "SELECT doc_id, prediction, rank, feature, score, 'word_token' AS type FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, feature) AS rank FROM "
    "(SELECT b.doc_id, b.prediction, w.term AS feature, round(w.w * m.w * 1000, 9) AS score FROM best b JOIN w ON w.doc_id = b.doc_id JOIN model m ON m.term = w.term AND m.lang = b.prediction) "
    "WHERE score > 0) WHERE rank <= 8"
)
def explain_top_terms(spark, d):
    """The eight terms that speak most for each document's class."""
    docs, model = trained(spark, d, "complement")
    scaled = model.table.withColumn("weights", F.transform("weights", lambda w: w * 1000))
    model = type(model)(model.union, scaled, model.labels, model.intercepts, model.confidence_type)
    return model.explain(docs)


@query(
    _CHECKED + "SELECT doc_id, error_message IS NULL AS success, CASE WHEN error_message IS NULL THEN 'calibrated_decision_softmax' END AS confidence_type, "
    "error_message IS NULL AS has_class, CASE WHEN error_message IS NULL THEN 3 ELSE 0 END AS n_top, cleaned_word_count FROM checked"
)
def score_svc_docs(spark, d):
    """All raw documents, invalid ones included, scored by a fitted SVC that was saved and loaded again."""
    _, model = svc_model(spark, d)
    path = f"{shared_folder(spark).rstrip('/')}/svc-{uuid.uuid4().hex}"
    save_model(model, path)
    scored = X.score_docs(C.clean_text(documents(spark, d), "text", "clean"), load_model(spark, path))
    sure = F.col("predicted_category").isNotNull() & (F.col("confidence") > 1 / 4)
    n_top = F.coalesce(F.size("top_classes"), F.lit(0))
    return scored.select("doc_id", "success", "confidence_type", sure.alias("has_class"), F.greatest(n_top, F.lit(0)).alias("n_top"), "cleaned_word_count")


@query()
def confidence_types(spark, d):
    """All raw documents under three models that were saved and loaded: calibrated probabilities, margins, and classes only, with the best terms of the first."""
    _, models = svc_models(spark, d)
    loaded = {}
    for name, model in models.items():
        path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        save_model(model, path)
        loaded[name] = load_model(spark, path)
    raw = C.clean_text(documents(spark, d).select("doc_id", "text"), "text", "clean")
    rows = X.score_docs_together(raw, loaded, explained="calibrated")
    top = F.transform("top_classes", lambda t: F.struct(t["label"].alias("label"), F.round(t["score"], 4).alias("score")))
    terms = F.transform("best_terms", lambda t: F.struct(t["feature"].alias("feature"), F.round(t["score"], 4).alias("score"), t["type"].alias("type")))
    return rows.select("model", "doc_id", "success", "predicted_category", "confidence", "confidence_type", F.to_json(top).alias("top_classes"), F.to_json(terms).alias("best_terms"))


@query(
    S.with_(S.CLEANED) + "SELECT count(*) AS n_docs, true AS both_channels, true AS at_most_eight, true AS all_positive FROM docs"
)
def explain_svc(spark, d):
    """Words and subwords that speak for the SVC's class of every document; checked as a whole."""
    docs, model = svc_model(spark, d)
    found = model.explain(docs)
    return found.agg(
        F.count_distinct("doc_id").alias("n_docs"),
        (F.count_distinct("type") == 2).alias("both_channels"),
        (F.max("rank") <= 8).alias("at_most_eight"),
        (F.min("score") > 0).alias("all_positive"),
    )


# ---------------------------------------------------------------- dictionary tags and statistics

_DEMO = "Built REST APIs and PySpark jobs in C++ / R, data science, Valuation. "


def _found(phrases, word, text="text"):
    edge = "a-zA-Z0-9" if not word else S.WORD
    cases = [
        f"CASE WHEN regexp_matches({text}, '(?i)(^|[^{edge}]){literal_pattern(p)}([^{edge}]|$)') THEN {S.quote(p)} END" for p in phrases
    ]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


_ORDERED = sorted(dict.fromkeys(SKILLS), key=str.lower)
_TAGGED = S.with_(
    f"tagged AS MATERIALIZED (SELECT doc_id, text, CASE WHEN doc_id % 3 = 0 THEN {S.quote(_DEMO)} WHEN doc_id % 3 = 1 THEN 'System Design and Testing in Go. ' ELSE '' END || text AS t FROM documents)",
    f"k AS MATERIALIZED (SELECT doc_id, t, {_found(_ORDERED, False, 't')} AS skills, {_found(EVIDENCE_CANDIDATES, True, 't')} AS extra FROM tagged)",
)


def _tech_docs(spark, d):
    lead = F.when(F.col("doc_id") % 3 == 0, _DEMO).when(F.col("doc_id") % 3 == 1, "System Design and Testing in Go. ").otherwise("")
    return documents(spark, d).select("doc_id", F.concat(lead, F.col("text")).alias("t"))


@query(_TAGGED + "SELECT doc_id, CAST(len(skills) AS BIGINT) AS n_skills, array_to_string(skills, '|') AS skills FROM k")
def detect_terms(spark, d):
    docs = _tech_docs(spark, d).withColumn("skills", X.detect_terms("t"))
    return docs.select("doc_id", F.size("skills").cast("long").alias("n_skills"), F.array_join("skills", "|").alias("skills"))


@query(
    _TAGGED
    + "SELECT doc_id, array_to_string(CASE WHEN len(skills) >= 3 THEN list_slice(skills, 1, 5) ELSE "
    "list_slice(list_concat(skills, list_filter(extra, lambda x: NOT list_contains(skills, x))), 1, 5) END, '|') AS evidence FROM k"
)
def evidence_terms(spark, d):
    return X.with_tags(_tech_docs(spark, d), "t").select("doc_id", F.array_join("evidence", "|").alias("evidence"))


@query(
    _TAGGED.rstrip()
    + rf""",
    f AS (SELECT doc_id, skills, t, CAST({S.word_count('t')} AS BIGINT) AS n_words, CAST(len(list_filter(string_split_regex(t, '[.!?]'), lambda x: regexp_matches(x, '[{S.WORD}]'))) AS BIGINT) AS n_sentences,
      regexp_extract_all(lower(t), '[{S.WORD}]+') AS words FROM k)
    SELECT doc_id, n_words, length(t) AS n_chars_raw, CAST(len(skills) AS BIGINT) AS n_skills, n_sentences,
      CASE WHEN n_sentences = 0 THEN 0.0 ELSE round(CAST(n_words AS DOUBLE) / n_sentences, 6) END AS avg_sentence_len,
      CASE WHEN len(words) = 0 THEN 0.0 ELSE round(CAST(len(list_distinct(words)) AS DOUBLE) / len(words), 6) END AS vocabulary_density FROM f"""
)
def document_stats(spark, d):
    stats = X.document_stats(X.with_tags(_tech_docs(spark, d), "t"), "t")
    return stats.select("doc_id", "n_words", "n_chars_raw", "n_skills", "n_sentences", "avg_sentence_len", "vocabulary_density")


_TITLE = "array_to_string(list_transform(string_split(replace(lower(l), '-', ' '), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"


@query(f"SELECT l AS label, {_TITLE} AS display FROM (SELECT DISTINCT upper(lang || '-' || source) AS l FROM documents)")
def label_display(spark, d):
    labels = documents(spark, d).select(F.upper(F.concat_ws("-", "lang", "source")).alias("label")).distinct()
    return labels.select("label", display_label("label").alias("display"))


@query(f"SELECT doc_id, CASE WHEN length(text) > {PREVIEW_CHARS} THEN substr(text, 1, {PREVIEW_CHARS}) || '...' ELSE text END AS preview FROM documents")
def text_preview(spark, d):
    return documents(spark, d).select("doc_id", preview("text", PREVIEW_CHARS).alias("preview"))
