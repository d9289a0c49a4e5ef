import math

import pytest
from pyspark.sql import functions as F

from corpuslens.functions.fixed import EMPTY_MESSAGE, SHORT_MESSAGE, SKILLS
from corpuslens.operators import evaluate as E, experiments as G, fit as M, linear_scores as L, scoring as X
from corpuslens.operators.tfidf import Block
from corpuslens.sources import tables as IO


def test_metrics_literals(spark):
    df = spark.createDataFrame([("IT", "IT"), ("HR", "HR"), ("SALES", "IT")], "y_true string, y_pred string")
    confusion = E.confusion_counts(df).persist()
    row = E.metrics_overall(confusion).first()
    assert row["accuracy"] == pytest.approx(2 / 3, abs=1e-6) and row["macro_f1"] == pytest.approx(5 / 9, abs=1e-6)
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in E.metrics_per_class(confusion).collect()}
    assert got == {"IT": (0.5, 1.0, 0.666667, 1), "HR": (1.0, 1.0, 1.0, 1), "SALES": (0.0, 0.0, 0.0, 1)}
    matrix = E.confusion_matrix(confusion)
    assert matrix.count() == 9 and matrix.agg(F.sum("n")).first()[0] == 3
    wide = {r["y_true"]: (r["HR"], r["IT"], r["SALES"]) for r in E.confusion_wide(matrix, ["HR", "IT", "SALES"]).collect()}
    assert wide == {"HR": (1, 0, 0), "IT": (0, 1, 0), "SALES": (0, 1, 0)}
    assert E.top_confusions(confusion).first()["error_pct"] == 100.0
    assert E.classification_report(confusion).count() == 6


def test_label_only_predicted_counts_in_the_macro_mean(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "y_true string, y_pred string")
    row = E.metrics_overall(E.confusion_counts(df)).first()
    assert row["macro_recall"] == 0.25 and row["weighted_recall"] == 0.5


# Stored experiment results (id, macro F1, accuracy) in run order.
RESULTS = [
    ("A1", 0.5649, 0.6237), ("A2", 0.5340, 0.5995), ("A3", 0.5691, 0.6263), ("A4", 0.5291, 0.5941), ("B1", 0.5729, 0.6317),
    ("B2", 0.5970, 0.6532), ("B3", 0.5894, 0.6478), ("B4", 0.5954, 0.6532), ("C1", 0.5855, 0.6398), ("C2", 0.5737, 0.6317),
    ("C3", 0.5761, 0.6317), ("C4", 0.5808, 0.6371), ("D1", 0.5594, 0.6183), ("D2", 0.5737, 0.6317), ("D3", 0.5735, 0.6290),
]


def test_stored_results_give_the_stored_leaderboard(spark):
    rows = [(i, *r) for i, r in enumerate(RESULTS, start=1)]
    records = spark.createDataFrame(rows, "run_order int, experiment_id string, macro_f1 double, accuracy double").repartition(4)
    order = [r["experiment_id"] for r in G.leaderboard(records).orderBy("rank").collect()]
    assert order == "B2 B4 B3 C1 C4 C3 C2 D2 D3 B1 A3 A1 D1 A2 A4".split()
    assert G.best_experiment(records).first()["experiment_id"] == "B2"


def test_grids():
    assert [len(g()) for g in (G.experiment_grid, G.optimisation_grid, G.comparison_grid)] == [15, 21, 23]
    assert all(k in G.OPTIMISATION_BLOCKS for e in G.optimisation_grid() for k in e.blocks)


def test_softmax_and_bars(spark):
    df = spark.createDataFrame([([1.0, 0.0, -1.0],), ([2.0, 2.0, 2.0],)], "s array<double>")
    rows = df.select(X.softmax(F.col("s")).alias("p"), X.relative_margins(F.col("s")).alias("b")).collect()
    assert rows[0]["p"] == pytest.approx([0.665241, 0.244728, 0.090031], abs=1e-6) and rows[0]["b"] == [100.0, 72.5, 45.0]
    assert sum(rows[1]["p"]) == pytest.approx(1.0) and rows[1]["b"] == [100.0, 100.0, 100.0]


def test_input_checks(spark):
    df = spark.createDataFrame([(1, ""), (2, "one two three four"), (3, "one two three four five"), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["success"], r["error_message"]) for r in X.validate_inputs(df, "text", None).collect()}
    assert got == {1: (False, EMPTY_MESSAGE), 2: (False, SHORT_MESSAGE), 3: (True, None), 4: (False, EMPTY_MESSAGE)}


def test_dictionary_tags(spark):
    assert len(SKILLS) == 146
    texts = ["REST APIs and PySpark in C++ / R", "system design, testing and automation with SQL", "nothing here", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = {r["id"]: (r["skills"], r["evidence"]) for r in X.with_tags(df).collect()}
    assert got[0][0] == ["C++", "PySpark", "R", "REST APIs"] and got[0][1] == got[0][0]
    assert got[1] == (["SQL"], ["SQL", "Design", "System Design", "Automation", "Testing"])
    assert got[2] == ([], []) and got[3] == ([], [])


def toy(spark, n=60):
    words = {"a": "red blue green", "b": "cat dog bird", "c": "one two three"}
    rows = [(i, "abc"[i % 3], " ".join([words["abc"[i % 3]]] * (1 + i % 2)) + f" noise{i % 4}") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, lang string, clean string").repartition(3, "doc_id")


def brute_bayes(rows, labels, kind, alpha):
    sums = {v: {} for v in labels}
    for label, _, term, w in rows:
        sums[label][term] = sums[label].get(term, 0.0) + w
    terms = sorted({r[2] for r in rows})
    out = {}
    for v in labels:
        if kind == "multinomial":
            c = {t: sums[v].get(t, 0.0) + alpha for t in terms}
            total = sum(c.values())
            out[v] = {t: math.log(c[t] / total) for t in terms}
        else:
            c = {t: sum(sums[u].get(t, 0.0) for u in labels if u != v) + alpha for t in terms}
            total = sum(c.values())
            logged = {t: math.log(c[t] / total) for t in terms}
            out[v] = {t: logged[t] / sum(logged.values()) for t in terms}
    return out


@pytest.mark.parametrize("kind", ["multinomial", "complement"])
def test_naive_bayes_equals_brute_force(spark, kind):
    train = toy(spark)
    fitted = Block("word", 1, 1, 1, 1.0, 50).fit(train, "doc_id", "clean")
    model = L.fit_naive_bayes(train, fitted, ["a", "b", "c"], kind, 0.1)
    rows = [tuple(r) for r in fitted.transform(train, "doc_id", "clean", keep=["lang"]).select("lang", "doc_id", "term", "w").collect()]
    want = brute_bayes(rows, ["a", "b", "c"], kind, 0.1)
    for r in model.table.collect():
        assert r["weights"] == pytest.approx([want[v][r["term"]] for v in "abc"], abs=1e-9)
    found = model.predict(train).join(train.select("doc_id", "lang"), "doc_id")
    assert found.filter("prediction <> lang").count() == 0
    empty = spark.createDataFrame([(1, "unseen"), (2, "")], "doc_id long, clean string")
    assert [r["prediction"] for r in model.predict(empty).collect()] == ["a", "a"]  # ties go to the first label
    scored = X.score_docs(train.withColumn("text", F.concat("clean", F.lit(" x y z"))), model)
    assert scored.filter("success and (predicted_category is null or confidence <= 0)").count() == 0
    assert scored.filter("not success and predicted_category is not null").count() == 0
    assert scored.filter("success").count() == 30  # the others have four words


def test_linear_models_learn(spark):
    train = toy(spark).withColumn("split", F.lit("train"))
    from corpuslens.operators.tfidf import FeatureUnion

    union = FeatureUnion([Block("word", 1, 1, 1, 1.0, 50)]).fit(train)
    terms = IO.keep_table(union.terms())
    size = terms.count()
    vectors = M.with_label_index(union.vectors(train, terms, size, keep=["lang"]), ["a", "b", "c"]).persist()
    for clf in (M.Classifier("logreg", max_iter=10), M.Classifier("linear_svc", max_iter=10, class_weight="balanced")):
        model = clf.fit(vectors, 60, 3, size)
        found = M.predict_labels(model, vectors, ["a", "b", "c"], ["lang"])
        assert found.filter("y_pred <> lang").count() == 0, clf.kind
    calibrated = M.fit_calibrated_svc(vectors, ["a", "b", "c"], folds=2, base=M.Classifier("linear_svc", max_iter=5))
    rows = calibrated.transform(vectors).collect()
    assert all(sum(r["probability"]) == pytest.approx(1.0) and r["prediction"] == r["y"] for r in rows)
    assert len(calibrated.weights) == 2 and all(len(w) == 3 for w in calibrated.weights)


def test_centroids(spark):
    rows = [(i, [float(i % 2), 1.0 - i % 2, 0.1], i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = L.centroid_classify(df, L.fit_centroids(df))
    assert found.filter("prediction <> label").count() == 0


def test_too_many_classes_are_refused(spark):
    with pytest.raises(ValueError):
        L.class_labels(spark.range(20).withColumnRenamed("id", "lang"), max_classes=10)


def test_results_table_and_json(spark, tmp_path):
    path = str(tmp_path / "r")
    schema = "id string, class_weight string"
    frame = spark.createDataFrame([("A1", "None"), ("A2", None)], schema)
    assert IO.start_results(spark, path, frame.schema) == 0
    IO.append_records(frame, path)
    IO.append_records(frame, path)
    assert IO.start_results(spark, path, frame.schema) == 4
    assert spark.read.parquet(path).count() == 0
    IO.write_json(frame, str(tmp_path / "j"))
    assert sorted(map(tuple, IO.read_json(spark, str(tmp_path / "j"), frame.schema).collect())) == [("A1", "None"), ("A2", None)]
    # An empty field is read as null, as the usual CSV readers do.
    text = spark.createDataFrame([(1, 'a "quoted"\nline, with comma', "", "X")], "ID long, body string, html string, class string")
    IO.write_csv(text, str(tmp_path / "c"))
    assert tuple(IO.read_csv(spark, str(tmp_path / "c"), text.schema).first()) == (1, 'a "quoted"\nline, with comma', None, "X")


def test_text_files_in_two_encodings(spark, tmp_path):
    (tmp_path / "en").mkdir()
    (tmp_path / "en" / "1.txt").write_bytes("  café ".encode("utf-8"))
    (tmp_path / "en" / "2.txt").write_bytes("café".encode("latin-1"))
    assert [r["text"] for r in IO.read_text_files(spark, str(tmp_path)).collect()] == ["café", "café"]


def test_listing_and_reconciliation(spark):
    files = spark.createDataFrame(
        [("/d/FIN/10.pdf", b"x"), ("/d/FIN/10(1).pdf", b"x"), ("/d/FIN/11 (1).pdf", b"y"), ("/d/HR/12.pdf", b"z")], "path string, content binary"
    )
    table = spark.createDataFrame([(10, "FIN"), (11, "HR"), (13, "HR")], "doc_id long, lang string")
    got = {r["document"]: tuple(r)[1:] for r in IO.reconcile(IO.list_documents(files), table).collect()}
    assert got == {"10": (2, 1, 1, "both", True), "11": (1, 1, 1, "both", False), "12": (1, 0, 1, "files only", False), "13": (0, 0, 0, "table only", False)}


def test_folds_are_stratified(spark):
    df = spark.range(103).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("double").alias("y"))
    got = M.stratified_folds(df.repartition(5), 5)
    counts = {(r["y"], r["fold"]): r["count"] for r in got.groupBy("y", "fold").count().collect()}
    for y, n in ((1.0, 15), (0.0, 88)):
        sizes = [counts.get((y, k), 0) for k in range(5)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    again = M.stratified_folds(df.coalesce(1), 5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_logistic_fit_has_a_zero_gradient(spark):
    import random

    from pyspark.ml.linalg import Vectors

    rng = random.Random(1)
    rows = [(i, Vectors.dense([rng.gauss(0, 1) for _ in range(3)]), float(rng.randrange(2))) for i in range(200)]
    df = spark.createDataFrame(rows, ["doc_id", "features", "y"]).persist()
    model = M.Classifier("logreg", C=2.0, tol=1e-9).fit(df, 200, 2)
    b, a = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    grad = [[0.0] * 4 for _ in range(2)]
    for _, x, y in rows:
        z = [sum(b[k][j] * x[j] for j in range(3)) + a[k] for k in range(2)]
        p = [math.exp(v) / sum(map(math.exp, z)) for v in z]
        for k in range(2):
            for j in range(3):
                grad[k][j] += (p[k] - (k == y)) * x[j] / 200
            grad[k][3] += (p[k] - (k == y)) / 200
    for k in range(2):
        assert all(abs(grad[k][j] + b[k][j] / (2.0 * 200)) < 1e-5 for j in range(3)) and abs(grad[k][3]) < 1e-5


def test_grid_counts_once_and_records_as_it_comes(spark):
    words = {"a": "red blue green", "b": "cat dog bird"}
    rows = [(i, "ab"[i % 2], words["ab"[i % 2]] + f" noise{i % 4}", "val" if i % 5 == 0 else "train") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, clean string, split string")
    blocks = {"w": Block("word", 1, 2, 1, 1.0), "c": Block("char", 3, 4, 1, 1.0, 30), "c2": Block("char", 2, 3, 2, 1.0, 20)}
    grid = [
        G.Experiment("1", ("w",), M.Classifier("logreg")), G.Experiment("2", ("w", "c"), M.Classifier("linear_svc")), G.Experiment("3", ("c2",), M.Classifier("complement_nb")),
        G.Experiment("4", ("w", "c"), M.Classifier("multinomial_nb")), G.Experiment("5", ("c2",), M.Classifier("mlp", max_iter=30, layers=(8,))),
    ]
    seen = []
    out = G.run_experiments(docs, grid, blocks, on_record=lambda r: seen.append(r.first()["experiment_id"])).collect()
    assert seen == ["1", "2", "3", "4", "5"] and [r["accuracy"] for r in out[:4]] == [1.0] * 4
    assert [r["C"] for r in out] == [1.0, 1.0, None, None, None]
    for r, keys in zip(out, (["w"], ["w", "c"], ["c2"], ["w", "c"], ["c2"])):
        alone = [blocks[k].fit(docs.filter("split = 'train'"), "doc_id", "clean").vocabulary.terms.count() for k in keys]
        assert r["n_features"] == sum(alone)


def test_matrix_and_document_with_given_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "y_true string, y_pred string")
    confusion = E.confusion_counts(df)
    assert E.confusion_matrix(confusion, ["a", "b", "c"]).count() == 9
    row = E.metrics_document(confusion, ["a", "b", "c"]).first()
    assert row["labels"] == ["a", "b", "c"] and row["confusion_matrix"] == [[1, 1, 0], [0, 0, 0], [0, 0, 0]]
    assert row["accuracy"] == 0.5 and row["report"]["a"]["recall"] == 0.5 and set(row["report"]) == {"a", "b"}


def test_sentences_are_counted_in_linear_time(spark):
    from time import perf_counter

    df = spark.createDataFrame([("-" * 1_000_000, []), ("One. Two! ... three? ?", []), ("", []), (None, [])], "text string, skills array<string>")
    start = perf_counter()
    assert [r["n_sentences"] for r in X.document_stats(df).collect()] == [0, 3, 0, 0]
    assert perf_counter() - start < 20


def test_large_weight_tables_are_not_broadcast(spark, monkeypatch):
    train = toy(spark)
    fitted = Block("word", 1, 1, 1, 1.0, 50).fit(train, "doc_id", "clean")
    model = L.fit_naive_bayes(train, fitted, ["a", "b", "c"])
    before = sorted(map(str, model.predict(train).collect()))
    monkeypatch.setattr(L, "BROADCAST_WEIGHTS", 0)
    assert not model._is_small()
    assert sorted(map(str, model.predict(train).collect())) == before


def test_fitted_models_as_tables(spark, tmp_path):
    """Saved, loaded and scored as a table, a fit gives the classes that Spark ML gives; three kinds of confidence."""
    from corpuslens.operators.tfidf import FeatureUnion
    from corpuslens.sources.models import load_model, save_model

    labels = ["a", "b", "c"]
    train = toy(spark).withColumn("text", F.concat("clean", F.lit(" p q r s")))
    union = FeatureUnion([Block("word", 1, 1, 1, 1.0, 50), Block("char_wb", 2, 3, 1, 0.99, 200)]).fit(train)
    terms = IO.keep_table(union.terms())
    size = terms.count()
    vectors = M.with_label_index(union.vectors(train, terms, size, keep=["lang"]), labels).persist()
    calibrated = M.fit_calibrated_svc(vectors, labels, folds=2)
    fits = [
        ("calibrated_decision_softmax", M.Classifier("linear_svc").fit(vectors, 60, 3, size)),
        ("calibrated_probability", M.Classifier("logreg").fit(vectors, 60, 3, size)),
        ("calibrated_probability", calibrated),
        ("uncalibrated_discrete", calibrated),
    ]
    for i, (kind, fit) in enumerate(fits):
        save_model(M.text_model(fit, union, terms, labels, classes_only=kind == "uncalibrated_discrete"), f"file://{tmp_path}/{i}")
        model = load_model(spark, f"file://{tmp_path}/{i}")
        want = {r["doc_id"]: r["y_pred"] for r in M.predict_labels(fit, vectors, labels, ["doc_id"]).collect()}
        scored = X.score_docs(train, model, clean="clean").filter("success").collect()
        assert scored and all(r["predicted_category"] == want[r["doc_id"]] and r["confidence_type"] == kind for r in scored)
        assert all((r["confidence"] == 1.0 and len(r["top_classes"]) == 1) if kind == "uncalibrated_discrete" else len(r["top_classes"]) == 3 for r in scored)
        assert {r["type"] for r in model.explain(train).collect()} == {"word_token", "subword_ngram"}
        if fit is calibrated:
            share = {r["doc_id"]: r["probability"] for r in fit.transform(vectors).collect()}
            for r in model.scores(train).select("doc_id", model.class_scores(F.col("scores")).alias("p")).collect():
                assert r["p"] == pytest.approx(share[r["doc_id"]], abs=1e-9)
            for r in scored if kind == "calibrated_probability" else []:
                assert [x["score"] for x in r["top_classes"]] == pytest.approx(sorted(share[r["doc_id"]], reverse=True), abs=1e-9)
            check_attributions(spark, fit, vectors, terms, model.explain(train), labels)


def test_models_scored_together_are_scored_as_alone(spark):
    """Class, confidence and top classes of each model, and the best terms of the one that is explained: those of its own explanation."""
    from corpuslens.operators.tfidf import FeatureUnion

    labels = ["a", "b", "c"]
    train = toy(spark).withColumn("text", F.concat("clean", F.lit(" p q r s"))).withColumn("clean", F.col("text"))
    union = FeatureUnion([Block("word", 1, 1, 1, 1.0, 50), Block("char_wb", 2, 3, 1, 0.99, 200)]).fit(train)
    terms = IO.keep_table(union.terms())
    vectors = M.with_label_index(union.vectors(train, terms, terms.count(), keep=["lang"]), labels).persist()
    plain, calibrated = M.fit_plain_and_calibrated_svc(vectors, labels, 2)
    fits = {"calibrated": (calibrated, False), "margins": (plain, False), "classes": (plain, True)}
    models = {name: M.text_model(fit, union, terms, labels, classes_only=only) for name, (fit, only) in fits.items()}
    raw = train.select("doc_id", "text", "clean").unionByName(spark.createDataFrame([(-1, " ", "")], "doc_id long, text string, clean string"))
    rows = {(r["model"], r["doc_id"]): r for r in X.score_docs_together(raw, models, "calibrated").collect()}
    assert len(rows) == 3 * raw.count()
    best = {}
    for r in models["calibrated"].explain(raw).orderBy("doc_id", "rank").collect():
        best.setdefault(r["doc_id"], []).append((r["feature"], r["score"], r["type"]))
    for name, model in models.items():
        for want in X.score_docs(raw, model).collect():
            r = rows[name, want["doc_id"]]
            assert [r[c] for c in ("success", "error_message", "predicted_category", "confidence", "confidence_type")] == [want[c] for c in ("success", "error_message", "predicted_category", "confidence", "confidence_type")]
            assert [t["label"] for t in r["top_classes"] or []] == [t["label"] for t in want["top_classes"] or []]
            if name == "calibrated" and r["success"]:
                assert [tuple(t) for t in r["best_terms"]] == best[r["doc_id"]]
            else:
                assert r["best_terms"] is None
    assert rows["calibrated", -1]["success"] is False


def check_attributions(spark, fit, vectors, terms, found, labels):
    """The mean weights of the folds times the vector, term by term."""
    name = {r["idx"]: (r["term"], r["channel"]) for r in terms.collect()}
    mean = sum(fit.weights) / len(fit.weights)
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append((r["rank"], r["feature"], r["score"], r["prediction"]))
    for r in fit.transform(vectors).collect():
        k = int(r["prediction"])
        parts = [(*name[int(i)], round(float(v * mean[k][int(i)]), 9)) for i, v in zip(r["features"].indices, r["features"].values)]
        best = sorted((x for x in parts if x[2] > 0), key=lambda x: (-x[2], x[0], x[1]))[:8]
        rows = sorted(got.get(r["doc_id"], []))
        assert [x[3] for x in rows] == [labels[k]] * len(best)
        assert [x[2] for x in rows] == pytest.approx([x[2] for x in best], abs=2e-9)


def test_dictionary_of_a_hundred_thousand_phrases(spark):
    """One pass over the text, whatever the dictionary: the same as trying each phrase on its own."""
    import re
    from time import perf_counter

    phrases = [f"term {i} x{i * 7}" for i in range(100_000)] + ["C++", ".NET", "data", "data science", "R", "Straße", "a-b"]
    texts = ["Term 17 X119, term 99999 x699993.", "xterm 5 x35 term 5 x35y (term 5 x35)", "DATA SCIENCE in c++/R and .net", "database R2 a-bc", "straße STRASSE", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    start = perf_counter()
    got = {r["i"]: r["found"] for r in df.select("i", X.detect_terms("t", phrases).alias("found")).collect()}
    assert perf_counter() - start < 60
    assert got[0] == ["term 17 x119", "term 99999 x699993"] and got[1] == ["term 5 x35"]
    few = phrases[-7:]
    for i, t in enumerate(texts[2:], start=2):
        found = [p for p in few if re.search(rf"(?i)(?<![a-zA-Z0-9]){re.escape(p)}(?![a-zA-Z0-9])", t)]
        assert got[i] == sorted(found, key=str.lower)


def test_scoring_on_a_stream_is_a_projection(spark):
    from corpuslens.operators.tfidf import FeatureUnion
    from corpuslens.streaming.score_stream import scored_stream

    labels = ["a", "b", "c"]
    train = toy(spark).withColumn("text", F.concat("clean", F.lit(" p q r s")))
    union = FeatureUnion([Block("word", 1, 2, 1, 1.0, 50), Block("char_wb", 2, 3, 1, 0.99, 200), Block("char", 2, 3, 1, 0.99, 100)]).fit(train)
    terms = IO.keep_table(union.terms())
    vectors = M.with_label_index(union.vectors(train, terms, terms.count(), keep=["lang"]), labels).persist()
    docs = IO.keep_table(train.select("doc_id", "text").unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "unseen words only here now"), (903, "red")], "doc_id long, text string")))
    for model in (M.Classifier("linear_svc").fit(vectors, 60, 3), M.fit_calibrated_svc(vectors, labels, folds=2)):
        table = M.text_model(model, union, terms, labels)
        rows = scored_stream(docs, table)
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        columns = ["doc_id", "success", "predicted_category", "confidence", "confidence_type", "cleaned_word_count", "error_message"]
        from corpuslens.functions.cleaning import clean_text

        batch = X.score_docs(clean_text(docs, "text", "clean"), table)
        assert sorted(map(str, rows.select(columns).collect())) == sorted(map(str, batch.select(columns).collect()))


def test_numbering_needs_no_single_task(spark):
    from corpuslens.operators.tfidf import numbered

    words = sorted({f"{a}{b}{c}" for a in "aßé" for b in "xyzü" for c in range(50)}, key=lambda w: w.encode())
    df = spark.createDataFrame([(w, 1) for w in reversed(words)], "term string, df int").repartition(3)
    placed = numbered(df, "term", "idx")
    assert [(r["term"], r["idx"]) for r in placed.orderBy("idx").collect()] == [(w, i) for i, w in enumerate(words)]
    assert numbered(df.limit(0), "term", "idx").count() == 0


def test_sketches_of_increments(spark):
    from corpuslens.operators import profile as A

    df = spark.range(20_000).select((F.col("id") % 2).alias("lang"), (F.col("id") % 5).alias("part"), F.col("id").alias("word_len"))
    kept = IO.keep_table(A.length_sketches(df, ["lang", "part"], ["word_len"]))
    assert kept.count() == 10
    for r in A.sketch_quantiles(A.merged_sketches(kept, ["lang"]), [0.1, 0.5, 0.99]).collect():
        assert r["n_docs"] == 10_000 and abs(r["quantile"] / 20_000 - r["share"]) <= A.sketch_error(400)


def test_class_similarity_in_blocks(spark, monkeypatch):
    from corpuslens.operators import profile as A

    rng = __import__("random").Random(4)
    rows = [(c, f"t{t}", rng.random()) for c in "abcd" for t in range(40) if rng.random() < 0.4] + [("e", "alone", 1.0)]
    df = spark.createDataFrame(rows, "lang string, term string, mean_w double")
    vectors = {c: {t: w for k, t, w in rows if k == c} for c in "abcde"}
    dot = lambda a, b: sum(w * vectors[b].get(t, 0.0) for t, w in vectors[a].items())
    want = {(a, b): round(dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)), 6) for a in vectors for b in vectors if dot(a, b)}
    for size in (4096, 3):
        monkeypatch.setattr(A, "TERM_BLOCK", size)
        assert {(r["class_a"], r["class_b"]): r["cosine"] for r in A.class_similarity(df).collect()} == pytest.approx(want)
    with pytest.raises(ValueError, match="more than 4"):
        A.class_similarity(df, max_classes=4)


def test_class_sums_stay_with_the_documents_and_are_shared(spark):
    """One row per term and task, no row per cell; models of a grid come from one table of sums, and score a document once."""
    from corpuslens.operators import linear_scores as L
    from corpuslens.operators.tfidf import Block

    texts = ["to be or not to be", "be not", "", None, "café or tea", "tea tea tea not", "zz", "be tea"]
    docs = spark.createDataFrame([(i, None if i == 7 else "abc"[i % 3], t) for i, t in enumerate(texts)], "doc_id long, lang string, clean string").repartition(2)
    fitted, labels = Block("word", 1, 2, 1, 1.0, 40).fit(docs, "doc_id", "clean"), ["a", "b", "c"]
    sums = L._class_sums(docs, fitted, labels, "lang", "doc_id", "clean")
    assert "Generate" not in sums._jdf.queryExecution().executedPlan().toString()
    rows = fitted.transform(docs, "doc_id", "clean", keep=["lang"]).collect()
    got = {r["term"]: [r["c0"], r["c1"], r["c2"]] for r in sums.collect()}
    assert got.keys() == {r["term"] for r in rows}
    for term, values in got.items():
        assert values == pytest.approx([sum(r["w"] for r in rows if r["term"] == term and r["lang"] == v) for v in labels], abs=1e-12)

    grid = [("multinomial", 0.1), ("complement", 1.0)]
    models = L.fit_bayes_grid(docs, fitted, labels, grid)
    both = {r["doc_id"]: r["scores"] for r in L.scores_together(models, docs).collect()}
    for k, (kind, alpha) in enumerate(grid):
        alone = L.fit_naive_bayes(docs, fitted, labels, kind, alpha).scores(docs).collect()
        assert len(alone) == len(both)
        for r in alone:
            assert both[r["doc_id"]][3 * k : 3 * k + 3] == pytest.approx(r["scores"], abs=1e-12)
