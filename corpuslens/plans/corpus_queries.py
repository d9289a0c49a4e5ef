"""Queries: sources and sinks, quality and de-duplication, text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from corpuslens.functions import cleaning as C
from corpuslens.functions.text import is_blank, word_count
from corpuslens.operators import quality as Q
from corpuslens.plans import sql as S
from corpuslens.plans.corpus import corpus, documents
from corpuslens.plans.registry import query
from corpuslens.sources import tables as IO

# ---------------------------------------------------------------- sources and sinks


def _scratch(spark, name):
    import uuid

    return f"{IO.shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("SELECT page_id, url, html AS body, length(html) AS n FROM pages")
def src_csv_roundtrip(spark, d):
    """Text with quotes, tags and newlines written as CSV and read back with a declared schema."""
    path = _scratch(spark, "csv")
    pages = IO.read_table(spark, d, "pages").select("page_id", "url", F.col("html").alias("body"))
    IO.write_csv(pages, path)
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("body", T.StringType())])
    return IO.read_csv(spark, path, schema).withColumn("n", F.length("body").cast("long"))


@query(
    "SELECT lang AS label, count(*) AS n_docs, 'first' AS run FROM documents GROUP BY lang "
    "UNION ALL SELECT source, count(*), 'second' FROM documents GROUP BY source "
    "UNION ALL SELECT lang, count(*), 'kept' FROM documents GROUP BY lang"
)
def exp_append(spark, d):
    """Records appended to a results table, the table backed up before the next run."""
    path = _scratch(spark, "results")
    docs = documents(spark, d)
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("n_docs", T.LongType())])
    IO.start_results(spark, path, schema)
    IO.append_records(docs.groupBy(F.col("lang").alias("label")).agg(F.count("*").alias("n_docs")), path)
    first = spark.read.schema(schema).parquet(path)
    IO.back_up(spark, path, schema)
    IO.append_records(docs.groupBy(F.col("source").alias("label")).agg(F.count("*").alias("n_docs")), path)
    everything = spark.read.schema(schema).parquet(path)
    kept = spark.read.schema(schema).parquet(f"{path}_prev")
    run = F.when(F.col("label").startswith("src"), "second").otherwise("first")
    return everything.withColumn("run", run).unionByName(kept.withColumn("run", F.lit("kept")))


@query(
    "SELECT lang AS label, count(*) AS n_docs, round(avg(length(text)), 6) AS mean_chars, max(length(text)) AS max_chars "
    "FROM documents GROUP BY lang"
)
def metrics_json(spark, d):
    """Metrics written as JSON documents and parsed back."""
    path = _scratch(spark, "json")
    length = F.length("text").cast("long")
    metrics = documents(spark, d).groupBy(F.col("lang").alias("label")).agg(
        F.count("*").alias("n_docs"), F.round(F.avg(length), 6).alias("mean_chars"), F.max(length).alias("max_chars")
    )
    IO.write_json(metrics, path)
    return IO.read_json(spark, path, metrics.schema)


def _write_files(docs, path):
    """One file per document, ``source=.../lang=.../doc_id=....txt``: even ids in UTF-8, odd ones in Latin-1."""
    even, line = F.pmod("doc_id", F.lit(2)) == 0, F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    latin = F.encode(F.regexp_replace(line, r"[^\x{00}-\x{FF}]", "?"), "ISO-8859-1")
    folder = lambda c: F.concat(F.lit(f"/{c}="), F.url_encode(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))))
    name = F.concat(F.when(even, "utf8").otherwise("latin1"), folder("source"), folder("lang"), F.lit("/doc_id="), F.col("doc_id").cast("string"), F.lit(".txt"))
    content = F.concat(F.when(even, line.cast("binary")).otherwise(latin), F.lit("\n").cast("binary"))
    IO.write_text_files(docs.filter("doc_id is not null").select(name.alias("name"), content.alias("content")), path)


_PLACE = r"source=([^/]+)/lang=([^/]+)/doc_id=(-?\d+)\.txt$"


@query(
    f"SELECT doc_id, source, CAST({S.word_count('text')} AS BIGINT) AS n_words, "
    r"length(regexp_replace(replace(text, chr(10), ' '), '^\s+|\s+$', '', 'g')) AS n_chars FROM documents"
)
def ingest_text_files(spark, d):
    """Documents written as one text file each, in two encodings, read back file by file and decoded."""
    path = _scratch(spark, "files")
    _write_files(documents(spark, d), path)
    files = IO.read_text_files(spark, path)
    return files.select(
        F.regexp_extract("path", _PLACE, 3).cast("long").alias("doc_id"),
        F.url_decode(F.regexp_extract("path", _PLACE, 1)).alias("source"),
        word_count("text").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
    )


@query(
    f"""{S.with_(
        S.VALID, S.CORPUS,
        "files AS (SELECT CAST(doc_id AS VARCHAR) AS stem, lang AS folder, text, false AS is_copy FROM documents "
        "UNION ALL SELECT CAST(doc_id AS VARCHAR), lang, text, true FROM documents WHERE source = 'src0')",
        "f AS (SELECT stem, count(*) AS n_files, count(*) FILTER (is_copy) AS n_copies, count(DISTINCT sha256(text)) AS n_contents, min(folder) AS folder FROM files GROUP BY stem)",
        "t AS (SELECT CAST(doc_id AS VARCHAR) AS stem, lang FROM corpus)")}
    SELECT coalesce(f.stem, t.stem) AS document, coalesce(n_files, 0) AS n_files, coalesce(n_copies, 0) AS n_copies, coalesce(n_contents, 0) AS n_contents,
      CASE WHEN f.stem IS NULL THEN 'table only' WHEN t.stem IS NULL THEN 'files only' ELSE 'both' END AS presence,
      coalesce(folder = lang, false) AS same_class
    FROM f FULL OUTER JOIN t ON f.stem = t.stem"""
)
def reconcile_files(spark, d):
    """Files of all documents, with marked copies of one source, listed from disk, against the cleaned corpus."""
    docs = documents(spark, d)
    path = _scratch(spark, "listing")
    _write_files(docs, f"{path}/first")
    _write_files(docs.filter("source = 'src0'"), f"{path}/copies")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.concat(F.lit("/corpus/"), F.url_decode(F.regexp_extract("path", _PLACE, 2)), F.lit("/"), F.regexp_extract("path", _PLACE, 3))
    mark = F.when(F.col("path").contains("/copies/"), "(1).txt").otherwise(".txt")
    return IO.reconcile(IO.list_documents(files.select(F.concat(name, mark).alias("path"), "content")), corpus(spark, d))


# ---------------------------------------------------------------- quality


@query(f"SELECT doc_id, length(text) AS char_len, CAST({S.word_count('text')} AS BIGINT) AS word_len FROM documents")
def doc_lengths(spark, d):
    return Q.with_lengths(documents(spark, d)).select("doc_id", "char_len", "word_len")


@query(f"SELECT doc_id, lang, CAST({S.word_count('text')} AS BIGINT) AS word_len FROM documents WHERE {S.word_count('text')} < 10")
def invalid_docs(spark, d):
    return Q.invalid_docs(documents(spark, d)).select("doc_id", "lang", word_count("text").alias("word_len"))


@query(f"SELECT doc_id, lang, source FROM documents WHERE {S.word_count('text')} >= 10")
def valid_docs(spark, d):
    return Q.valid_docs(documents(spark, d)).select("doc_id", "lang", "source")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS text_key FROM documents GROUP BY text")
def dedup_exact(spark, d):
    return Q.dedup_exact(documents(spark, d)).select("doc_id", Q.text_key().alias("text_key"))


@query(
    "SELECT doc_id, lang, kept_id, substr(text, 1, 60) AS snippet FROM "
    "(SELECT *, min(doc_id) OVER (PARTITION BY text) AS kept_id FROM documents) WHERE doc_id <> kept_id"
)
def dedup_removed(spark, d):
    return Q.removed_duplicates(documents(spark, d))


@query(
    "SELECT doc_id, lang, group_id, copies FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS group_id, "
    "count(*) OVER (PARTITION BY text) AS copies FROM documents) WHERE copies > 1"
)
def dup_groups(spark, d):
    return Q.duplicate_groups(documents(spark, d))


@query(
    "SELECT min(doc_id) AS group_id, count(*) AS copies, count(DISTINCT source) AS n_labels, "
    "array_to_string(list_sort(list(DISTINCT source)), ',') AS labels, count(DISTINCT source) > 1 AS conflict "
    "FROM documents GROUP BY text HAVING count(*) > 1"
)
def dup_label_conflicts(spark, d):
    return Q.duplicate_label_conflicts(documents(spark, d), label="source")


@query(
    f"""{S.with_(S.VALID, S.CORPUS)}
    SELECT CAST(1 AS BIGINT) AS step, 'raw' AS stage, (SELECT count(*) FROM documents) AS n_rows, CAST(0 AS BIGINT) AS delta
    UNION ALL SELECT 2, 'valid', (SELECT count(*) FROM valid), (SELECT count(*) FROM valid) - (SELECT count(*) FROM documents)
    UNION ALL SELECT 3, 'deduplicated', (SELECT count(*) FROM corpus), (SELECT count(*) FROM corpus) - (SELECT count(*) FROM valid)"""
)
def row_accounting(spark, d):
    return Q.row_accounting(documents(spark, d))


def _audit_sql():
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS nulls, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_pct, count(DISTINCT {c}) AS distinct_values FROM documents"
        for c, t in kinds.items()
    )


@query(_audit_sql())
def column_audit(spark, d):
    return Q.column_audit(documents(spark, d))


@query(f"{S.with_(S.VALID, S.CORPUS)} SELECT doc_id, lang, source, sha256(text) AS text_key FROM corpus")
def clean_corpus(spark, d):
    return corpus(spark, d).select("doc_id", "lang", "source", Q.text_key().alias("text_key"))


# ---------------------------------------------------------------- text cleaning


@query(f"SELECT page_id, {S.unescape('html')} AS result FROM pages")
def unescape_html(spark, d):
    pages = IO.read_table(spark, d, "pages", spread="page_id")
    return pages.select("page_id", C.unescape_html("html").alias("result"))


@query(f"SELECT page_id, {S.strip_tags('html')} AS result FROM pages")
def strip_tags(spark, d):
    pages = IO.read_table(spark, d, "pages", spread="page_id")
    return pages.select("page_id", C.strip_tags("html").alias("result"))


@query(f"SELECT doc_id, {S.decompose('text')} AS result FROM documents")
def nfkd_text(spark, d):
    return documents(spark, d).select("doc_id", C.decompose("text").alias("result"))


_TECH = "' Expert in c++, c#, .net asp.net node.js; t-sql c++ c++ (ci/cd) ' || lower(text) || ' '"


@query(f"SELECT doc_id, {S.protect(f'({_TECH})')} AS result FROM documents")
def protect_tokens(spark, d):
    docs = documents(spark, d).select(
        "doc_id",
        F.concat(F.lit(" Expert in c++, c#, .net asp.net node.js; t-sql c++ c++ (ci/cd) "), F.lower("text"), F.lit(" ")).alias("t"),
    )
    return docs.select("doc_id", C.protect_tokens("t").alias("result"))


@query(f"SELECT page_id, {S.mask_urls('(url || chr(10) || html)')} AS result FROM pages")
def mask_urls(spark, d):
    pages = IO.read_table(spark, d, "pages", spread="page_id").select("page_id", F.concat("url", F.lit("\n"), "html").alias("t"))
    return pages.select("page_id", C.mask_urls("t").alias("result"))


@query(f"SELECT doc_id, {S.mask_emails('text')} AS result FROM documents")
def mask_emails(spark, d):
    return documents(spark, d).select("doc_id", C.mask_emails("text").alias("result"))


@query(f"SELECT doc_id, {S.mask_phones('text')} AS result FROM documents")
def mask_phones(spark, d):
    return documents(spark, d).select("doc_id", C.mask_phones("text").alias("result"))


@query(f"SELECT doc_id, {S.strip_punct(S.decompose('text'))} AS result FROM documents")
def strip_punct(spark, d):
    docs = documents(spark, d).select("doc_id", C.decompose("text").alias("t"))
    return docs.select("doc_id", C.strip_punct("t").alias("result"))


@query(f"SELECT doc_id, {S.clean('text')} AS result FROM documents")
def clean_text(spark, d):
    return C.clean_text(documents(spark, d), "text", "result").select("doc_id", "result")


@query(f"SELECT page_id, {S.clean('html')} AS result FROM pages")
def clean_text_html(spark, d):
    return C.clean_text(IO.read_table(spark, d, "pages", spread="page_id"), "html", "result").select("page_id", "result")


@query(f"SELECT doc_id, {S.clean('text')} AS result FROM documents")
def clean_text_transformer(spark, d):
    """The cleaner as a pipeline stage."""
    from pyspark.ml import Pipeline

    docs = documents(spark, d)
    stage = C.TextCleaner(inputCol="text", outputCol="result")
    return Pipeline(stages=[stage]).fit(docs).transform(docs).select("doc_id", "result")


@query(
    f"""{S.with_(f"c AS MATERIALIZED (SELECT doc_id, {S.clean('text')} AS t FROM documents)")}
    SELECT doc_id, CAST({S.word_count('t')} AS BIGINT) AS cleaned_word_len,
      CAST(len(regexp_extract_all(t, 'weburl')) AS BIGINT) AS n_urls, CAST(len(regexp_extract_all(t, 'emailaddr')) AS BIGINT) AS n_emails,
      CAST(len(regexp_extract_all(t, 'phonenum')) AS BIGINT) AS n_phones, t = '' AS blank FROM c"""
)
def clean_text_stats(spark, d):
    docs = C.clean_text(documents(spark, d), "text", "clean")
    masked = [F.regexp_count("clean", F.lit(w)).cast("long").alias(n) for w, n in (("weburl", "n_urls"), ("emailaddr", "n_emails"), ("phonenum", "n_phones"))]
    return docs.select("doc_id", word_count("clean").alias("cleaned_word_len"), *masked, is_blank("clean").alias("blank"))


@query(rf"SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS result FROM documents")
def clean_text_simple(spark, d):
    return documents(spark, d).select("doc_id", C.clean_text_simple("text").alias("result"))
