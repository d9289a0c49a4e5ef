"""SQL twins of the operators, as text for an independent engine.

They say the same thing in the plainest way (windows over whole classes, cross joins with the class
list, one row per character n-gram): they check results, they are not how the work is done.
"""

from __future__ import annotations

from corpuslens.functions.fixed import CANONICAL_TOKENS, PROTECTED_TOKENS
from corpuslens.functions.text import literal_pattern

WORD = r"\p{L}\p{N}_"
# The letters that occur in the tables, with the mark they carry.
MARKED = [
    ("é", "e", 769), ("è", "e", 768), ("ê", "e", 770), ("ç", "c", 807), ("ñ", "n", 771),
    ("ó", "o", 769), ("í", "i", 769), ("ü", "u", 776), ("ö", "o", 776), ("ä", "a", 776),
    ("á", "a", 769), ("ú", "u", 769),
]


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def word_count(c: str) -> str:
    return rf"coalesce(len(list_filter(string_split_regex({c}, '\s+'), lambda x: x <> '')), 0)"


def unescape(c: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        c = f"replace({c}, {quote(entity)}, {quote(char)})"
    return c


def strip_tags(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"


def decompose(c: str) -> str:
    for letter, base, mark in MARKED:
        c = f"replace({c}, {quote(letter)}, '{base}' || chr({mark}))"
        c = f"replace({c}, {quote(letter.upper())}, '{base.upper()}' || chr({mark}))"
    return c


def protect(c: str) -> str:
    for token, placeholder in PROTECTED_TOKENS.items():
        pattern = rf"(\s){literal_pattern(token)}([\s.,;:!?)/])"
        for _ in range(2):  # neighbours share their delimiter
            c = rf"regexp_replace({c}, {quote(pattern)}, '\1 {placeholder} \2', 'g')"
    return c


def mask_urls(c: str) -> str:
    return rf"regexp_replace({c}, '(?i)https?://\S+|www\.\S+', ' weburl ', 'g')"


def mask_emails(c: str) -> str:
    return rf"regexp_replace({c}, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b', ' emailaddr ', 'g')"


def mask_phones(c: str) -> str:
    return rf"regexp_replace({c}, '\(?\b[0-9]{{3}}\)?[-.\s]?[0-9]{{3}}[-.\s]?[0-9]{{4}}\b', ' phonenum ', 'g')"


def strip_punct(c: str) -> str:
    return rf"regexp_replace({c}, '[^{WORD}\s]', ' ', 'g')"


def restore(c: str) -> str:
    for placeholder, final in CANONICAL_TOKENS.items():
        c = f"replace({c}, {quote(placeholder)}, {quote(final)})"
    return c


def collapse(c: str) -> str:
    c = rf"regexp_replace(regexp_replace({c}, '[ \t]+', ' ', 'g'), '\n+', ' ', 'g')"
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def clean(c: str) -> str:
    c = decompose(strip_tags(unescape(f"coalesce({c}, '')")))
    c = f"(' ' || lower({c}) || ' ')"
    for step in (protect, mask_urls, mask_emails, mask_phones, strip_punct, restore, collapse):
        c = step(c)
    return c


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


VALID = f"valid AS MATERIALIZED (SELECT * FROM documents WHERE {word_count('text')} >= 10)"
CORPUS = (
    "corpus AS MATERIALIZED (SELECT doc_id, text, lang, source FROM "
    "(SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM valid) WHERE rn = 1)"
)
CLEAN = f"docs AS MATERIALIZED (SELECT doc_id, text, lang, source, {clean('text')} AS clean FROM corpus)"
CLEANED = ",\n".join([VALID, CORPUS, CLEAN])


def tokens(name: str, table: str, min_len: int = 1, stop: list[str] | None = None, keep: str = "", text: str = "clean") -> str:
    found = f"regexp_extract_all(lower({text}), '[{WORD}]{{{min_len},}}')"
    if stop:
        listed = ", ".join(quote(w) for w in stop)
        found = f"list_filter({found}, lambda x: x NOT IN ({listed}))"
    return f"{name} AS MATERIALIZED (SELECT doc_id, {keep} {found} AS t FROM {table})"


def word_counts(name: str, toks: str, lo: int, hi: int, keep: str = "") -> str:
    grams = [
        f"SELECT doc_id, {keep} unnest(list_transform(range(1, len(t) - {n - 2}), lambda i: array_to_string(list_slice(t, i, i + {n - 1}), ' '))) AS term FROM {toks} WHERE len(t) >= {n}"
        for n in range(lo, hi + 1)
    ]
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, {keep} term, count(*) AS tf FROM ("
        + " UNION ALL ".join(grams)
        + f") GROUP BY doc_id, {keep} term)"
    )


def char_counts(name: str, table: str, lo: int, hi: int, keep: str = "", text: str = "clean") -> str:
    squeezed = rf"regexp_replace(lower({text}), '\s\s+', ' ', 'g')"
    grams = [
        f"SELECT doc_id, {keep} unnest(regexp_extract_all(substr({squeezed}, {o + 1}), '(?s).{{{n}}}')) AS term FROM {table}"
        for n in range(lo, hi + 1)
        for o in range(n)
    ]
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, {keep} term, count(*) AS tf FROM ("
        + " UNION ALL ".join(grams)
        + f") GROUP BY doc_id, {keep} term)"
    )


def char_wb_counts(name: str, table: str, lo: int, hi: int, keep: str = "", text: str = "clean") -> str:
    words = (
        rf"{name}_words AS MATERIALIZED (SELECT doc_id, {keep} ' ' || w || ' ' AS w, count(*) AS times FROM (SELECT doc_id, {keep} "
        rf"unnest(list_filter(string_split_regex(lower({text}), '\s+'), lambda x: x <> '')) AS w FROM {table}) GROUP BY ALL)"
    )
    grams = [
        f"SELECT doc_id, {keep} times, unnest(list_transform(range(1, length(w) - {n - 2}), lambda i: substr(w, i, {n}))) AS term FROM {name}_words WHERE length(w) >= {n}"
        for n in range(lo, hi + 1)
    ]
    if lo > 3:
        grams.append(f"SELECT doc_id, {keep} times, w AS term FROM {name}_words WHERE length(w) < {lo}")
    return (
        f"{words},\n{name} AS MATERIALIZED (SELECT doc_id, {keep} term, CAST(sum(times) AS BIGINT) AS tf FROM ("
        + " UNION ALL ".join(grams)
        + f") GROUP BY doc_id, {keep} term)"
    )


def vocabulary(name: str, counts: str, docs: str, min_df: int = 1, max_df: float = 1.0, k: int | None = None, where: str = "") -> str:
    n = f"(SELECT count(*) FROM {docs})"
    upper = f" AND count(*) <= {max_df} * {n}" if max_df < 1.0 else ""
    top = f" ORDER BY cf DESC, term LIMIT {k}" if k else ""
    return (
        f"{name} AS MATERIALIZED (SELECT term, df, cf, ln(({n} + 1.0) / (df + 1.0)) + 1.0 AS idf FROM ("
        f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {counts} {where} GROUP BY term HAVING count(*) >= {min_df}{upper}{top}))"
    )


def weights(name: str, counts: str, vocab: str, keep: str = "") -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, {keep} term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM ("
        f"SELECT c.doc_id, {keep} c.term, (1.0 + ln(c.tf)) * v.idf AS w FROM {counts} c JOIN {vocab} v ON c.term = v.term))"
    )


def split(name: str, table: str, id_col: str = "doc_id", label: str = "lang", seed: str = "42") -> str:
    def quota(src: str, dst: str, n: str, share: str, out: str, keep: str) -> str:
        target = f"ceil(round({share} * sum({n}) OVER (), 9))"
        return (
            f"{name}_{dst}e AS (SELECT {label}, {keep} {n}, {target} AS target, round({n} * {target} / sum({n}) OVER (), 9) AS exact FROM {name}_{src}),\n"
            f"{name}_{dst} AS (SELECT {label}, {keep} {n}, CAST(floor(exact) + CASE WHEN row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, {label} NULLS FIRST) "
            f"<= target - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {out} FROM {name}_{dst}e)"
        )

    return ",\n".join(
        [
            f"{name}_n AS (SELECT {label}, count(*) AS n FROM {table} GROUP BY {label})",
            quota("n", "h", "n", "0.3", "n_holdout", ""),
            quota("h", "t", "n_holdout", "0.5", "n_test", ""),
            f"{name} AS MATERIALIZED (SELECT r.* EXCLUDE (rk), CASE WHEN rk <= n_test THEN 'test' WHEN rk <= n_holdout THEN 'val' ELSE 'train' END AS split FROM "
            f"(SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {id_col}), {id_col}) AS rk FROM {table}) r JOIN {name}_t q ON r.{label} IS NOT DISTINCT FROM q.{label})",
        ]
    )


def naive_bayes(kind: str, train_w: str, vocab: str, train: str, out: str = "model", label: str = "lang", alpha: str = "0.1") -> str:
    grid = (
        f"{out}_l AS (SELECT DISTINCT {label} FROM {train}),\n"
        f"{out}_s AS (SELECT term, {label}, sum(w) AS c FROM {train_w} GROUP BY term, {label}),\n"
        f"{out}_g AS MATERIALIZED (SELECT v.term, l.{label}, coalesce(s.c, 0.0) AS c FROM {vocab} v CROSS JOIN {out}_l l LEFT JOIN {out}_s s ON s.term = v.term AND s.{label} = l.{label})"
    )
    if kind == "multinomial":
        return (
            f"{grid},\n{out} AS MATERIALIZED (SELECT term, {label}, ln((c + {alpha}) / sum(c + {alpha}) OVER (PARTITION BY {label})) AS w FROM {out}_g),\n"
            f"{out}_p AS (SELECT {label}, ln(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)) AS p FROM {train} GROUP BY {label})"
        )
    return (
        f"{grid},\n{out}_r AS (SELECT term, {label}, sum(c) OVER (PARTITION BY term) + {alpha} - c AS c FROM {out}_g),\n"
        f"{out}_k AS (SELECT term, {label}, ln(c / sum(c) OVER (PARTITION BY {label})) AS w FROM {out}_r),\n"
        f"{out} AS MATERIALIZED (SELECT term, {label}, w / sum(w) OVER (PARTITION BY {label}) AS w FROM {out}_k),\n"
        f"{out}_p AS (SELECT {label}, 0.0 AS p FROM {out}_l)"
    )


def scores(name: str, docs: str, doc_w: str, model: str = "model", label: str = "lang", where: str = "") -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT d.doc_id, p.{label} AS label, p.p + coalesce(s.s, 0.0) AS score FROM {docs} d CROSS JOIN {model}_p p "
        f"LEFT JOIN (SELECT x.doc_id, m.{label}, sum(x.w * m.w) AS s FROM {doc_w} x JOIN {model} m ON m.term = x.term GROUP BY x.doc_id, m.{label}) s "
        f"ON s.doc_id = d.doc_id AND s.{label} = p.{label} {where})"
    )


def argmax(name: str, scored: str) -> str:
    return (
        f"{name} AS MATERIALIZED (SELECT doc_id, label AS prediction, score FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rk FROM {scored}) WHERE rk = 1)"
    )


# Per-class and overall metrics from a table ``preds(y_true, y_pred)``; extra grouping columns in ``by``.
def confusion(preds: str, by: str = "") -> str:
    return f"conf AS MATERIALIZED (SELECT {by} CAST(y_true AS VARCHAR) AS y_true, CAST(y_pred AS VARCHAR) AS y_pred, count(*) AS n FROM {preds} GROUP BY ALL)"


def per_class(by: str = "") -> str:
    return (
        f"sides AS (SELECT {by} y_true AS label, n AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp FROM conf "
        f"UNION ALL SELECT {by} y_pred, 0, n, 0 FROM conf),\n"
        f"sums AS (SELECT {by} label, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted, CAST(sum(tp) AS BIGINT) AS tp FROM sides GROUP BY {by} label),\n"
        f"rates AS (SELECT {by} label, support, tp, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS precision, "
        f"CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall FROM sums),\n"
        f"classes AS MATERIALIZED (SELECT {by} label, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1, support, tp FROM rates)"
    )


def overall(by: str = "") -> str:
    weighted = ", ".join(f"sum({m} * support) / sum(support) AS weighted_{m}" for m in ("precision", "recall", "f1"))
    macro = ", ".join(f"avg({m}) AS macro_{m}" for m in ("precision", "recall", "f1"))
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return (
        f"total AS MATERIALIZED (SELECT {by} CAST(sum(tp) AS DOUBLE) / sum(support) AS accuracy, {macro}, {weighted}, "
        f"CAST(sum(support) AS BIGINT) AS n_docs FROM classes {group})"
    )
