"""URL rules whose block decisions reach the aliases of a page.

A page and the URLs it redirects to or names as canonical are one resource. Components over these
links carry a block decision from any member to all members that no rule names, unless some member is
explicitly allowed. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslens.llm.common import LOWER, UPPER, Scratch, components, lower_ascii, read
from corpuslens.llm.registry import query

RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TAG = r"(?is)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
HREF = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
TARGET = r"(?is)\bcontent\s*=\s*(?:\"[^\"]*?\burl\s*=\s*'?([^\"']*)|'[^']*?\burl\s*=\s*\"?([^\"']*)|[^\s\"'>]*?\burl=([^\s\"'>]+))"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    part = [F.coalesce(F.regexp_extract(url, PARTS, i), F.lit("")) for i in (1, 2)]
    return lower_ascii(part[0]), part[1]


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); of equal ones an allow rule. Null if none.

    The rules are the caller's list, written into the plan: tens to a few hundred of them.
    """
    found = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        found.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def node_of(url: Column) -> Column:
    """A URL as node: scheme and host in lower case, no fragment; null without ``://``."""
    scheme = lower_ascii(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host_path(url)[0], rest))


def links(pages: DataFrame, scratch: Scratch, url: str = "url", html: str = "html") -> DataFrame:
    """``a, b``: page and the URL that a canonical link or a refresh redirect of it names.

    Targets may be absolute, or relative to the page's scheme, host or folder. The few tags found are
    written before they are taken apart.
    """
    either = lambda tag, pattern: F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    tag, base, to = F.col("tag"), F.col("url"), F.col("to")
    tags = pages.select(F.col(url).alias("url"), F.explode(F.regexp_extract_all(html, F.lit(TAG), F.lit(0))).alias("tag"))
    tags = scratch.keep(tags.filter((tag.rlike(r"(?i)^<link") & tag.rlike(CANONICAL)) | (tag.rlike(r"(?i)^<meta") & tag.rlike(REFRESH))))
    named = F.when(tag.rlike(r"(?i)^<link"), either(tag, HREF)).otherwise(either(tag, TARGET))
    clean = F.regexp_replace(F.regexp_replace(named, r"(?i)&amp;", "&"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    parts = scratch.keep(
        tags.select(
            "url",
            clean.alias("to"),
            F.regexp_extract(base, r"(?s)^(.*?)://", 1).alias("scheme"),
            F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1).alias("site"),
            F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1).alias("folder"),
        )
    )
    folder = F.when(F.col("folder").endswith("/"), F.col("folder")).otherwise(F.concat("site", F.lit("/")))
    absolute = (
        F.when(to == "", None)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.startswith("//"), F.concat("scheme", F.lit(":"), "to"))
        .when(to.startswith("/"), F.concat("site", "to"))
        .when(to.rlike(r"^[?#]"), F.concat(F.regexp_extract(base, r"(?s)^([^?#]*)", 1), to))
        .otherwise(F.concat(folder, to))
    )
    whole = scratch.keep(parts.select("url", absolute.alias("to")))
    return whole.select(node_of(base).alias("a"), node_of(to).alias("b"))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, by`` (rule, alias or default).

    ``redirects (a, b)`` are more links between URLs, such as a crawler's redirect log. A null URL, or
    one without ``://``, has empty host and path, no rule and no alias: allowed. Repeated rows are
    judged alike; a null html has no links; of the other columns nothing is read.
    """
    scratch = Scratch(pages.sparkSession, "url")
    found = links(pages, scratch, url, html)
    if redirects is not None:
        found = found.unionAll(redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    member = components(found, scratch)
    own = rule_of(*host_path(F.col("node")), rules)["verdict"]
    decided = member.withColumn("own", own).groupBy("component").agg(F.max(F.col("own") == "allow").alias("allow"), F.max(F.col("own") == "block").alias("block"))
    blocked = member.join(decided.filter("block and not coalesce(allow, false)"), "component").select("node", F.lit(True).alias("blocked"))
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), node_of(F.col(url)).alias("node"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).join(scratch.keep(blocked), "node", "left")
    return rows.select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("blocked"), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("r").isNotNull(), "rule").when(F.col("blocked"), "alias").otherwise("default").alias("by"),
    )


def _sql(rules: Sequence[tuple[str, str]] = RULES) -> str:
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def host(u: str) -> str:
        return f"translate(coalesce(regexp_extract({u}, {q(PARTS)}, 1), ''), '{UPPER}', '{LOWER}')"

    def path(u: str) -> str:
        return f"coalesce(regexp_extract({u}, {q(PARTS)}, 2), '')"

    def node(u: str) -> str:
        scheme = f"translate(regexp_extract({u}, '(?s)^(.*?)://', 1), '{UPPER}', '{LOWER}')"
        return f"CASE WHEN contains({u}, '://') THEN {scheme} || '://' || {host(u)} || regexp_extract({u}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END"

    def rule(h: str, p: str, what: int) -> str:
        whens = ""
        for x in sorted(rules, key=lambda r: (-len(r[1]), r[0])):
            domain, _, rest = x[1].partition("/")
            whens += f" WHEN ({h} = '{domain}' OR ends_with({h}, '.{domain}')) AND starts_with({p}, '/{rest}') THEN '{x[what]}'"
        return f"CASE{whens} END"

    def either(pattern: str) -> str:
        return " || ".join(f"regexp_extract(tag, {q(pattern)}, {i})" for i in (1, 2, 3))

    site, folder = "regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)", "regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1)"
    return f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, {q(TAG)})) AS tag FROM pages
), named AS (
  SELECT url, CASE WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, {q(CANONICAL)}) THEN {either(HREF)}
              WHEN regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, {q(REFRESH)}) THEN {either(TARGET)} END AS raw
  FROM tags
), clean AS (
  SELECT url, regexp_replace(regexp_replace(raw, '(?i)&amp;', '&', 'g'), '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS t FROM named
), absolute AS (
  SELECT url, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t WHEN starts_with(t, '/') THEN {site} || t
    WHEN regexp_matches(t, '^[?#]') THEN regexp_extract(url, '(?s)^([^?#]*)', 1) || t
    ELSE (CASE WHEN ends_with({folder}, '/') THEN {folder} ELSE {site} || '/' END) || t END AS t
  FROM clean
), linked AS (SELECT {node('url')} AS a, {node('t')} AS b FROM absolute
), edge AS (SELECT a, b FROM linked WHERE a <> b UNION SELECT b, a FROM linked WHERE a <> b
), reach(a, b) AS (SELECT a, a FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
), member AS (SELECT a AS node, {rule(host('b'), path('b'), 0)} AS own FROM reach
), blocked AS (SELECT node FROM member GROUP BY node HAVING bool_or(own = 'block') AND NOT coalesce(bool_or(own = 'allow'), false)
), judged AS (SELECT page_id, {host('url')} AS host, {path('url')} AS path, {node('url')} AS node FROM pages
), ruled AS (SELECT *, {rule('host', 'path', 1)} AS rule, {rule('host', 'path', 0)} AS own FROM judged)
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN node IN (SELECT node FROM blocked) THEN 'block' END, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN node IN (SELECT node FROM blocked) THEN 'alias' ELSE 'default' END AS by
FROM ruled
"""


@query(_sql())
def op2_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))
