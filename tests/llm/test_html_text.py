"""Main text: markup, differencing against the nearest URL, and brute-force pairing."""

import random

import numpy as np
import pytest

from corpuslens.llm.common import Scratch
from corpuslens.llm.html_text import blocks, common_lines, extract_text, parse, shared_places

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><ul class="menu"><li>Home</li></ul></header><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad <p>no</p> -->
<div class="cookie-notice">We use <b>cookies</b></div><div class="ad">Buy!</div><div id="content"><article class="post content"><header><h2>Title &amp; more</h2></header>
<p><b>First   para.<br><p>Second <i>pa</i>ra &lt;b&gt; &eacute;&#233;&nbsp;x</p><aside>see also</aside><ul><li>one<li>two</ul><form><input><p>mail</p></form>
<div class="ad-slot">ad</div><section class="comments"><article class="comment"><p>Nice!</p></article></section></article></div>
<div class="sidebar"><article>teaser</article></div><footer>&copy; x</footer></body></html>"""


def kept(page):
    return [line for kind, line in blocks(page) if kind != "boilerplate"]


def test_markup():
    assert kept(PAGE) == ["Title & more", "First para.", "Second para <b> éé x", "one", "two"]


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        (None, []), ("", []), ("plain  text\nhere", ["plain text here"]), ("<p>a<p>b", ["a", "b"]), ("a < b > c", ["a < b > c"]), ("<article><p>x</p>", ["x"]),
        ("<main><p>x</p></main><p>y</p>", ["x"]), ("<p>x</p><script>if (a<b) {}", ["x"]), ("<!-- never closed <p>x</p>", []), ("<div class='ad'>ad<article><p>x</p></article>", ["x"]),
        ("<table><tr><td>a</td><td>b</td></tr></table>", ["a", "b"]), ("<p title='a > b'>x</p>", ["x"]), ("<P CLASS=Ad>x</P><P>y</P>", ["y"]), ("<p hidden>x</p>y", ["y"]),
        ("<article><nav>m<p>x</p></article>", ["x"]), ("<pre>a\n  b</pre>", ["a b"]), ("<p>" + "x" * 300_000 + "</p>", ["x" * 300_000]), ("<div>" * 5000 + "deep", ["deep"]),
    ],
)
def test_pieces(page, lines):
    assert kept(page) == lines


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_lines():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in "ab")
        got = common_lines(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64))
        assert len(got) == lcs(a, b) and got == sorted(set(got))
        it = iter(b)
        assert all(any(a[i] == y for y in it) for i in got)


def soup(host, path, own):
    return f"http://{host}{path}", "".join(f"<div>{x}</div>" for x in ["Menu", "Home", *own, "Imprint " + host])


def site(seed, hosts, pages):
    rng = random.Random(seed)
    rows = []
    for h in range(hosts):
        for p in range(pages):
            own = [f"text {h} {p} {k} " + "w " * 30 for k in range(rng.randrange(1, 5))]
            rows.append((len(rows), *soup(f"h{h}.org", f"/{rng.randrange(9)}/{p}", own), own))
    return rows


@pytest.mark.parametrize(("hosts", "pages", "parts"), [(3, 40, "1"), (3, 40, "7"), (1, 60, "50"), (20, 2, "13")])
def test_differencing_keeps_own_lines(spark, hosts, pages, parts):
    rows = site(1, hosts, pages)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*r[:3], "x") for r in rows], "page_id long, url string, html string, text string")
        got = {r.page_id: r.text for r in extract_text(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {r[0]: "\n".join(" ".join(x.split()) for x in r[3]) for r in rows}


@pytest.mark.parametrize("parts", ["1", "5"])
def test_partners_with_an_article(spark, parts):
    """The nearest URL has an article, which markup decides, and its menu tells that of an open page."""
    rows, wanted = [], {}
    for i in range(30):
        own = [f"text {i} {k} " + "w " * 30 for k in range(3)]
        url, html = soup(f"h{i % 3}.org", f"/{i // 6}/{i // 3 % 2}", own)
        if i // 3 % 2:
            html = "".join(f"<div>{x}</div>" for x in ["Menu", "Home"]) + "<article>" + "".join(f"<p>{x}</p>" for x in own) + f"</article><div>Imprint h{i % 3}.org</div>"
        elif i >= 6:
            own = []  # every host has one open page only
        if own:
            rows.append((i, url, html))
            wanted[i] = "\n".join(" ".join(x.split()) for x in own)
    rows += [(100 + h, f"http://h{h}.org/0/0/", "") for h in range(3)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == wanted | {100 + h: "" for h in range(3)}


def test_odd_pages(spark):
    url, html = soup("a.org", "/x", ["only " * 9])
    rows = [(1, None, None), (2, None, "<p>x</p>"), (None, url, html), (3, url, html), (3, url, html), (4, "no scheme", ""), (5, "http://b.org/alone", "<p>lone</p>")]
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    whole = "Menu\nHome\n" + ("only " * 9).strip() + "\nImprint a.org"  # copies tell nothing about each other
    assert sorted((str(r.page_id), r.text) for r in out) == sorted([("1", ""), ("2", "x"), ("None", whole), ("3", whole), ("3", whole), ("4", ""), ("5", "lone")])
    assert all(r.n_chars == len(r.text) for r in out)
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_whole_table_keeps_every_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract_text(pages).collect():
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        import html
        import re

        words = html.unescape(re.sub(r"<[^>]*>", " ", article)).split()
        assert r.text.split() == words


@pytest.mark.parametrize(
    ("piece", "tail"),
    [
        ("<div>x", ""), ("<a x", ""), ("<script ", ""), ("<a '\"> ", ""), ("<a x=\"", ">"), ("<article>x", ""), ("<nav>x", ""), ("<!-- ", ""), ("<p><b>x", ""), ("< ", ""), ("<script></script ", ""),
        ("<a x=\" y=' ", ">"), ("<div></x>", ""), ("</div>", ""), ("<p class=ad>x", ""), ("&amp", ""),
    ],
)
def test_a_megabyte_of_bad_markup_takes_linear_time(piece, tail):
    from time import perf_counter

    def seconds(size):
        start = perf_counter()
        blocks(piece * (size // len(piece)) + tail)
        return perf_counter() - start

    seconds(1 << 16)
    whole = seconds(1 << 20)
    assert whole < 30 and whole < 16 * max(0.05, seconds(1 << 17))


@pytest.mark.parametrize("parts", ["1", "6"])
def test_pages_with_an_article_are_differenced(spark, parts):
    """Every page is paired and aligned; lines of the article that both pages share are put back by the check."""
    page = lambda i: f"<div>Menu</div><article><p>shared line</p><p>own {i}</p></article><div>Imprint</div>"
    rows = [(i, f"http://h{i % 2}.org/{i}", page(i)) for i in range(40)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        scratch = Scratch(spark, "test")
        parsed = parse(pages, scratch)
        found = shared_places(parsed, scratch).join(parsed.select("key", "page_id"), "key").collect()
        got = {r.page_id: r.text for r in extract_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(r.page_id for r in found) == list(range(40))
    assert all(r.shared == [0, 1, 3] and r.open_at == [] for r in found)
    assert got == {i: f"shared line\nown {i}" for i in range(40)}
