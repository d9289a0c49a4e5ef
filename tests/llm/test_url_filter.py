"""URL rules and aliases against brute force."""

import random

from corpuslens.llm.common import Scratch, components
from corpuslens.llm.url_filter import RULES, judge_urls, links

SCHEMA = "page_id long, url string, html string, host string, verdict int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def ruled(url, rules=RULES):
    host, path = parts(url)
    best = None
    for verdict, rule in rules:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def judged(rows, edges):
    up = {}

    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    nodes = {n for e in edges for n in e}
    for a, b in edges:
        up[root(a)] = root(b)
    by = {}
    for n in nodes:
        by.setdefault(root(n), set()).add((ruled(n) or (None,))[0])
    out = []
    for i, url, _ in rows:
        rule, seen = ruled(url), by.get(root(url), set()) if url in nodes else set()
        verdict = rule[0] if rule else "block" if "block" in seen and "allow" not in seen else "allow"
        out.append((i, *parts(url), rule and rule[1], verdict))
    return sorted(out, key=str)


def run(spark, rows, redirects=None):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    extra = None if redirects is None else spark.createDataFrame(redirects, "a string, b string")
    return sorted((tuple(r)[:5] for r in judge_urls(df, redirects=extra).collect()), key=str)


def canonical(to):
    return f'<html><head><LINK href="{to}" rel="canonical"></head>'


def test_random_links(spark):
    rng = random.Random(3)
    hosts = ["a.org", "example.org", "x.example.org", "b.com", "c.net", "d.net", "e.net", "org", "forg"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['es/', 'en/1', 'fr/', 'de/', 'x/', ''])}{i}" for i in range(300)]
    rows, edges = [], []
    for i, u in enumerate(urls):
        to = rng.choice(urls) if rng.random() < 0.5 else None
        rows.append((i, u, canonical(to) if to else "<p>x</p>"))
        if to:
            edges.append((u, to))
    assert run(spark, rows) == judged(rows, edges)


def test_long_chain_and_hub(spark):
    n = 200
    chain = [f"http://c.net/{i * 37 % n}" for i in range(n)] + ["http://z.com/de/end"]
    rows = [(i, u, canonical(chain[i + 1]) if i < n else None) for i, u in enumerate(chain)]
    hub = "http://hub.net/"
    rows += [(1000 + i, f"http://h.net/{i}", f'<meta content="0; URL={hub}" http-equiv=refresh>') for i in range(500)]
    edges = list(zip(chain, chain[1:])) + [(f"http://h.net/{i}", hub) for i in range(500)]
    assert run(spark, rows, [(hub, "http://bad.com/de/x"), (None, "x"), ("no", None)]) == judged(rows, edges + [(hub, "http://bad.com/de/x")])


def test_allow_beats_block(spark):
    rows = [(1, "http://p.net/a", canonical("http://q.com/de/1")), (2, "http://r.net/b", canonical("http://q.com/de/1")), (3, "http://r.net/b", canonical("http://s.org/")), (4, "http://q.com/de/1", None)]
    edges = [("http://p.net/a", "http://q.com/de/1"), ("http://r.net/b", "http://q.com/de/1"), ("http://r.net/b", "http://s.org/")]
    got = run(spark, rows)
    assert got == judged(rows, edges)
    assert [r[4] for r in got] == ["allow", "allow", "allow", "block"]
    assert [r[4] for r in run(spark, rows[:2])] == ["block", "block"]


def test_odd_urls(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "a.org/x", canonical("http://b.com/de/")), (4, "http://A.ORG", None), (5, "http://É.org/?x#y", None), (None, "http://a.org/p", None),
        (6, "://b.com/de/x", None), (7, "http://x://y.org/z", None), (8, "http://b.com/de\nx/", None), (9, "http://example.org/en/12#q", None), (9, "http://example.org/en/12#q", None), (10, "http://b.com#/de/", None),
    ]
    assert run(spark, rows) == judged(rows, [])
    assert run(spark, []) == []


def test_targets(spark):
    base = "http://H.net/dir/page?q=1#f"
    cases = {
        "<link rel=canonical href=/abs>": "http://h.net/abs", "<link rel='x canonical' href='rel'>": "http://h.net/dir/rel", '<link rel="canonical" href="//o.net/a">': "http://o.net/a",
        '<link rel="canonical" href="?p=2">': "http://h.net/dir/page?p=2", '<meta http-equiv="Refresh" content="5;url=\'https://T.net/a&amp;b#z\'">': "https://t.net/a&b",
        '<link rel="stylesheet" href="/c">': None, '<meta http-equiv="refresh" content="5">': None, '<link rel="canonical">': None, '<link rel="canonical" href="HTTPS://U.net">': "https://u.net",
    }
    for html, target in cases.items():
        got = [r.b for r in links(spark.createDataFrame([(base, html)], "url string, html string"), Scratch(spark, "test-url")).collect()]
        assert [x for x in got if x] == [target] * (target is not None), html


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(None, 1), (2, None), (5, 5)]
    up = list(range(300))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = sorted((root(a), root(b)))
            up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test-components")).collect()}
    linked = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
