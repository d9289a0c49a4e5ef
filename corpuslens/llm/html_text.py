"""Main text of HTML pages: differencing against the page with the nearest URL, checked by markup.

A page is cut into blocks of text. Every page with text is differenced: pages are ordered by host and
URL path over the whole table, each is paired with the neighbour on its host whose path has the longer
prefix in common, the two lists of lines are aligned by longest common subsequence, and lines that both
pages share are marked for deletion. A check by markup follows: what lies in an article (or main) element
is put back, what lies in menus, headers, footers, forms, notices and the like goes although it is the
page's own. On pages without such an element differencing has the last word on all that is not marked.
Ranges of the order are streamed, so a host may have any number of pages; the pages at the ends of
ranges, two a range, are paired afterwards. Lines are compared as hashes; texts stay where they are.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read, with_small
from corpuslens.llm.registry import query
from corpuslens.llm.url_filter import host_path

#: A page that shares this part of its open text with its neighbour is a copy of it, which tells nothing.
COPY = 0.8

DROPPED = frozenset("nav footer aside form script style noscript template iframe svg button select textarea input menu dialog head title object canvas math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the first kind closes an open element of the second.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS_CLOSE_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Words in class, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion "
    "recommended related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget widgets "
    "contentinfo complementary alert alertdialog dialog".split()
)
_COMMENT_END, _NAME = "-->", re.compile(r"<(/?)([a-zA-Z][\w:-]*)")
#: Elements whose content is no markup, up to their end tag or the end of the page.
_RAW = re.compile(r"<(script|style|textarea|title|noscript|template|iframe)\b", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}
_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
#: Characters in which the end of most tags lies.
_NEAR = 2_000
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([\w:-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _marked(tag: str, attributes: str) -> bool:
    """Whether class, id, role or a hiding attribute says that the element is not part of the text."""
    if not attributes.strip():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True
        if name in ("class", "id", "role") and tag not in ("body", "html") and not MARKS.isdisjoint(_WORD.findall(value)):
            return True
    return False


class _TagEnds:
    """Where a tag ends that begins anywhere: at the first ``>`` outside quotes, found by one scan from the right."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _SPECIAL.finditer(page)]
        self.ends = [-1] * (len(self.at) + 1)
        plain, double, single = -1, -1, -1  # the end from here on, outside quotes and inside each kind
        for i in range(len(self.at) - 1, -1, -1):
            c = page[self.at[i]]
            if c == ">":
                plain = self.at[i]
            elif c == '"':
                plain, double = double, plain
            else:
                plain, single = single, plain
            self.ends[i] = plain

    def after(self, place: int) -> int:
        return self.ends[bisect.bisect_left(self.at, place)]


def _tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``start, end, kind, name, attributes`` of what is no text, in order; kind is start, end, raw or other.

    A tag ends at the first ``>`` outside quotes, or at the first one if quotes don't match; without any
    ``>`` ahead nothing but a comment is left to find. Every character is looked at a few times at most.
    """
    last = page.rfind(">")
    ends: _TagEnds | None = None
    at = 0
    while (i := page.find("<", at) if at <= last else page.find("<!--", at)) >= 0:
        if page.startswith("<!--", i):
            end = page.find(_COMMENT_END, i + 4)
            at = len(page) if end < 0 else end + 3
            yield i, at, "other", "", ""
        elif i > last:
            at = i + 1
        elif page.startswith(("<!", "<?"), i):
            at = page.find(">", i) + 1
            yield i, at, "other", "", ""
        elif m := _RAW.match(page, i):
            close = _RAW_END[m[1].lower()].search(page, page.find(">", i) + 1)
            at = close.end() if close else len(page)
            yield i, at, "raw", m[1].lower(), ""
        elif m := _TAG.match(page, i, i + _NEAR):
            at = m.end()
            yield i, at, "end" if m[1] else "start", m[2].lower(), m[3]
        elif m := _NAME.match(page, i):
            ends = ends or _TagEnds(page)
            end = ends.after(m.end())
            end = page.find(">", m.end()) if end < 0 else end
            at = end + 1
            yield i, at, "end" if m[1] else "start", m[2].lower(), page[m.end() : end]
        else:
            at = i + 1


class _Element:
    """An open element knows the one around it; what it inherits is set when it opens, or when the page ends."""

    __slots__ = ("tag", "around", "solid", "drop", "closed", "holds_main", "in_main", "in_article", "out", "unclosed", "seen")

    def __init__(self, tag: str, drop: str, around: _Element | None):
        self.tag, self.around, self.drop = tag, around, drop
        self.solid = self if tag not in INLINE else around.solid if around else None
        self.in_article = tag == "article" or (around is not None and around.in_article)
        self.in_main = tag == "main" or (around is not None and around.in_main)
        self.closed = self.holds_main = self.seen = False


#: An end tag closes these, if they are open inside its element.
_CLOSED_ALONG = frozenset(("p", "li", "dt", "dd", "td", "th", "tr", "option"))


def blocks(page: str | None) -> list[tuple[str, str]]:
    """``(kind, text)`` of the blocks of a page in order; kind is main, open or boilerplate.

    White space inside a block is one space; empty blocks are left out. An element marked as boilerplate
    by class only is none if the page's only article or main elements lie in such ones; one that is never
    closed ends with the block it begins with. Of several main elements the articles count, if there are
    any. Time and memory are linear in the page, whatever its markup.
    """
    page = page or ""
    stack: list[_Element] = []
    open_tags: Counter[str] = Counter()
    elements: list[_Element] = []
    found: list[tuple[_Element | None, list[str]]] = []
    pieces: list[str] = []
    holder: _Element | None = None
    mains: list[_Element | None] = []
    solid = lambda e: e.solid if e else None

    def flush() -> None:
        nonlocal pieces
        if pieces:
            found.append((holder, pieces))
        pieces = []

    def text(raw: str) -> None:
        nonlocal holder
        if raw:
            now = stack[-1] if stack else None
            if pieces and solid(holder) is not solid(now):
                flush()
            if not pieces:
                holder = now
            pieces.append(raw)

    def cut(i: int) -> None:
        for e in stack[i:]:
            open_tags[e.tag] -= 1
        del stack[i:]

    at = 0
    for start, end, kind, tag, attributes in _tags(page):
        text(page[at:start])
        at = end
        if kind in ("other", "raw"):
            if tag == "textarea":
                flush()
            continue
        if tag == "br":
            pieces and pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if kind == "end":
            if open_tags[tag]:
                i = len(stack) - 1
                while stack[i].tag != tag:
                    stack[i].closed = stack[i].closed or stack[i].tag in _CLOSED_ALONG
                    i -= 1
                stack[i].closed = True
                cut(i)
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        closes = CLOSES.get(tag, frozenset()) | ({"p"} if tag in BLOCKS_CLOSE_P else frozenset())
        for i in range(len(stack) - 1, max(len(stack) - 4, -1), -1):
            if stack[i].tag in closes:
                stack[i].closed = True
                cut(i)
                break
        around = stack[-1] if stack else None
        in_main = around is not None and (around.in_main or around.in_article)
        drop = "tag" if tag in DROPPED or (tag == "header" and not in_main) else "mark" if _marked(tag, attributes) else ""
        if tag in ("article", "main") and not drop:
            mains.append(around)
            e = around
            while e is not None and not e.holds_main:
                e.holds_main = True
                e = e.around
        stack.append(_Element(tag, drop, around))
        open_tags[tag] += 1
        elements.append(stack[-1])
    text(page[at:])
    flush()

    # elements come after the one around them
    for e in elements:
        e.out = bool(e.drop and e.closed) or (e.around is not None and e.around.out)
    free = any(e is None or not e.out for e in mains)
    for e in elements:
        counts = bool(e.drop) and not (e.drop == "mark" and e.holds_main and not free)
        e.out = (counts and e.closed) or (e.around is not None and e.around.out)
        e.unclosed = e if e.drop and not e.closed else e.around.unclosed if e.around else None
        e.drop = e.drop if counts else ""

    out: list[tuple[str, str, bool, bool]] = []
    for e, parts in found:
        line = "".join(parts)
        line = _SPACE.sub(" ", entities.unescape(line) if "&" in line else line).strip()
        if not line:
            continue
        dropped = e is not None and e.out
        # an element met for the first time: those around it are met as well
        first = e.unclosed if e else None
        while first is not None and not first.seen:
            first.seen = True
            dropped = dropped or bool(first.drop)
            first = first.around.unclosed if first.around else None
        out.append((line, "boilerplate" if dropped else "open", e is not None and e.in_article, e is not None and e.in_main))
    kept = [x for x in out if x[1] == "open"]
    scope = 2 if any(x[2] for x in kept) else 3 if any(x[3] for x in kept) else None
    return [("boilerplate" if kind != "open" or (scope and not x[scope - 2]) else "main" if scope else "open", line) for line, kind, *x in out]


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``, in linear memory."""
    places = np.flatnonzero(np.isin(a, b))
    a, b = a[places], b[np.isin(b, a)]
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, k, j, n = todo.pop()
        while i < k and j < n and a[i] == b[j]:
            out.append(int(places[i]))
            i, j = i + 1, j + 1
        while i < k and j < n and a[k - 1] == b[n - 1]:
            k, n = k - 1, n - 1
            out.append(int(places[k]))
        if i >= k or j >= n:
            continue
        if k - i == 1:
            if (b[j:n] == a[i]).any():
                out.append(int(places[i]))
            continue
        half = (i + k) // 2
        top, bottom = _lengths(a[i:half], b[j:n]), _lengths(a[half:k][::-1], b[j:n][::-1])[::-1]
        cut = j + int((top + bottom).argmax())
        todo += [(i, half, j, cut), (half, k, cut, n)]
    return sorted(out)


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        better = np.maximum(row[1:], row[:-1] + (b == x))
        row[1:] = np.maximum.accumulate(better)
    return row


def _line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


PARSED = "key long, page_id long, url string, host string, path string, lines array<string>, open array<boolean>, every array<long>, at array<int>"


def _parsed(batches):
    """Blocks that may stay, whether each is open, the hashes of all blocks, and the places of those that may stay."""
    from pyspark import TaskContext

    key = TaskContext.get().partitionId() << 33
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int32()))
    names = [c.split()[0] for c in PARSED.split(", ")]
    for batch in batches:
        rows, size = [], 0
        for page_id, url, host, path, page in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            found = blocks(page)
            stays = [(i, kind == "open", line) for i, (kind, line) in enumerate(found) if kind != "boilerplate"]
            rows.append((key, page_id, url, host, path, [x[2] for x in stays], [x[1] for x in stays], [_line_hash(x[1]) for x in found], [x[0] for x in stays]))
            key, size = key + 1, size + len(page or "")
            if size > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _partner(own, before, after):
    """Of the neighbours (host, path, every) on the same host, the one with the longer common path; the former on a tie."""
    near = [x for x in (before, after) if x is not None and x[0] == own[0]]
    return max(near, key=lambda x: _prefix(own[1], x[1])) if near else None


def _shared(own, before, after) -> list[int]:
    """Places that a page shares with its partner; pages are (key, host, path, every, ...)."""
    mate = _partner(own[1:], before and before[1:], after and after[1:])
    return common_lines(np.array(own[3]), np.array(mate[2])) if mate else []


STREAMED = "key long, host string, path string, every array<long>, open_at array<int>, shared array<int>, edge boolean"


def _paired(batches):
    """Streams pages in URL order. Pages with both neighbours in the range are differenced (edge is null).

    The first and the last page need the neighbouring ranges: they are returned as edges, beside the pages
    next to them.
    """
    types = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_())
    names = [c.split()[0] for c in STREAMED.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 7, types, strict=True)], names=names)

    head, tail, out = [], [], []
    for batch in batches:
        for page in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if len(head) < 2:
                head.append(page)
            tail = [*tail[-2:], page]
            if len(tail) == 3:
                out.append((tail[1][0], None, None, None, tail[1][4], _shared(tail[1], tail[0], tail[2]), None))
            if len(out) == 1000:
                yield batch_of(out)
                out = []
    ends = {page[0]: page for page in [*head, *tail[-2:]]}
    edges = {page[0] for page in [*head[:1], *tail[-1:]]}
    yield batch_of(out + [(*page, None, key in edges) for key, page in ends.items()])


def _edges_decided(batches):
    """The same for the pages at the ends of all ranges, in URL order."""
    pages = [x for batch in batches for x in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)]
    beside = lambda i: pages[i][:4] if 0 <= i < len(pages) else None
    out = [(page[0], page[4], _shared(page[:4], beside(i - 1), beside(i + 1))) for i, page in enumerate(pages) if page[5]]
    columns = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))]
    yield pa.RecordBatch.from_arrays(columns, names=["key", "open_at", "shared"])


def shared_places(parsed: DataFrame, scratch: Scratch) -> DataFrame:
    """``key, open_at, shared`` of every page with text: places that markup leaves open, and those shared with its partner.

    Any page with text may be the partner."""
    order = ["host", "path", "key"]
    places = F.filter(F.arrays_zip("at", "open"), lambda x: x["open"])["at"].alias("open_at")
    pages = parsed.filter("size(every) > 0").select("key", "host", "path", "every", places)
    streamed = pages.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.keep(streamed.mapInArrow(_paired, STREAMED))
    # one task has the ends: four pages of each range at most
    ends = rows.filter("edge is not null").coalesce(1).sortWithinPartitions(*order)
    edges = ends.select("key", "host", "path", "every", "open_at", "edge").mapInArrow(_edges_decided, "key long, open_at array<int>, shared array<int>")
    return rows.filter("edge is null").select("key", "open_at", "shared").unionAll(edges)


def parse(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """The pages cut into blocks, judged by markup."""
    host, path = host_path(F.col("url"))
    return scratch.keep(pages.select(F.col("page_id").cast("long"), "url", host.alias("host"), path.alias("path"), "html").mapInArrow(_parsed, PARSED))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``page_id, url, html``.

    Blocks are joined by ``\\n`` in page order; character references are decoded. A null, empty or
    textless page has an empty text. Pages without URL count as one host of their own. Equal pages are
    extracted alike unless differencing decides; a page that shares COPY of its open text with its
    partner keeps it all. Rows may repeat; other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "html")
    parsed = parse(pages, scratch)
    # the check: of the lines that differencing deletes, markup puts back those it knows for the article's
    deleted = shared_places(parsed, scratch).select("key", F.array_intersect("shared", "open_at").alias("shared")).filter("size(shared) > 0")
    rows = with_small(parsed, scratch.keep(deleted), ["key"])
    line = F.transform("lines", lambda x, i: F.struct(x.alias("line"), (F.get("open", i) & F.array_contains("shared", F.get("at", i))).alias("shared")))
    rows = rows.withColumn("l", line).withColumn("gone", F.filter("l", lambda x: F.coalesce(x["shared"], F.lit(False))))
    size = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + F.length(x["line"]))
    copy = size("gone") >= COPY * size("l")
    stays = F.filter("l", lambda x: ~F.coalesce(x["shared"], F.lit(False)))
    text = F.when(F.col("shared").isNull() | copy, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(stays, lambda x: x["line"]), "\n"))
    done = rows.select("page_id", "url", text.alias("text"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op10_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
