"""Tokens of two vocabularies aligned over the same bytes, with corpus-wide counts of the pairs they form.

A link is a pair of token occurrences, one of each tokenizer, whose byte ranges overlap. Tasks tokenize
whole texts and gather their links in buffers. A full buffer is sorted, cut by the radix of its B ids and
written as zstd runs of (pair, document, times), so memory is bounded by the buffer and the runs lie in
the shared folder. The counts of a radix are merged from the heads of its runs (each pair once, however
many documents have it) through a heap, in rounds of bounded fan-in. Merged rows come in the order of B
ids, so a B id's highest count is known when its rows end. Runs then meet the counts of their radix in
groups of bounded size, and every document gets back what its links are worth.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read, sliced
from corpuslens.llm.packing import encoder
from corpuslens.llm.registry import query

PIECES = "piece_bpe_32k.model"
#: Links of a buffer, about, and documents at most.
RUN_LINKS, RUN_DOCS = 2_000_000, 1 << 18
#: Parts by B id, and runs merged at once.
RADIX, FAN_IN = 32, 64
#: Packed bytes of the runs that meet the counts of their radix in one group, about.
GROUP_BYTES = 24 << 20
#: Bytes of remembered segments, about; as many again are kept of the ones before.
MEMORY = 48 << 20

# A link's code: radix of the B id, the rest of the B id, the A id, the document's place in its buffer.
A_BITS, B_BITS, DOC_BITS = 20, 20, 18


class Vocabularies:
    """The two tokenizers, and what is needed to align them: bytes and decimal forms of their tokens."""

    def __init__(self, a_path: str | None, b_path: str | None, radix: int):
        import public_tokenizers
        import sentencepiece

        self.a = encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path(PIECES))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        # a byte piece is written <0xHH>
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes = [b""] * self.a.n_vocab
        for token in self.a.token_byte_values():
            self.a_bytes[self.a.encode_single_token(token)] = token
        self.a_size, self.b_size = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        # decimal ids with what comes behind them: A inside and at the end of a group, B likewise
        written = [b"%d" % i + end for side, ends in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for end in (ends[:1], ends[1:]) for i in range(len(side))]
        self.written = np.array(written, dtype=object)
        if max(self.a.n_vocab, len(pieces)) > 1 << A_BITS:
            raise ValueError("vocabularies of more than 2^20 tokens don't fit the codes")
        if not 1 <= radix <= 1 << (63 - A_BITS - B_BITS - DOC_BITS):
            raise ValueError("from 1 to 32 parts fit the codes")
        self.radix = radix
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        #: Whether no B token reaches over an end of SEGMENT, and blanks are kept as they are.
        self.cuts = not any(re.search(r"[^▁]▁|\n|[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]", p) for p in plain) and self.b_ids("  a  b ") is not None

    @functools.cached_property
    def blank(self) -> int:
        return self.b.piece_to_id("▁")

    def b_ids(self, text: str) -> list[int] | None:
        """B ids of a part of a text; None if they don't spell it."""
        if text[0] == " ":
            ids = self.b.encode(text[1:]) if len(text) > 1 else [self.blank]  # it adds the blank itself
        else:
            ids = self.b.encode("\n" + text)[2:]  # without the blank and a newline, which is a token of its own
        return ids if b"".join([self.b_bytes[i] for i in ids]) == text.encode() else None


#: Parts of a text that tokens of neither vocabulary reach over, if blanks and newlines are its only white
#: space: the byte-level one splits before white space and between letters and other signs.
SEGMENT = re.compile(r"[ \n]+[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,;:!? \n]|\Z)|[ \n]+[^ \n]*|[.,;:!?][^ \n]*")
OTHER_SPACE = re.compile(r"[^\S \n]")
#: Segments that keep their tokens when any such are put one behind the other.
SIMPLE = re.compile(r"[ \n][^ \n▁]+")


@functools.lru_cache(maxsize=2)
def vocabularies(a_path: str | None = None, b_path: str | None = None, radix: int = RADIX) -> Vocabularies:
    return Vocabularies(a_path, b_path, radix)


#: Numbers of A tokens, B tokens and groups in one integer; sums of these don't run over.
SHIFT = 1 << 42


class Aligned(dict):
    """What a segment's tokens are: ``(sizes, groups, links)`` by segment, the frequent ones remembered.

    ``sizes`` packs the numbers of A tokens, B tokens and groups, ``groups`` is written as the digest
    wants it, and ``links`` are codes without document, 8 bytes each. A segment that the B tokens don't
    spell is None.
    """

    def __init__(self, vocabularies: Vocabularies, memory: int = MEMORY):
        super().__init__()
        self.v, self.memory, self.size, self.before = vocabularies, memory, 0, {}

    def __missing__(self, segment: str):
        found = self.before.get(segment, self)
        return self._remember(segment, self.align(segment) if found is self else found)

    def _remember(self, segment: str, found):
        cost = 300 + 2 * len(segment) + (len(found[1]) + len(found[2]) if found else 0)
        if cost * 1000 < self.memory:
            self.size += cost
            if self.size > self.memory:
                self.before = dict(self)
                self.clear()
                self.size = cost
            self[segment] = found
        return found

    def align(self, text: str):
        b = self.v.b_ids(text)
        return None if b is None else self._aligned(self._a_ids(text), np.array(b), np.array([len(text.encode())]))[0]

    def _a_ids(self, text: str) -> np.ndarray:
        return self.v.a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def learn(self, texts: Iterable[str | None], at_once: int = 4096) -> None:
        """Aligns segments of the texts that are not known yet, many at a time."""
        new: dict[str, None] = {}
        for text in texts:
            if text and not OTHER_SPACE.search(text):
                new.update((x, None) for x in SEGMENT.findall(" " + text) if x not in self and x not in self.before)
        simple = [x for x in new if len(x) < 200 and SIMPLE.fullmatch(x)] if self.v.cuts else []
        for k in range(0, len(simple), at_once):
            part = simple[k : k + at_once]
            text = "".join(part)
            b = self.v.b_ids(text)
            if b is None:
                continue  # one of them is not spelt: each is looked at when it is met
            ends = np.cumsum([len(x.encode()) for x in part])
            for x, found in zip(part, self._aligned(self._a_ids(text), np.array(b), ends), strict=True):
                self._remember(x, found)

    def _aligned(self, a: np.ndarray, b: np.ndarray, cuts: np.ndarray) -> list[tuple[int, bytes, bytes]]:
        """The segments that end at the byte offsets ``cuts``, where tokens of both sides end.

        A link belongs to every offset where a token of either side ends.
        """
        v = self.v
        mark = np.zeros(int(cuts[-1]) + 1, dtype=np.uint8)
        mark[np.cumsum(v.a_size[a])] |= 1
        mark[np.cumsum(v.b_size[b])] |= 2
        ends = np.flatnonzero(mark)
        is_a, is_b = (mark[ends] & 1).astype(bool), (mark[ends] & 2).astype(bool)
        i, j = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
        both = is_a & is_b
        links = ((b[j] % v.radix << B_BITS) | b[j] // v.radix) << A_BITS | a[i]
        # tokens in the order of writing: group by group, A before B
        group = np.cumsum(both) - both
        end_a, end_b = (i + 1)[both], (j + 1)[both]
        at_a = np.arange(len(a)) + np.concatenate([[0], end_b[:-1]])[group[is_a]]
        at_b = np.arange(len(b)) + end_a[group[is_b]]
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[at_a] = a + np.where(both[is_a], len(v.a_bytes), 0)
        order[at_b] = b + 2 * len(v.a_bytes) + np.where(both[is_b], len(v.b_bytes), 0)
        stops = np.searchsorted(ends, cuts, side="right")
        n_a, n_b, n_groups = (np.concatenate([[0], np.cumsum(x)])[stops] for x in (is_a, is_b, both))
        out, data = [], links.tobytes()
        last = (0, 0, 0, 0)
        for now in zip(stops.tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist(), strict=True):
            x, y = last[1] + last[2], now[1] + now[2]
            sizes = now[1] - last[1] + (now[2] - last[2]) * SHIFT + (now[3] - last[3]) * SHIFT * SHIFT
            out.append((sizes, b"".join(v.written[order[x:y]].tolist())[:-1], data[8 * last[0] : 8 * now[0]]))
            last = now
        return out

    def document(self, text: str | None):
        """``n_a, n_b, n_groups, groups, links`` of a text; None if it has no tokens."""
        if not text:
            return None
        text = " " + text
        if self.v.cuts and not OTHER_SPACE.search(text):
            parts = [self[s] for s in SEGMENT.findall(text)]
        else:
            parts = [self.align(text)]
        if None in parts:
            return None
        sizes, groups, links = zip(*parts, strict=True)
        n = sum(sizes)
        return n % SHIFT, n // SHIFT % SHIFT, n // SHIFT // SHIFT, b";".join(groups), b"".join(links)


# Numbers, packed

_KINDS = [np.dtype(x) for x in ("u1", "<u2", "<u4", "<u8")]


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in the smallest type that holds them, zstd-compressed."""
    import zstandard

    most = int(values.max()) if len(values) else 0
    kind = next(i for i, k in enumerate(_KINDS) if most <= np.iinfo(k).max)
    return bytes([kind]) + zstandard.ZstdCompressor(level=1).compress(values.astype(_KINDS[kind]).tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=_KINDS[data[0]]).astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, run long, place int"
RUN = "radix int, pairs binary, counts binary, sizes binary, places binary, times binary"
_TYPES = [*[pa.int64()] * 5, pa.string(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
_NAMES = [c.split()[0] for c in f"{DOCUMENT}, {RUN}".split(", ")]


def sorted_runs(links: np.ndarray, places: np.ndarray, radix: int) -> Iterator[tuple]:
    """Of a buffer's links and the places of their documents: one run per radix, as the columns of RUN.

    A run lists its pairs in order, with the number of links and of documents of each; then the documents,
    pair by pair, and how many links of the pair each has.
    """
    code = np.sort(links << DOC_BITS | places)
    first = np.flatnonzero(np.diff(code, prepend=-1))
    times = np.diff(first, append=len(code))
    code = code[first]
    bounds = [*np.searchsorted(code, np.arange(radix) << (A_BITS + B_BITS + DOC_BITS)), len(code)]
    for r, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if lo == hi:
            continue
        pair, n = code[lo:hi] >> DOC_BITS, times[lo:hi]
        at = np.flatnonzero(np.diff(pair, prepend=-1))
        yield (
            r, pack_sorted(pair[at]), pack(np.add.reduceat(n, at)), pack(np.diff(at, append=len(pair))),
            pack(code[lo:hi] & ((1 << DOC_BITS) - 1)), pack(n),
        )


def tokenized(docs: DataFrame, radix: int = RADIX, run_links: int = RUN_LINKS, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Rows of documents (``radix`` null) and rows of runs (``place`` null); both name their ``run``."""

    def spilled(batches):
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 32
        aligned = Aligned(vocabularies(a_path, b_path, radix))
        rows: list[tuple] = []
        held: list[bytes] = []
        size = 0

        def flushed():
            nonlocal run, size
            links = [np.frombuffer(x, dtype=np.int64) for x in held]
            if links:
                places = np.repeat(np.arange(len(links)), [len(x) for x in links])
                for r in sorted_runs(np.concatenate(links), places, radix):
                    rows.append((*[None] * 6, run, None, *r))
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(_TYPES), _TYPES, strict=True)], names=_NAMES)
            rows.clear()
            held.clear()
            run, size = run + 1, 0
            return out

        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            aligned.learn(texts)
            for doc, text in zip(batch.column(0), texts, strict=True):
                found = aligned.document(text)
                n_a, n_b, n_groups, groups, links = found or (0, 0, 0, None, b"")
                digest = "" if groups is None else hashlib.sha256(groups).hexdigest()
                rows.append((doc.as_py(), n_a, n_b, n_groups, len(links) // 8, digest, run, len(held), *[None] * 6))
                held.append(links)
                size += len(links) // 8
                if size >= run_links or len(held) == RUN_DOCS:
                    yield flushed()
        yield flushed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(spilled, f"{DOCUMENT}, {RUN}")


def merge_counts(runs: list[tuple[np.ndarray, np.ndarray]], block: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted runs of (pairs, counts) as one, in blocks: equal pairs are added up.

    The heap holds the last pair of every run's current block. Up to the least of them all runs have
    been read, so that much is merged; then the run whose block it was goes on.
    """
    at = [0] * len(runs)
    heap = [(int(p[min(block, len(p)) - 1]), k, min(block, len(p))) for k, (p, _) in enumerate(runs) if len(p)]
    heapq.heapify(heap)
    while heap:
        bound, k, end = heap[0]
        pairs, counts = [], []
        for _, i, stop in heap:
            p, c = runs[i]
            to = at[i] + int(np.searchsorted(p[at[i] : stop], bound, side="right"))
            pairs.append(p[at[i] : to])
            counts.append(c[at[i] : to])
            at[i] = to
        pair, count = np.concatenate(pairs), np.concatenate(counts)
        order = np.argsort(pair, kind="stable")
        pair, count = pair[order], count[order]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        yield pair[first], np.add.reduceat(count, first)
        p = runs[k][0]
        if end == len(p):
            heapq.heappop(heap)
        else:
            end = min(end + block, len(p))
            heapq.heapreplace(heap, (int(p[end - 1]), k, end))


def best_of_side(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id; pairs are sorted, so those of a B id are together."""
    if not len(pairs):
        return np.zeros(0, dtype=bool)
    side = pairs >> A_BITS
    first = np.flatnonzero(np.diff(side, prepend=-1))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(pairs)))


COUNTS = "radix int, run long, pairs binary, counts binary"


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    runs = [(unpack_sorted(p), unpack(c)) for p, c in zip(group["pairs"], group["counts"], strict=True)]
    pairs, counts = zip(*merge_counts(runs), strict=True)
    row = (group["radix"].iloc[0], group["run"].min() // FAN_IN, pack_sorted(np.concatenate(pairs)), pack(np.concatenate(counts)))
    return pd.DataFrame([row], columns=["radix", "run", "pairs", "counts"])


def pair_counts(runs: DataFrame, scratch: Scratch) -> DataFrame:
    """``radix, run, pairs, counts``: one row per radix with the counts of all its pairs over the corpus.

    Each round merges up to FAN_IN runs of a radix into one, so no task opens more at a time, and what
    it writes has every pair once.
    """
    # runs get consecutive numbers: there are few of them, one for about RUN_LINKS links, with a number each
    numbers = runs.select("run").distinct().withColumn("task", F.shiftright("run", 32)).withColumn("i", F.col("run").bitwiseAND((1 << 32) - 1))
    width = numbers.agg(F.max("i")).first()[0]
    if width is None:
        return runs.select(*[c.split()[0] for c in COUNTS.split(", ")])
    left = numbers.agg((F.max("task") + 1) * (width + 1)).first()[0]
    number = F.shiftright("run", 32) * (width + 1) + F.col("run").bitwiseAND((1 << 32) - 1)
    heads = runs.select("radix", number.alias("run"), "pairs", "counts")
    while True:
        grouped = heads.groupBy("radix", F.floor(F.col("run") / FAN_IN).alias("to"))
        heads = scratch.keep(grouped.applyInPandas(_merged, COUNTS))
        left = -(-left // FAN_IN)
        if left <= 1:
            return heads


PARTS = "run long, place int, n_best long, count_sum long"


def _given_back(runs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    out = [np.zeros((0, 4), dtype=np.int64)]
    if len(runs):
        all_pairs, all_counts = unpack_sorted(counts["pairs"].iloc[0]), unpack(counts["counts"].iloc[0])
        best = best_of_side(all_pairs, all_counts)
        for run, pairs, sizes, places, times in zip(runs["run"], runs["pairs"], runs["sizes"], runs["places"], runs["times"], strict=True):
            at = np.searchsorted(all_pairs, unpack_sorted(pairs))
            sizes, places, times = unpack(sizes), unpack(places), unpack(times)
            n_best = np.bincount(places, weights=times * np.repeat(best[at], sizes))
            total = np.zeros(len(n_best), dtype=np.int64)
            np.add.at(total, places, times * np.repeat(all_counts[at], sizes))
            has = np.flatnonzero(np.bincount(places))
            out.append(np.column_stack([np.full(len(has), run), has, n_best[has].astype(np.int64), total[has]]))
    return pd.DataFrame(np.concatenate(out), columns=["run", "place", "n_best", "count_sum"])


def given_back(runs: DataFrame, counts: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """PARTS: what the pairs of one radix are worth to a document, for every radix it has pairs of.

    The runs of a radix are dealt to as many groups as their bytes ask for; each group gets a copy of
    the radix's counts. A run is one row, so a pair that a third of all documents have is spread over as
    many runs as there are.
    """
    size = sum((F.length(c) for c in ("pairs", "sizes", "places", "times")), F.lit(0))
    # one row per radix
    groups = {r["radix"]: 1 + int(r["n"] // group_bytes) for r in runs.groupBy("radix").agg(F.sum(size).alias("n")).collect()}
    if not groups:
        return runs.select("run", F.lit(0).alias("place"), F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    several = F.element_at(F.create_map(*[F.lit(x) for pair in groups.items() for x in pair]), F.col("radix"))
    left = runs.select("radix", F.pmod(F.xxhash64("run"), several).cast("int").alias("part"), "run", "pairs", "sizes", "places", "times")
    right = counts.select("radix", F.explode(F.sequence(F.lit(0), several - 1)).alias("part"), "pairs", "counts")
    return left.groupBy("radix", "part").cogroup(right.groupBy("radix", "part")).applyInPandas(_given_back, PARTS)


def align_tokens(
    docs: DataFrame, radix: int = RADIX, run_links: int = RUN_LINKS, a_path: str | None = None, b_path: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The documents' figures, and the pairs of tokens with their counts.

    The first has one row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``, where ``n_best`` counts links whose pair is the most frequent of its B id (ties
    included), ``count_sum`` adds up the counts of the pairs over the links, and ``groups_sha256`` is the
    hash of ``a1,a2|b1;a3|b2,b3``, the ids between offsets where tokens of both sides end. The second has
    one row per pair: ``a, b, n, best``. A blank is put before each text; a text that is null, empty, or
    not what its tokens spell has no tokens, zeros, and an empty digest. Rows that share an id, or have
    none, are documents of their own, and equal rows count each. Other columns are not read. A task holds
    one buffer of about ``run_links`` links, and one document more.
    """
    scratch = Scratch(docs.sparkSession, "alignment")
    rows = scratch.keep(tokenized(docs, radix, run_links, a_path, b_path))
    documents = rows.filter("radix is null").select(*[c.split()[0] for c in DOCUMENT.split(", ")])
    runs = rows.filter("radix is not null").select("run", *[c.split()[0] for c in RUN.split(", ")])
    counts = pair_counts(runs, scratch)
    parts = given_back(runs, counts).groupBy("run", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    worth = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_best", "count_sum")}
    joined = documents.join(parts, ["run", "place"], "left").withColumns(worth)
    figures = joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return figures, counts.select("radix", "pairs", "counts").mapInArrow(functools.partial(_pair_rows, radix=radix), "a int, b int, n long, best boolean")


def _pair_rows(batches, radix: int):
    for batch in batches:
        for r, p, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            pairs, counts = unpack_sorted(p), unpack(c)
            best = best_of_side(pairs, counts)
            a = pairs & ((1 << A_BITS) - 1)
            b = ((pairs >> A_BITS) & ((1 << B_BITS) - 1)) * radix + r
            for i in range(0, len(pairs), 100_000):
                s = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(a[s].astype(np.int32)), pa.array(b[s].astype(np.int32)), pa.array(counts[s]), pa.array(best[s])], names=["a", "b", "n", "best"])


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read(spark, sf_dir, "documents"))[0]
