"""Documents packed into token windows, each filled with what a lexical index finds near its seed.

Documents are tokenized once. In how many of them a term occurs, and how long they are, is counted over the
whole corpus; the counts are bounded by the vocabulary. Each document is known by its heaviest terms under
these counts, and the corpus is put in the order of them, so that documents of like words stand together
wherever they came from. That order is cut every so many tokens into shards, each an inverted index with BM25
weights. Whole windows of long documents stand alone; of the rest, a seed opens a window, its unused
neighbours fill it in the order of their scores, and the last one is cut, its remainder staying in the
index. What is left at the end of shards is indexed and packed once more, a few hundred shards together, and
what then is left is cut into sequences of powers of two, which need no padding.
Order, shards and windows follow from the documents alone, not from files or partitions.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, read, sliced
from corpuslens.llm.registry import query

WINDOW = 2048
#: Tokens of a shard, about.
SHARD = 1 << 20
#: What is left of so many shards, less than a window of each, is packed together.
SHARDS_LEFT = 512
K1, B = 1.2, 0.75
#: A document's place in the corpus follows so many of its heaviest terms.
KEY_TERMS = 3
RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT, DOCUMENT_END = {"<|endoftext|>": 50256}, 1


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None):
    """The byte-level BPE of the file of ranks; the same ids as its form for ``tokenizers``, in less time."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=END_OF_TEXT)


def token_ids(text: str | None, path: str | None = None) -> np.ndarray:
    """Ids of the text, then the id that ends a document."""
    ids = encoder(path).encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, dtype=np.uint32)
    return np.append(ids, np.uint32(DOCUMENT_END)).astype(np.uint32)


def id_type(path: str | None = None) -> np.dtype:
    """The smallest unsigned type that holds all ids of the tokenizer."""
    return np.dtype("<u2" if encoder(path).n_vocab <= 1 << 16 else "<u4")


@dataclass
class Statistics:
    """Of a corpus: by id of a term its weight, which is 0 for terms in more than half of the documents, and the mean length of what is indexed of a document."""

    idf: np.ndarray
    mean: float

    @classmethod
    def of(cls, df: np.ndarray, documents: int, mean: float) -> Statistics:
        return cls(np.maximum(0.0, np.log((documents - df + 0.5) / (df + 0.5))), mean)

    def weights(self, terms: np.ndarray, counts: np.ndarray, length) -> np.ndarray:
        """BM25 weights of terms that occur so often in pieces of that length."""
        return self.idf[terms] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * length / self.mean))

    def key(self, ids: np.ndarray, terms: int = KEY_TERMS) -> list[int]:
        """The heaviest terms of a document, heaviest first and smaller ids first among equals; -1 where there are fewer."""
        found, counts = np.unique(ids, return_counts=True)
        weight = self.weights(found, counts, len(ids))
        best = np.argsort(-weight, kind="stable")[:terms]
        best = found[best[weight[best] > 0]].tolist()
        return best + [-1] * (terms - len(best))


class Index:
    """Inverted index of pieces of documents, weighted by the statistics of their corpus."""

    def __init__(self, pieces: list[np.ndarray], corpus: Statistics):
        n = self.n = len(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        key = np.concatenate(pieces).astype(np.int64) * n + np.repeat(np.arange(n), sizes)
        key, count = np.unique(key, return_counts=True)
        term, self.piece = key // n, (key % n).astype(np.int32)
        self.terms, self.start = np.unique(term, return_index=True)
        self.start = np.append(self.start, len(term))
        self.weight = corpus.weights(term, count, sizes[self.piece])
        self.useful = corpus.idf[self.terms] > 0

    def neighbours(self, seed: np.ndarray) -> np.ndarray:
        """Pieces that share a term with the seed, best first; equal scores in the order of the shard."""
        at = np.searchsorted(self.terms, np.unique(seed.astype(np.int64)))
        at = at[self.useful[at]]
        first, sizes = self.start[at], self.start[at + 1] - self.start[at]
        ends = np.cumsum(sizes)
        if not len(ends):
            return np.zeros(0, dtype=np.int64)
        places = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
        score = np.bincount(self.piece[places], weights=self.weight[places], minlength=self.n)
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


class Piece:
    """Part of a document: ``ids`` begin at token ``start`` of it, which has ``total`` tokens."""

    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, ids: np.ndarray, start: int, total: int):
        self.doc, self.ids, self.start, self.total = doc, ids, start, total

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.ids[:n], self.start, self.total), Piece(self.doc, self.ids[n:], self.start + n, self.total)


def fill_windows(pieces: list[Piece], corpus: Statistics, window: int = WINDOW) -> Iterator[tuple[bool, list[Piece]]]:
    """Windows of a shard as ``(full, pieces)``; all are full but the last, if its tokens do not suffice."""
    rest: list[Piece | None] = []
    for p in pieces:
        while len(p.ids) >= window:
            whole, p = p.split(window)
            yield True, [whole]
        if len(p.ids):
            rest.append(p)
    if not rest:
        return
    index = Index([p.ids for p in rest], corpus)
    next_ = 0
    while True:
        while next_ < len(rest) and rest[next_] is None:
            next_ += 1
        if next_ == len(rest):
            return
        seed, rest[next_] = rest[next_], None
        room, filled = window - len(seed.ids), [seed]

        def candidates(seed=seed):
            yield from index.neighbours(seed.ids)
            yield from range(next_, len(rest))  # nothing is lexically near: the next in order

        for i in candidates():
            if not room:
                break
            p = rest[i]
            if p is None:
                continue
            if len(p.ids) > room:
                p, rest[i] = p.split(room)
            else:
                rest[i] = None
            filled.append(p)
            room -= len(p.ids)
        yield not room, filled


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The pieces, in order, cut into sequences whose lengths are falling powers of two."""
    left = sum(len(p.ids) for p in pieces)
    queue = list(pieces)
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            p = queue.pop(0)
            if len(p.ids) > room:
                p, after = p.split(room)
                queue.insert(0, after)
            out.append(p)
            room -= len(p.ids)
        yield out


def tokenized(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, n, ids`` of every row: its tokens, and their ids as little-endian bytes of :func:`id_type`.

    Each task adds a row with a null ``n``, whose ``ids`` are the numbers of its documents that hold each term.
    """

    def encode(batches):
        kind, df = id_type(tokenizer), np.zeros(encoder(tokenizer).n_vocab, dtype="<i8")
        names = ["doc_id", "n", "ids"]
        for part in sliced(batches):
            ids = [token_ids(x, tokenizer).astype(kind) for x in part.column(1).to_pylist()]
            for x in ids:
                df[np.unique(x)] += 1
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([df.tobytes()])], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "doc_id long, n long, ids binary")


def corpus_statistics(tokens: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> Statistics:
    """Statistics of all rows of :func:`tokenized`; no more numbers than terms come to the driver."""

    def counts(batches):
        for batch in batches:
            for x in batch.column(0):
                df = np.frombuffer(x.as_buffer(), dtype="<i8")
                at = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["term", "df"])

    found = tokens.filter("n is null").select("ids").mapInArrow(counts, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(encoder(tokenizer).n_vocab, dtype=np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    rest = F.col("n") % window
    n, indexed, length = tokens.agg(F.count("n"), F.count_if(rest > 0), F.sum(rest)).first()
    return Statistics.of(df, n, (length / indexed) if indexed else 1.0)


def in_shards(tokens: DataFrame, corpus: Statistics, scratch: Scratch, shard: int = SHARD, tokenizer: str | None = None) -> DataFrame:
    """The rows with ``shard, at``: their place, in tokens, in the corpus ordered by heaviest terms, and the shard it falls into.

    The order goes on to checksum, length and id, so that copies by the thousand are cut into ranges like
    any others; rows that are equal in all of these are interchangeable. The table ``tokens`` is dropped.
    """
    names = [f"key{k}" for k in range(KEY_TERMS)]

    def keyed(batches):
        kind = id_type(tokenizer)
        for part in sliced(batches):
            keys = [corpus.key(np.frombuffer(x.as_buffer(), dtype=kind)) for x in part.column(2)]
            columns = [pa.array([key[k] for key in keys], pa.int32()) for k in range(KEY_TERMS)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=["doc_id", "n", "ids", *names])

    def placed(batches):
        from pyspark import TaskContext

        range_, end = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            ends = end + np.cumsum(n)
            end = int(ends[-1]) if len(ends) else end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(n), range_)), pa.array(ends - n)], names=["doc_id", "n", "ids", "range", "before"])

    rows = tokens.filter("n is not null").mapInArrow(keyed, "doc_id long, n long, ids binary, " + ", ".join(f"{k} int" for k in names))
    # kept, because the bounds of the ranges are drawn from the rows before these are moved
    rows = scratch.keep(rows.withColumns({"crc": F.crc32("ids"), "row": F.monotonically_increasing_id()}), "zstd")
    scratch.drop(tokens)
    by = [*names, "crc", "n", "doc_id", "row"]
    ordered = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "n", "ids")
    ordered = scratch.keep(ordered.mapInArrow(placed, "doc_id long, n long, ids binary, range long, before long"), "zstd")
    scratch.drop(rows)
    first, starts = 0, []
    for r in ordered.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():  # a row per partition
        starts.append((r["range"], first))
        first += r["n"]
    starts = ordered.sparkSession.createDataFrame(starts, "range long, first long")
    at = F.col("first") + F.col("before")
    return ordered.join(F.broadcast(starts), "range").select("doc_id", "n", "ids", at.alias("at"), F.floor(at / shard).cast("long").alias("shard"))


PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _filled(corpus: Statistics, window: int, last: bool, with_ids: bool, kind: np.dtype):
    """Function of Arrow batches of ``doc_id, start, doc_tokens, ids, shard``, ordered by shard, to pieces.

    If it is not the last time, what is left of a shard comes back with its ids in ``left``, a null
    ``sequence_id`` and its number as ``offset``; else it is cut into powers of two.
    """
    names = [c.split()[0] for c in PACKED.split(", ")] + ["ids"] * with_ids + ["left"]
    types = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids + [pa.binary()]

    def filled(number: int, held: list[Piece]):
        # sequences of both times are told apart by one bit
        out, left, sequence = [], [], number << 33 | last << 32

        def put(pieces):
            nonlocal sequence
            offset = 0
            for p in pieces:
                row = (p.doc, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, sequence, offset)
                out.append((*row, p.ids.astype(np.int32), None) if with_ids else (*row, None))
                offset += len(p.ids)
            sequence += 1

        for full, pieces in fill_windows(held, corpus, window):
            if full:
                put(pieces)
            else:
                left += pieces
        if last:
            for pieces in powers_of_two(left):
                put(pieces)
        else:
            none = [None] * with_ids
            out += [(p.doc, p.start, len(p.ids), None, p.total, None, i, *none, p.ids.astype(kind).tobytes()) for i, p in enumerate(left)]
        shard = pa.array(np.full(len(out), number))
        return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], shard], names=[*names, "shard"])

    def fill(batches):
        now, held = None, []
        for part in sliced(batches):
            doc, start, total, ids, shard = part.columns
            for d, a, n, x, number in zip(*(c.to_pylist() for c in (doc, start, total)), ids, shard.to_pylist(), strict=True):
                if number != now and held:
                    yield filled(now, held)
                    held = []
                now = number
                held.append(Piece(d, np.frombuffer(x.as_py(), dtype=kind), a, n))
        if held:
            yield filled(now, held)

    return fill


def pack(docs: DataFrame, window: int = WINDOW, shard: int = SHARD, with_ids: bool = True, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: see PACKED, and ``ids`` if asked for; ``offset`` is its place in its sequence.

    Every token of every row lies in one piece. A null text is an empty document of one token, the id
    that ends it. Rows may repeat; their pieces are told apart by their sequences only. Sequence ids are
    made of shard and number, ids of the documents may be null, and other columns are not read. A task
    holds one shard, and one document more. The same rows give the same result in whatever partitions.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    tokens = scratch.keep(tokenized(docs, tokenizer), "zstd")
    corpus = corpus_statistics(tokens, window, tokenizer)
    columns = PACKED.split(", ") + ["ids array<int>"] * with_ids
    names = [c.split()[0] for c in columns]
    schema = ", ".join([*columns, "left binary", "shard long"])

    def packed(rows: DataFrame, order: str, last: bool) -> DataFrame:
        rows = rows.repartition("shard").sortWithinPartitions("shard", order).select("doc_id", "start", "doc_tokens", "ids", "shard")
        return rows.mapInArrow(_filled(corpus, window, last, with_ids, id_type(tokenizer)), schema)

    rows = in_shards(tokens, corpus, scratch, shard, tokenizer).select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n").alias("doc_tokens"), "ids", "shard", "at")
    first = scratch.keep(packed(rows, "at", last=False))
    left = first.filter("sequence_id is null").select("doc_id", "start", "doc_tokens", F.col("left").alias("ids"), F.floor(F.col("shard") / SHARDS_LEFT).alias("shard"), F.struct("shard", "offset").alias("at"))
    return first.filter("sequence_id is not null").select(*names).unionAll(packed(left, "at", last=True).select(*names))


@query()
def op4_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), with_ids=False)
