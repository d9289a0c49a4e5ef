"""Packing: an exact round trip, ids as the tokenizers library gives them, and BM25 by brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuslens.llm.packing import B, K1, Index, Statistics, pack


def own_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, texts, window):
    """Rows of pack() for documents 0, 1, ... with these texts."""
    ids = own_ids(texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids == part and r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    assert set(by_doc) == set(range(len(texts)))
    for doc, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[doc])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert window is None or at == window or (at < window and at & (at - 1) == 0)


@pytest.mark.parametrize(("window", "shard", "parts"), [(2048, 1 << 20, 1), (64, 2000, 3), (16, 100, 2)])
def test_round_trip(spark, window, shard, parts):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(120).collect()]
    texts += [None, "", " ", "a<|endoftext|>b", "x" * 50_000, "\n" * 3000, "é" * 9, "don't 123   ok"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, offset int").repartition(parts)
    rows = pack(df, window, shard).collect()
    check(rows, texts, window)
    total = sum(r.length for r in rows)
    full = Counter(r.sequence_id for r in rows for _ in range(1))
    assert len(full) <= total // window + 12 * parts


def test_ids_and_repeats(spark):
    rows = pack(spark.createDataFrame([(None, "a b"), (7, "a b"), (7, "a b")], "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0) == Counter({(None, 3): 1, (7, 3): 2})
    assert sum(r.length for r in rows) == 9
    assert pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_neighbours_share_the_window(spark):
    texts = []
    for i in range(40):
        topic = ["apple pear plum cherry grape", "engine wheel brake gear piston", "river lake sea pond creek", "red blue green pink grey"][i % 4]
        texts.append(" ".join(topic.split()[(i + k) % 5] for k in range(20)) + f" filler{i}")
    rows = pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), window=128).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r.doc_id % 4)
    assert sum(len(set(s)) == 1 for s in sequences.values()) > len(sequences) / 2


def test_scores_follow_bm25():
    rng = np.random.default_rng(2)
    pieces = [rng.choice(60, size=rng.integers(1, 40), p=np.arange(60, 0, -1) / 1830).astype(np.uint32) for _ in range(50)]
    mean = np.mean([len(p) for p in pieces])
    df = Counter(t for p in pieces for t in set(p.tolist()))
    index = Index(pieces, Statistics.of(np.array([df[t] for t in range(60)]), 50, mean))
    for seed in pieces[:10]:
        score = []
        for p in pieces:
            s = 0.0
            for t in set(seed.tolist()):
                tf = p.tolist().count(t)
                s += max(0.0, math.log((50 - df[t] + 0.5) / (df[t] + 0.5))) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(p) / mean))
            score.append(s)
        got = index.neighbours(seed).tolist()
        assert sorted(got) == [i for i, s in enumerate(score) if s > 0]
        assert [round(score[i], 9) for i in got] == sorted((round(score[i], 9) for i in got), reverse=True)


def some_texts(spark, n):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(n).collect()]


def test_windows_do_not_depend_on_partitions(spark):
    rows = [(i, t) for i, t in enumerate(some_texts(spark, 100))] + [(7, "a b c")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, eight = (sorted(tuple(r)[:-1] for r in pack(x, 256, 5000).collect()) for x in (df.coalesce(1), df.repartition(8)))
    assert one == eight and len({r[5] >> 33 for r in one}) > 3
    assert sum(n < 256 for n in Counter(r[5] for r in one for _ in range(r[2])).values()) <= 8


def test_windows_take_the_best_unused_neighbours_of_the_corpus(spark):
    """Plain greedy packing with BM25 in Python; one shard, documents from eight partitions."""
    window, texts = 200, [t[:600] for t in some_texts(spark, 90)]
    ids = own_ids(texts)
    n, df = len(ids), Counter(t for x in ids for t in set(x))
    rest = [len(x) % window for x in ids]
    mean = sum(rest) / sum(r > 0 for r in rest)
    idf = {t: max(0.0, math.log((n - c + 0.5) / (c + 0.5))) for t, c in df.items()}

    def weight(t, x):
        tf = x.count(t)
        return idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(x) / mean))

    def place(i):
        heaviest = [t for _, t in sorted((-weight(t, ids[i]), t) for t in set(ids[i]) if idf[t] > 0)[:3]]
        return heaviest + [-1] * (3 - len(heaviest)), zlib.crc32(np.array(ids[i], dtype="<u2").tobytes()), len(ids[i]), i

    left = [(i, len(ids[i]) - rest[i], ids[i][len(ids[i]) - rest[i] :]) for i in sorted(range(n), key=place) if rest[i]]
    indexed = [x for _, _, x in left]
    wanted = []
    while any(p is not None for p in left):
        at = next(k for k, p in enumerate(left) if p is not None)
        (doc, start, seed), left[at] = left[at], None
        filled, room = [(doc, start, len(seed))], window - len(seed)
        score = [round(sum(weight(t, x) for t in set(seed)), 9) if set(seed) & set(x) else 0 for x in indexed]
        for k in [*sorted((k for k in range(len(left)) if score[k]), key=lambda k: -score[k]), *range(at, len(left))]:
            if room and left[k] is not None:
                doc, start, x = left[k]
                take = min(room, len(x))
                filled.append((doc, start, take))
                left[k] = (doc, start + take, x[take:]) if take < len(x) else None
                room -= take
        if not room:
            wanted.append(filled)
    found = defaultdict(list)
    for r in sorted(pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8), window).collect(), key=lambda r: r.offset):
        found[r.sequence_id].append((r.doc_id, r.start, r.length))
    shared = [w for w in found.values() if len(w) > 1 and sum(x[2] for x in w) == window]
    assert len(wanted) > 20 and sorted(w for w in wanted if len(w) > 1) == sorted(shared)
