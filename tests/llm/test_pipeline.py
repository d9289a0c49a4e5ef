"""The pipeline, stage by stage on what the one before kept, against brute force."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from corpuslens.llm.common import Scratch
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_packing import check as check_packed
from tests.llm.test_shingle_join import grams
from tests.llm.test_mixing import WORD, targets

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def near_groups(rows, num, den, k):
    sets = [grams(r[1], k) for r in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num and den * len(a & b) >= num * len(a | b):
                up[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r)
    return groups.values()


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    outs = [sorted(map(tuple, docs.select(COLUMNS).collect()))]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        assert k == 4 or out.columns == COLUMNS
        out.write.parquet(f"file://{tmp_path}/{k}")
        docs = spark.read.parquet(f"file://{tmp_path}/{k}")
        outs.append(sorted(map(tuple, docs.collect())) if k < 4 else docs.collect())
    raw, good, cut, single, mixed, packed = outs

    assert set(good) <= set(raw)
    kept = {r[0] for r in good}
    assert sum(labels[d] for d in labels if d in kept) >= 0.98 * sum(labels.values())
    assert sum(d in kept for d in labels if not labels[d]) <= 0.1 * sum(not x for x in labels.values())

    lines = {r[0]: r[1] for r in brute_lines([(r[0], r[1]) for r in good], 10, 1)}
    assert {r[0]: r[1] for r in cut} == lines and all(r[4] == len(r[1]) for r in cut)
    assert [(r[0], *r[2:4]) for r in cut] == [(r[0], *r[2:4]) for r in good]

    one = []
    for g in near_groups(cut, 8, 10, 5):
        one += [min(g)] if grams(g[0][1]) else g
    assert single == sorted(one)

    copies, words = Counter(mixed), lambda r: len(WORD.findall(r[1]))
    assert set(copies) <= set(single) and max(copies.values()) <= 2
    sizes = Counter()
    for r in single:
        sizes[r[3]] += words(r)
    for s, t in targets(sizes).items():
        assert abs(sum(n * words(r) for r, n in copies.items() if r[3] == s) - t) <= max(words(r) for r in single if r[3] == s)

    # repeats share an id, so pieces are told apart by the document they spell
    texts = [r[1] for r in mixed]
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}[r[0]] for r in mixed)
    once = {r[0]: i for i, r in enumerate(mixed) if copies[r] == 1}
    pieces = [r for r in packed if r.doc_id in once]
    assert {r.doc_id for r in pieces} == set(once)
    ids = sorted(once)
    by_place = {d: i for i, d in enumerate(ids)}

    class Row:
        def __init__(self, r):
            self.__dict__.update(r.asDict(), doc_id=by_place[r.doc_id])

    starts = Counter((r.doc_id, r.start) for r in pieces)
    assert max(starts.values()) == 1
    check_documents([Row(r) for r in pieces], [texts[once[d]] for d in ids])


def check_documents(rows, texts):
    """As in the test of packing, but for the sequences, which hold other documents too."""
    alone = [r for r in rows]
    for n, r in enumerate(alone):
        r.sequence_id, r.offset = n, 0
    check_packed(alone, texts, window=None)


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "sequence_id", "ids"} <= set(out.columns) and out.count() > 0


def test_extra_columns_of_the_names_of_results_come_through(spark):
    folder, names = "/root/testdata/sf0.001", ["kept", "n_lines", "n_dropped", "p_text", "p_meta", "score", "size", "group", "mark", "component_id", "n_shingles", "taken", "target"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("*", *[F.col("doc_id").alias(c) for c in names])
    plain = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs, plain = (scratch_copy(spark, stage(spark, d, folder)) for d in (docs, plain))
        assert docs.columns == COLUMNS + names
        rows = docs.collect()
        assert all(r[c] == r["doc_id"] for r in rows for c in names)
        assert sorted(r[:5] for r in rows) == sorted(map(tuple, plain.collect()))


def scratch_copy(spark, df):
    return Scratch(spark, "copy").keep(df)
