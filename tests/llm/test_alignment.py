"""Cross-tokenizer alignment against brute force with the tokenizers and sentencepiece libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpuslens.llm.alignment import Aligned, Vocabularies, align_tokens, merge_counts, op11_token_alignment, pack, pack_sorted, unpack, unpack_sorted

FIGURES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_values():
    """The characters of byte-level tokens: printable bytes stand for themselves, others follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}


BYTES = byte_values()


def tokens(text):
    a = A.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(BYTES[c] for c in t) for t in a.tokens]
    b = B.encode(text)
    pieces = [B.id_to_piece(i) for i in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    return a.ids, a_bytes, b, b_bytes


def brute(rows):
    made = []
    for doc, text in rows:
        a, a_bytes, b, b_bytes = tokens(text) if text else ([], [], [], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            made.append((doc, 0, 0, 0, [], ""))
            continue
        ranges = [np.cumsum([0] + [len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        links, j = [], 0
        for i in range(len(a)):
            while ranges[1][j + 1] <= ranges[0][i]:
                j += 1
            k = j
            while k < len(b) and ranges[1][k] < ranges[0][i + 1]:
                links.append((a[i], b[k]))
                k += 1
        ends = sorted(set(ranges[0][1:]) & set(ranges[1][1:]))
        groups, x, y = [], 0, 0
        for e in ends:
            x2, y2 = ranges[0].index(e), ranges[1].index(e)
            groups.append(",".join(map(str, a[x:x2])) + "|" + ",".join(map(str, b[y:y2])))
            x, y = x2, y2
        made.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(link for m in made for link in m[4])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    figures = [(doc, n_a, n_b, n_g, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), h) for doc, n_a, n_b, n_g, links, h in made]
    return sorted(figures, key=str), sorted((a, b, n, n == most[b]) for (a, b), n in count.items())


def check(spark, rows, partitions=3, **options):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_a int, run string").repartition(partitions)
    figures, pairs = align_tokens(docs, **options)
    want, want_pairs = brute(rows)
    assert sorted(map(tuple, figures.select(*FIGURES).collect()), key=str) == want
    assert sorted(map(tuple, pairs.collect())) == want_pairs


ODD = [
    "a  b ", " a", " ", "\n", "\n\n", "a\n  b\n", "x\n\n  y", "ﬁ ① ´x", "é", "a b", "a\x00b", "<s> </s> <unk> <0x41>", "▁a", "a▁ b", "a\tb\r\n c", "<|endoftext|> x<|endoftext|>",
    "it's John's we'll 3.14, x.y;z !? ..., ,a", "² ².5 x².", "日本語 テキスト, 한글.", "😀 👩‍👩‍👧 é", " a   b\x1c c", "word　.", "A" * 3000, "ab " * 5000, "é," * 700, " " * 200 + "x" + "\n" * 100, "..\n.. a", "l'été, où; ça!", "ß. ẞ: Ā, x",
]


def test_odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, ""), (None, "no id"), (5, "again"), (5, "again"), (6, "a\n  b\n")]
    check(spark, rows)


def test_random_texts_in_small_runs(spark):
    rng = random.Random(3)
    parts = ["the", "of", "cat's", "Ünder", "x", ",", ".", " ", "  ", "\n", "1.5", "don't", "▁", "\t", "日本", "!", "naïve", "re-do", "(a)", " ", "…"]
    rows = [(i, "".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(rng.randrange(60)))) for i in range(300)]
    check(spark, rows, run_links=50, radix=5)
    check(spark, rows, partitions=1, run_links=10**9)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = op11_token_alignment(spark, folder).select(*FIGURES).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)[0]


def test_empty_tables(spark):
    check(spark, [])
    check(spark, [(1, None), (2, ""), (3, "▁")])


def test_segments_make_the_same_tokens_as_whole_texts():
    v = Vocabularies(None, None, 32)
    assert v.cuts
    aligned, whole = Aligned(v), Aligned(v)
    for text in ODD:
        found = whole.align(" " + text)
        assert aligned.document(text) == (None if found is None else aligned.document(text))
        if found is not None:
            n_a, n_b, n_groups, groups, links = aligned.document(text)
            assert (groups, links) == found[1:]
    learned = Aligned(v)
    learned.learn(ODD, at_once=5)
    known = dict(learned)
    assert len(known) > 30 and all(known[x] == whole.align(x) for x in known)
    for text in ODD:
        assert learned.document(text) == aligned.document(text)


def test_memory_of_segments_is_bounded():
    v = Vocabularies(None, None, 32)
    small = Aligned(v, memory=1 << 19)
    for i in range(2000):
        small.document(f"word{i} and the")
        assert small.size <= 1 << 19
    assert small.before and small.document("word1 and the") == Aligned(v).document("word1 and the")


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_merge_adds_up_equal_pairs(block):
    rng = np.random.default_rng(block)
    runs = [(np.unique(rng.integers(0, 80, rng.integers(0, 50))), None) for _ in range(9)]
    runs = [(p, rng.integers(1, 9, len(p))) for p, _ in runs]
    total = Counter()
    for p, c in runs:
        total.update(dict(zip(p.tolist(), c.tolist())))
    merged = list(merge_counts(runs, block))
    pairs, counts = np.concatenate([m[0] for m in merged]), np.concatenate([m[1] for m in merged])
    assert pairs.tolist() == sorted(total) and counts.tolist() == [total[x] for x in sorted(total)]


def test_packed_numbers_come_back():
    for values in ([], [0], [255, 256], [0, 0, 70_000, 1 << 60], list(range(1000))):
        x = np.array(values, dtype=np.int64)
        assert unpack(pack(x)).tolist() == values
        assert unpack_sorted(pack_sorted(np.sort(x))).tolist() == sorted(values)
