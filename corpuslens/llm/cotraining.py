"""Quality of documents by co-training on their text and on their metadata.

Two linear classifiers see different sides of a document: one its words and signs, one its source,
language and length. Both are fitted on a bounded sample of the labelled documents. In every round they
score all documents, each hands the unlabelled ones it is surest of to the other as pseudo-labels, and
both are fitted again. In the end their outputs, calibrated on labelled documents kept aside, are
combined for every document: given the class, the views are taken as independent.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpuslens.llm.common import ROWS, Remembered, Scratch, read, sliced
from corpuslens.llm.registry import query

#: Labelled documents that the classifiers are fitted and calibrated on, at most.
LABELLED = 6_000
ROUNDS = 2
#: Pseudo-labels that a view hands over in a round, of each class at most (and a tenth of the labelled
#: documents at most), and how sure it must be: so probable, and so often right on documents kept aside.
EXCHANGED, SURE = 200, 0.95
#: Documents are kept from this probability of good quality on.
THRESHOLD = 0.5

WORD_BUCKETS, SHAPE_BUCKETS, META_BUCKETS = 2048, 512, 1024
_UPPER, _DIGITS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", bytes(x for x in range(33, 127) if not chr(x).isalnum() and chr(x) not in ".,;:'-")


def _shape(word: bytes) -> int:
    """Bucket of a word's form: all upper case, ends with a sign, length class."""
    last = word[-1]
    sign = 0 if last >= 128 or chr(last).isalnum() else last
    return (word.isupper() << 8 | sign << 1 | (len(word) > 30)) % SHAPE_BUCKETS


def _word(word: bytes) -> int:
    return zlib.crc32(word) % WORD_BUCKETS


def _dense(data: bytes, words: list[bytes]) -> list[float]:
    n, size = max(1, len(words)), max(1, len(data))
    share = lambda chars: (size - len(data.translate(None, chars))) / size if data else 0.0
    return [
        1.0,
        np.log1p(n),
        size / n / 10,
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        share(_UPPER),
        share(_DIGITS),
        share(_SIGNS),
        (data.count(b"\n") + 1) / n,
    ]


N_DENSE = 9


def text_features(text: str | None) -> np.ndarray:
    """Shares of word and shape buckets, and a few numbers on the whole text."""
    data = (text or "").encode()
    words = data.split()
    out = np.zeros(WORD_BUCKETS + SHAPE_BUCKETS + N_DENSE, dtype=np.float32)
    if words:
        out[:WORD_BUCKETS] = np.bincount([_word(w) for w in words], minlength=WORD_BUCKETS) / len(words)
        out[WORD_BUCKETS:-N_DENSE] = np.bincount([_shape(w) for w in words], minlength=SHAPE_BUCKETS) / len(words)
    out[-N_DENSE:] = _dense(data, words)
    return out


def meta_buckets(source, lang, n_chars) -> list[int]:
    """Buckets of the metadata: source, language, order of length, and the constant."""
    length = int(np.log2(max(0, n_chars) + 1)) if n_chars is not None and n_chars == n_chars else -1
    return [zlib.crc32(repr(x).encode()) % (META_BUCKETS - 1) + 1 for x in (("source", source), ("lang", lang), ("length", length))] + [0]


def meta_features(source, lang, n_chars) -> np.ndarray:
    out = np.zeros(META_BUCKETS, dtype=np.float32)
    for b in meta_buckets(source, lang, n_chars):
        out[b] += 1
    return out


#: How much columns may weigh beside each other: the many word buckets little, form and numbers more.
TEXT_SCALE = np.concatenate([np.full(WORD_BUCKETS, 0.03), np.full(SHAPE_BUCKETS, 0.3), np.full(N_DENSE, 1.0)])
META_SCALE = np.ones(META_BUCKETS)


def _spread(x: np.ndarray, rows: int = 512) -> np.ndarray:
    """Standard deviations of the columns, in blocks of rows."""
    mean = sum((x[i : i + rows].sum(axis=0, dtype=np.float64) for i in range(0, len(x), rows)), np.zeros(x.shape[1])) / max(1, len(x))
    return np.sqrt(sum((((x[i : i + rows] - mean) ** 2).sum(axis=0) for i in range(0, len(x), rows)), np.zeros(x.shape[1])) / max(1, len(x)))


def fit_logistic(x: np.ndarray, y: np.ndarray, relative: np.ndarray, steps: int = 400, l2: float = 1e-3, overwrite: bool = False) -> np.ndarray:
    """Weights of a regularised logistic regression on columns of equal spread times ``relative``, by accelerated gradient steps.

    With ``overwrite`` the columns are scaled in place, without a second copy.
    """
    spread = _spread(x)
    scale = (relative / np.where(spread > 0, np.maximum(spread, 1e-3), 1.0)).astype(np.float32)
    z = np.multiply(x, scale, out=x if overwrite else None)
    # the largest curvature, by power iteration
    v = np.ones(z.shape[1], dtype=np.float32)
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= max(1e-12, np.linalg.norm(v))
    step = 1 / (0.25 * float(np.linalg.norm(z @ v)) ** 2 / len(y) * 1.1 + l2)
    w = ahead = np.zeros(z.shape[1], dtype=np.float32)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        new = ahead - step * (z.T @ (p - y).astype(np.float32) / len(y) + l2 * ahead)
        ahead = new + (k / (k + 3)) * (new - w)
        w = new
    return w.astype(np.float64) * scale


def fit_calibration(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a logistic curve through the outputs, by damped Newton steps."""
    unit = max(1e-9, float(np.std(logit)))
    x = np.stack([logit / unit, np.ones(len(logit))], axis=1)
    # labels drawn in a little, so that separable outputs have a finite curve
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(w):
        z = x @ w
        return float((np.logaddexp(0, z) - t * z).sum() + 5e-4 * w @ w)

    w, damping = np.zeros(2), 1e-3
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (p - t) + 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + (1e-3 + damping) * np.eye(2)
        new = w - np.linalg.solve(hessian, gradient)
        if loss(new) < loss(w):
            w, damping = new, damping / 3
        else:
            damping = damping * 10 + 1e-3
    return max(0.0, float(w[0])) / unit, float(w[1])


@dataclass
class Model:
    """Both views with their calibration; ``prior`` is the log-odds of good quality."""

    text: np.ndarray
    meta: np.ndarray
    text_curve: tuple[float, float]
    meta_curve: tuple[float, float]
    prior: float

    def scorer(self):
        """A function of lists of texts, sources, languages and lengths to an array (rows, 3) of probabilities."""
        words, shapes, dense = self.text[:WORD_BUCKETS], self.text[WORD_BUCKETS:-N_DENSE], self.text[-N_DENSE:]

        weights, rest = Remembered(lambda word: float(words[_word(word)] + shapes[_shape(word)])), {}

        def text_logit(text):
            data = (text or "").encode()
            w = data.split()
            return sum(map(weights.__getitem__, w)) / max(1, len(w)) + float(dense @ _dense(data, w)), bool(w)

        def meta_logit(*key):
            if key not in rest:
                if len(rest) > 20_000:
                    rest.clear()
                rest[key] = float(sum(self.meta[b] for b in meta_buckets(*key)))
            return rest[key]

        def score(texts, sources, langs, lengths):
            t = [text_logit(x) for x in texts]
            a = self.text_curve[0] * np.array([x[0] for x in t]) + self.text_curve[1]
            b = self.meta_curve[0] * np.array([meta_logit(*x) for x in zip(sources, langs, lengths, strict=True)]) + self.meta_curve[1]
            both = np.stack([a, b, a + b - self.prior], axis=1) if len(t) else np.zeros((0, 3))
            p = 1 / (1 + np.exp(-np.clip(both, -30, 30)))
            p[[i for i, x in enumerate(t) if not x[1]], 2] = 0.0
            return np.round(p, 9)

        return score


SCORES = T.StructType([T.StructField(c, T.DoubleType()) for c in ("p_text", "p_meta", "score")])


def scored(docs: DataFrame, model: Model, name: str = "scores") -> DataFrame:
    """The documents with a struct of both views' probabilities and the combined one."""

    @F.arrow_udf(SCORES)
    def probabilities(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        score = model.scorer()
        for columns in batches:
            parts = [np.zeros((0, 3)), *(score(*(c.slice(i, ROWS).to_pylist() for c in columns)) for i in range(0, len(columns[0]), ROWS))]
            found = np.concatenate(parts)
            yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], names=SCORES.names)
            pa.default_memory_pool().release_unused()

    return docs.withColumn(name, probabilities("text", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long")))


@dataclass
class Sparse:
    """Rows of numbers that are mostly zero: bytes of the places (uint16) and values (float32) of the others, row by row."""

    rows: list[tuple[bytes, bytes]]
    width: int

    @staticmethod
    def row(x: np.ndarray) -> tuple[bytes, bytes]:
        places = np.flatnonzero(x)
        return places.astype(np.uint16).tobytes(), x[places].astype(np.float32).tobytes()

    def fill(self, out: np.ndarray, start: int = 0) -> np.ndarray:
        """The rows from ``start`` on, as many as ``out`` has, written into zeros."""
        for i, (places, values) in enumerate(self.rows[start : start + len(out)]):
            out[i, np.frombuffer(places, np.uint16)] = np.frombuffer(values, np.float32)
        return out

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        blocks = (self.fill(np.zeros((min(512, len(self.rows) - i), self.width), np.float32), i) @ w for i in range(0, len(self.rows), 512))
        return np.concatenate([np.zeros(0), *blocks])


@dataclass
class Examples:
    """Documents with their labels, as numbers other than zero only: the driver holds no texts."""

    doc_id: np.ndarray
    y: np.ndarray
    t: Sparse
    m: Sparse

    def __len__(self) -> int:
        return len(self.y)

    def where(self, chosen: np.ndarray) -> Examples:
        t, m = (Sparse([side.rows[i] for i in np.flatnonzero(chosen).tolist()], side.width) for side in (self.t, self.m))
        return Examples(self.doc_id[chosen], self.y[chosen], t, m)


def _features(docs: DataFrame, ids: DataFrame) -> Examples:
    """Features of the documents named by a bounded table ``ids (doc_id, y)``, in the order of ids, each id once."""
    sides = ("t_at", "t", "m_at", "m")

    def describe(batches):
        for part in sliced(batches):
            c = dict(zip(part.schema.names, part.columns, strict=True))
            text = [Sparse.row(text_features(x)) for x in c["text"].to_pylist()]
            meta = [Sparse.row(meta_features(*x)) for x in zip(*(c[k].to_pylist() for k in ("source", "lang", "n_chars")), strict=True)]
            found = [pa.array([row[k] for row in side], pa.binary()) for side in (text, meta) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([c["doc_id"], c["y"], *found], names=["doc_id", "y", *sides])

    kinds = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long"}
    rows = docs.select("text", *[F.col(c).cast(kind).alias(c) for c, kind in kinds.items()]).join(F.broadcast(ids.select("doc_id", "y")), "doc_id")
    table = rows.mapInArrow(describe, "doc_id long, y int, " + ", ".join(f"{c} binary" for c in sides)).toArrow()
    id_, y = (table[c].to_numpy() for c in ("doc_id", "y"))
    first = np.unique(id_, return_index=True)[1]
    t_at, t, m_at, m = (table[c].take(pa.array(first)).to_pylist() for c in sides)
    return Examples(id_[first], y[first].astype(np.float64), Sparse(list(zip(t_at, t, strict=True)), len(TEXT_SCALE)), Sparse(list(zip(m_at, m, strict=True)), META_BUCKETS))


def _fitted(fit: Examples, aside: Examples, for_text: list[Examples], for_meta: list[Examples]) -> Model:
    prior = float(np.log((fit.y.sum() + 1) / (len(fit) - fit.y.sum() + 1)))
    weights, curves = [], []
    for side, more, relative in (("t", for_text, TEXT_SCALE), ("m", for_meta, META_SCALE)):
        parts = [fit, *more]
        x, at = np.zeros((sum(map(len, parts)), len(relative)), dtype=np.float32), 0  # one view at a time, to be scaled
        for p in parts:
            getattr(p, side).fill(x[at : at + len(p)])
            at += len(p)
        w = fit_logistic(x, np.concatenate([p.y for p in parts]), relative, overwrite=True)
        del x
        weights.append(w)
        curves.append(fit_calibration(getattr(aside, side) @ w, aside.y))
    return Model(*weights, *curves, prior)


def _is_right(model: Model, aside: Examples, view: str, y: int, sure: float) -> bool:
    """Whether the view's sure judgements for class ``y`` hold on the documents kept aside."""
    w, (slope, offset), column = (model.text, model.text_curve, "t") if view == "p_text" else (model.meta, model.meta_curve, "m")
    p = 1 / (1 + np.exp(-np.clip(slope * (getattr(aside, column) @ w) + offset, -30, 30)))
    chosen = aside.y[(p if y else 1 - p) >= sure]
    return len(chosen) >= 5 and (chosen == y).mean() >= sure


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, rounds: int = ROUNDS, exchanged: int = EXCHANGED, sure: float = SURE) -> Model | None:
    """Co-trained model; None if the labelled documents found are not of both classes.

    Labels other than 0 and 1 and null ids are left out, and a document labelled twice counts with its
    smaller label. A quarter of the labelled documents, by hash, is kept aside for calibration.
    """
    scratch = Scratch(docs.sparkSession, "cotraining")
    y = F.col(label).cast("int")
    known = labels.filter(F.col("doc_id").isNotNull() & y.isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(y).alias("y"))
    known = scratch.keep(known)
    sample = scratch.keep(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled))
    rows = _features(docs, sample)
    is_aside = np.array([zlib.crc32(str(x).encode()) % 4 == 0 for x in rows.doc_id], dtype=bool)
    fit, aside = rows.where(~is_aside), rows.where(is_aside)
    if len(set(fit.y)) < 2 or len(set(aside.y)) < 2:
        return None
    for_text: list[Examples] = []
    for_meta: list[Examples] = []
    model = _fitted(fit, aside, for_text, for_meta)
    used: list[int] = []
    for _ in range(rounds):
        p = scored(docs.filter("doc_id is not null"), model, "p").select(F.col("doc_id").cast("long").alias("doc_id"), "p.*")
        new = scratch.keep(p.join(known, "doc_id", "left_anti"))
        given = []
        for view, parts in (("p_text", for_meta), ("p_meta", for_text)):
            for y_, confidence in ((1, F.col(view)), (0, 1 - F.col(view))):
                if not _is_right(model, aside, view, y_, sure):
                    continue
                surest = new.withColumn("c", confidence).filter(F.col("c") >= sure).filter(~F.col("doc_id").isin(used))
                surest = surest.orderBy(F.desc("c"), F.xxhash64("doc_id"), "doc_id").limit(min(exchanged, len(fit) // 10))
                given.append((parts, scratch.keep(surest.select("doc_id", F.lit(y_).alias("y")))))
        for parts, ids in given:
            more = _features(docs, ids)
            if len(more):
                parts.append(more)
                used += more.doc_id.tolist()
        model = _fitted(fit, aside, for_text, for_meta)
    return model


def judge_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents with all their columns and ``p_text, p_meta, score, kept``, one row per row.

    Kept are those whose combined probability of good quality is at least ``threshold``. A text without
    words, or null, has score 0. If the labels do not show both classes, all probabilities are null and
    every document is kept. Null metadata is a value like any other. Rows of one id are scored each by
    its own text; result columns replace columns of the same name.
    """
    model = train(docs, labels, **options)
    base = docs.drop("p_text", "p_meta", "score", "kept")
    if model is None:
        nothing = F.lit(None).cast("double")
        return base.withColumns({"p_text": nothing, "p_meta": nothing, "score": nothing, "kept": F.lit(True)})
    out = scored(base, model, "__p")
    return out.select(*[base[c] for c in base.columns], "__p.*", (F.col("__p.score") >= threshold).alias("kept"))


@query()
def op1_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return judge_documents(docs, read(spark, sf_dir, "labels")).select("doc_id", "p_text", "p_meta", "score", "kept")
