"""Linear classifiers fitted side by side: one job per optimiser step for all classes and configurations.

Documents are packed into sparse blocks once. A step sends the weights of all problems that are not done
to the tasks, reads every block once, and brings back one loss and one gradient a problem, summed on the
way. The optimiser, L-BFGS, runs on the driver, as Spark's own does; a problem that is done takes no more
part. Problems differ in data, loss, ``C``, class weights and in a fold that is left out.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from corpuslens.functions.counting import Channel, counted_by_text
from corpuslens.sources.tables import keep_table

SQUARED_HINGE, LOG = "squared_hinge", "log"
#: Documents and stored numbers of a block, at most (a longer document is a block of its own). Rows of a megabyte
#: reach Python faster than large ones.
BLOCK_ROWS, BLOCK_CELLS = 2_000, 100_000
#: Stored numbers that a task takes together: a gradient is as wide as the vocabulary, however small the block.
GATHERED = 1_000_000
#: Features that at least this share of a block's documents have are multiplied as a dense matrix: one product for the
#: weights of all classes and problems costs less there than going from cell to cell. It holds at most 1 / COMMON times the cells.
COMMON = 1 / 16
#: Columns that are still multiplied cell by cell: for fewer than that, making the dense matrix takes longer than it saves.
FEW = 16
#: Tasks a core that blocks are made and read by. Each hands in a gradient a step.
TASKS = 1
#: Numbers in all weights that are fitted at once; each takes 8 bytes, and the optimiser keeps 2 * MEMORY + 4 of them.
MOST_WEIGHTS = 24_000_000
#: Steps that the optimiser remembers.
MEMORY = 6
#: Gradients of so many bytes in all go to the driver as they are; more are summed on the way, so many tasks at a time.
DIRECT, FAN_IN = 64 << 20, 32
#: Numbers of a gradient in one row.
SLICE = 1 << 17


@dataclass(frozen=True)
class Problem:
    """One classifier: ``squared_hinge`` fits every class against the rest, ``log`` all classes together.

    It minimises half the squared weights plus ``C`` times the losses. Intercepts count among the weights
    of the hinge loss, and not among those of the log loss. Balanced class weights multiply the losses of
    a class's documents; with the hinge loss, those of a class in its own problem only.
    """

    data: str
    loss: str
    C: float = 1.0
    balanced: bool = False
    left_out: int | None = None


PACKED = "data string, ids array<string>, y binary, fold binary, ends binary, idx binary, val binary, coded binary"
#: Stored numbers of a block of texts, at most; coded they take one to two bytes each.
CODED_CELLS = 1_000_000


def pack_blocks(
    rows: DataFrame, data: str, features: str = "features", y: str = "y", fold: Column | None = None, id_col: Column | None = None, n_rows: int | None = None
) -> DataFrame:
    """Blocks of documents, see PACKED: ``y`` and ``fold`` as int32, row ends, positions and values of the cells.

    ``features`` are vectors, or structs of their indices and values; ``y`` are class positions; rows without a class are left out. ``fold`` is -1 and
    ids are null where they are not given. With ``n_rows``, their number, the rows are taken together so
    that blocks are full, in TASKS tasks a core at most: tasks of a few rows would be all scheduling, and a
    gradient comes from every task, so their number must not grow with the data.
    """
    if n_rows is not None:
        rows = rows.coalesce(min(n_rows // BLOCK_ROWS + 1, TASKS * rows.sparkSession.sparkContext.defaultParallelism))

    def packed(batches):
        held: list[tuple] = []
        cells = 0

        def flushed():
            ids, ys, folds, idx, val = zip(*held, strict=True)
            ends = np.cumsum([len(i) for i in idx])
            columns = [
                [data], [list(ids)], [np.array(ys, "<i4").tobytes()], [np.array(folds, "<i4").tobytes()], [ends.astype("<i8").tobytes()],
                [np.concatenate(idx).astype("<i4").tobytes()], [np.concatenate(val).astype("<f8").tobytes()], [None],
            ]
            held.clear()
            return _packed_row(columns)

        for batch in batches:
            ids, classes, folds = (c.to_pylist() for c in batch.columns[:3])
            for row_id, cls, k, at, values in zip(ids, classes, folds, *(_arrays(c) for c in batch.columns[3:]), strict=True):
                # a dense vector has values only
                at = np.arange(len(values)) if at is None else at
                held.append((row_id, int(cls), k, at, values))
                cells += len(at)
                if len(held) >= BLOCK_ROWS or cells >= BLOCK_CELLS:
                    yield flushed()
                    cells = 0
        if held:
            yield flushed()

    given = F.lit(None).cast("string") if id_col is None else id_col.cast("string")
    v = F.col(features) if isinstance(rows.schema[features].dataType, StructType) else F.unwrap_udt(F.col(features))
    columns = [given.alias("id"), F.col(y).alias("y"), (F.lit(-1) if fold is None else fold).cast("int").alias("fold"), v["indices"].alias("indices"), v["values"].alias("values")]
    return rows.filter(F.col(y).isNotNull()).select(*columns).mapInArrow(packed, PACKED)


def _packed_row(columns: list) -> pa.RecordBatch:
    types = [pa.string(), pa.list_(pa.string()), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in PACKED.split(", ")])


def pack_texts(rows: DataFrame, data: str, texts: Sequence[Column], channels: Sequence[Channel], size: int, y: str = "y", fold: Column | None = None, id_col: Column | None = None) -> DataFrame:
    """Blocks of documents straight from their texts, one of ``texts`` a channel: the numbers of ``FeatureUnion.vectors``, which are never written out.

    Vocabularies are ``term, idf, idx``. A block keeps positions and frequencies, coded, and makes the weights anew each time it is read.
    """
    counting = [(c.count, c.sublinear) for c in channels]
    sent = rows.sparkSession.sparkContext.broadcast([c.vocabulary for c in channels])

    def packed(batches):
        known = [Channel(c, v, sub) for (c, sub), v in zip(counting, sent.value, strict=True)]
        idf = np.zeros(size)
        for c in known:
            idf[c.vocabulary["idx"].to_numpy()] = c.vocabulary["idf"].to_numpy()
        held: list[tuple] = []
        cells = rows_ = 0

        def flushed():
            ids, ys, folds, counts, norms, idx, tf = zip(*held, strict=True)
            coded = _coded(np.concatenate(counts), np.concatenate(norms), np.concatenate(idx), np.concatenate(tf), idf, [c.sublinear for c in known])
            held.clear()
            flat = [x for part in ids for x in part]
            return _packed_row([[data], [flat], [np.concatenate(ys).astype("<i4").tobytes()], [np.concatenate(folds).astype("<i4").tobytes()], [None], [None], [None], [coded]])

        for batch in batches:
            for ids, classes, folds, counts, norms, idx, tf in counted_by_text(known, batch):
                held.append((ids, np.array(classes), np.array(folds), counts, norms, idx, tf))
                cells, rows_ = cells + len(idx), rows_ + len(ids)
                if rows_ >= BLOCK_ROWS or cells >= CODED_CELLS:
                    yield flushed()
                    cells = rows_ = 0
        if held:
            yield flushed()

    given = F.lit(None).cast("string") if id_col is None else id_col.cast("string")
    rest = [given.alias("id"), F.col(y).cast("int").alias("y"), (F.lit(-1) if fold is None else fold).cast("int").alias("fold")]
    return rows.filter(F.col(y).isNotNull()).select(*[t.alias(f"c{i}") for i, t in enumerate(texts)], *rest).mapInArrow(packed, PACKED)


def _bytes(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes: kind, size, low bytes, next ones."""
    raw = np.ascontiguousarray(values.view("u1").reshape(len(values), values.itemsize).T).tobytes()
    return np.array([values.itemsize, len(values)], "<i8").tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def _numbers(data: memoryview) -> np.ndarray:
    width, n = np.frombuffer(data[:16], "<i8").tolist()
    raw = pa.Codec("zstd").decompress(data[16:], width * n, asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(width, n).T).view(f"<u{width}").ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences that wrap around, in as few bytes as the largest value takes."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return np.diff(values.astype(kind), prepend=kind.type(0))


def _coded(counts: np.ndarray, norms: np.ndarray, idx: np.ndarray, tf: np.ndarray, idf: np.ndarray, sublinear: Sequence[bool]) -> bytes:
    """``counts`` and ``norms``: documents by channels; positions rise within a document. The ``idf`` of the features met go along."""
    met = np.unique(idx)
    floats = [np.array(sublinear, "<f8"), norms.astype("<f8").ravel(), idf[met].astype("<f8")]
    whole = [_steps(idx), tf.astype(np.min_scalar_type(int(tf.max(initial=0)))), _steps(met), counts.ravel().astype("<u4"), *(f.view("<u8") for f in floats)]
    parts = [_bytes(w) for w in whole]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(parts)


def _decoded(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the documents, positions and weights."""
    view, parts = memoryview(data), []
    lengths = np.frombuffer(view[:56], "<i8").tolist()
    at = 56
    for n in lengths:
        parts.append(_numbers(view[at : at + n]))
        at += n
    idx, tf, met, counts = np.cumsum(parts[0], dtype=parts[0].dtype), parts[1], np.cumsum(parts[2], dtype=parts[2].dtype), parts[3]
    sublinear, norms, known = (p.view("<f8") for p in parts[4:])
    if not len(idx):
        return counts.reshape(-1, len(sublinear)).sum(axis=1), idx.astype("<i4"), np.zeros(0)
    idf = np.zeros(int(met[-1]) + 1)
    idf[met] = known
    top = int(tf.max())
    if sublinear.all() and top < 1 << 16:
        x = (np.log(np.arange(1, top + 1)) + 1)[tf - tf.dtype.type(1)]
    else:
        damped = np.repeat(np.tile(sublinear > 0, len(norms) // len(sublinear)), counts)
        x = np.where(damped, np.log(tf.astype(float)) + 1, tf)
    x *= idf[idx]
    x /= np.repeat(norms, counts)
    return counts.reshape(-1, len(sublinear)).sum(axis=1), idx.astype("<i4"), x


def _arrays(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """Each row's list as an array; the cells never become Python values."""
    sizes = pc.fill_null(column.value_lengths(), 0).to_numpy()
    ends, flat = np.cumsum(sizes), column.flatten().to_numpy()
    for start, end, given in zip(ends - sizes, ends, column.is_valid().to_pylist(), strict=True):
        yield flat[start:end] if given else None


class _Block:
    """The arrays of one row of PACKED."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.ids, self.y, self.fold = row["ids"], read("y", "<i4"), read("fold", "<i4")
        if row.get("coded") is not None:
            sizes, self.idx, self.val = _decoded(row["coded"])
            self._measure(sizes.astype(np.int64))
            return
        self.idx, self.val = read("idx", "<i4"), read("val", "<f8")
        self._measure(np.diff(read("ends", "<i8"), prepend=0))

    @classmethod
    def together(cls, blocks: list[_Block]) -> _Block:
        """Several blocks of one data as one, without ids."""
        if len(blocks) == 1:
            return blocks[0]
        out = cls.__new__(cls)
        out.ids = None
        out.y, out.fold, out.idx, out.val = (np.concatenate([getattr(b, name) for b in blocks]) for name in ("y", "fold", "idx", "val"))
        out._measure(np.concatenate([b.sizes for b in blocks]))
        return out

    def _measure(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        # sums over empty rows are none
        self.full = np.flatnonzero(self.sizes)
        self.starts = (np.cumsum(self.sizes) - self.sizes)[self.full]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Documents by classes; ``weights`` are classes by features, the last column the intercepts."""
        out = np.tile(weights[:, -1], (len(self.y), 1))
        if len(self.full):
            for k, w in enumerate(weights):
                out[self.full, k] += np.add.reduceat(self.val * w[self.idx], self.starts)
        return out

    def add_gradient(self, slopes: np.ndarray, total: np.ndarray) -> None:
        """Adds the sum over documents of each column's slope times the document, intercepts last.

        A document that is right by a wide margin has no slope of the hinge loss and costs nothing.
        """
        steep = slopes.any(axis=1)
        cells = np.repeat(steep, self.sizes)
        idx, val, sizes = self.idx[cells], self.val[cells], self.sizes[steep]
        for k, slope in enumerate(np.ascontiguousarray(slopes[steep].T)):
            total[k, :-1] += np.bincount(idx, weights=val * np.repeat(slope, sizes), minlength=total.shape[1] - 1)
            total[k, -1] += slope.sum()


class _Matrix:
    """A block for products with many columns: features that are common in it as a dense matrix, the cells of others one by one."""

    def __init__(self, block: _Block, n_features: int):
        self.n = len(block.y)
        row = np.repeat(np.arange(self.n), block.sizes)
        met = np.bincount(block.idx, minlength=n_features)
        held = met >= max(1.0, COMMON * self.n)
        self.common, self.rare = np.flatnonzero(held), np.flatnonzero((met > 0) & ~held)
        place = np.empty(n_features, dtype=np.int64)
        place[self.common], place[self.rare] = np.arange(len(self.common)), np.arange(len(self.rare))
        inside, at = held[block.idx], place[block.idx]
        self.dense = np.zeros((self.n, len(self.common)))
        self.dense.ravel()[row[inside] * len(self.common) + at[inside]] = block.val[inside]
        self.row, self.at, self.val = row[~inside], at[~inside], block.val[~inside]
        sizes = np.bincount(self.row, minlength=self.n)
        self.full = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.full]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """As those of a block."""
        out = self.dense @ weights[:, self.common].T + weights[:, -1]
        if len(self.full):
            for k, w in enumerate(weights):
                out[self.full, k] += np.add.reduceat(self.val * w[self.rare][self.at], self.starts)
        return out

    def add_gradient(self, slopes: np.ndarray, total: np.ndarray) -> None:
        """As that of a block."""
        steep = slopes.any(axis=1)
        total[:, self.common] += slopes[steep].T @ self.dense[steep]
        total[:, -1] += slopes.sum(axis=0)
        if len(self.full):
            cells = steep[self.row]
            row, at, val = self.row[cells], self.at[cells], self.val[cells]
            for k, slope in enumerate(np.ascontiguousarray(slopes.T)):
                total[k, self.rare] += np.bincount(at, weights=val * slope[row], minlength=len(self.rare))


def _gathered(batches: Iterable[pa.RecordBatch], names: set[str]) -> Iterator[tuple[str, _Block]]:
    """The blocks of the data named, taken together up to GATHERED numbers."""
    held: dict[str, list[_Block]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            name = batch.column("data")[i].as_py()
            if name not in names:
                continue
            mine = held.setdefault(name, [])
            mine.append(_Block({c: batch.column(c)[i].as_py() for c in batch.schema.names} | {"ids": None}))
            if sum(len(b.val) for b in mine) >= GATHERED:
                yield name, _Block.together(held.pop(name))
    for name, mine in held.items():
        yield name, _Block.together(mine)


def losses(problem: Problem, margins: np.ndarray, y: np.ndarray, fold: np.ndarray, class_weights: np.ndarray, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Summed losses by class, and the slopes by document and class; ``classes``: those that the margins are of, all if not given.

    The log loss is one number for all classes, and stands with the first.
    """
    n, k = margins.shape
    use = np.ones(n) if problem.left_out is None else (fold != problem.left_out).astype(float)
    own = (np.arange(k) if classes is None else classes) == y[:, None]
    if problem.loss == SQUARED_HINGE:
        sign = np.where(own, 1.0, -1.0)
        weight = np.where(own, class_weights[y][:, None], 1.0) * use[:, None]
        gap = np.maximum(0.0, 1.0 - sign * margins)
        return problem.C * (weight * gap * gap).sum(axis=0), -2.0 * problem.C * weight * sign * gap
    weight = class_weights[y] * use
    shifted = margins - margins.max(axis=1, keepdims=True)
    total = np.exp(shifted).sum(axis=1)
    share = np.exp(shifted) / total[:, None]
    loss = np.zeros(k)
    loss[0] = problem.C * float((weight * (np.log(total) - shifted[np.arange(n), y])).sum())
    return loss, problem.C * weight[:, None] * (share - own)


#: ``at`` are the places of the numbers in the slice where most of its ``width`` are zero, null where all are given.
GRADIENT = "problem int, slice int, task int, loss double, width int, at binary, part binary"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of FAN_IN tasks' parts, added up as they come: they are neither sorted nor held."""
    total: dict[tuple[int, int, int], list] = {}
    for batch in batches:
        rows = (batch.column(name) for name in ("problem", "slice", "task", "loss", "width"))
        for i, (problem, s, task, loss, width) in enumerate(zip(*(c.to_pylist() for c in rows), strict=True)):
            held = total.setdefault((problem, s, task // FAN_IN), [0.0, np.zeros(width)])
            held[0] += loss
            _add(held[1], batch.column("at")[i].as_buffer(), batch.column("part")[i].as_buffer())
    for (problem, s, task), (loss, part) in total.items():
        yield _part(problem, s, task, loss, part)


def _part(problem: int, s: int, task: int, loss: float, part: np.ndarray) -> pa.RecordBatch:
    """A row of GRADIENT. A task meets few of the terms of a wide vocabulary: only those are sent."""
    at = np.flatnonzero(part).astype("<i4")
    few = 12 * len(at) < 8 * len(part)
    values = (problem, s, task, loss, len(part), at.tobytes() if few else None, (part[at] if few else part).tobytes())
    types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(values, types, strict=True)], names=[c.split()[0] for c in GRADIENT.split(", ")])


def _add(total: np.ndarray, at: pa.Buffer | None, part: pa.Buffer) -> None:
    """Adds a row's numbers to its slice."""
    if at is None:
        total += np.frombuffer(part, "<f8")
    else:
        total[np.frombuffer(at, "<i4")] += np.frombuffer(part, "<f8")


def _evaluate(blocks: DataFrame, n_tasks: int, problems: dict[int, tuple[Problem, np.ndarray, np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Losses and gradients by class of the problems ``number -> (problem, class weights, weights, classes they are of)``, without the penalty."""
    context = blocks.sparkSession.sparkContext
    sent = context.broadcast(problems)
    # a class starts a slice
    width = lambda w: -(-w.shape[1] // SLICE)

    def partial(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        problems = sent.value
        asked: dict[str, list[int]] = {}
        for i, (problem, *_) in problems.items():
            asked.setdefault(problem.data, []).append(i)
        # the classes of all problems of one data are columns of the same products
        stacked: dict[str, np.ndarray] = {}
        total: dict[str, np.ndarray] = {}
        loss = {i: np.zeros(len(w)) for i, (_, _, w, _) in problems.items()}
        for name, block in _gathered(batches, set(asked)):
            if name not in stacked:
                stacked[name] = np.concatenate([problems[i][2] for i in asked[name]])
                total[name] = np.zeros(stacked[name].shape)
            matrix = block if len(stacked[name]) <= FEW else _Matrix(block, stacked[name].shape[1] - 1)
            ends = np.cumsum([len(problems[i][2]) for i in asked[name]])[:-1]
            margins = np.split(matrix.margins(stacked[name]), ends, axis=1)
            slopes = []
            for i, m in zip(asked[name], margins, strict=True):
                problem, class_weights, _, classes = problems[i]
                more, slope = losses(problem, m, block.y, block.fold, class_weights, classes)
                loss[i] += more
                slopes.append(slope)
            matrix.add_gradient(np.concatenate(slopes, axis=1), total[name])
        for name, t in total.items():
            rows = iter(t)
            for i in asked[name]:
                for k, w in enumerate(problems[i][2]):
                    row = next(rows)
                    for s in range(0, len(w), SLICE):
                        yield _part(i, k * width(problems[i][2]) + s // SLICE, task, float(loss[i][k]) if s == 0 else 0.0, row[s : s + SLICE])

    rows, left = blocks.drop("ids").mapInArrow(partial, GRADIENT), n_tasks
    while left > 1 and 8 * left * sum(w.size for _, _, w, _ in problems.values()) > DIRECT:
        rows = rows.repartition(context.defaultParallelism, "problem", "slice", F.floor(F.col("task") / FAN_IN)).mapInArrow(_summed, GRADIENT)
        left = -(-left // FAN_IN)
    out = {i: (np.zeros(len(w)), np.zeros(w.shape)) for i, (_, _, w, _) in problems.items()}
    for batch in rows.toArrow().to_batches():
        heads = (batch.column(name).to_pylist() for name in ("problem", "slice", "loss", "width"))
        for at, (i, s, loss, n) in enumerate(zip(*heads, strict=True)):
            k, s = divmod(s, width(out[i][1]))
            out[i][0][k] += loss
            _add(out[i][1][k, s * SLICE : s * SLICE + n], batch.column("at")[at].as_buffer(), batch.column("part")[at].as_buffer())
    sent.destroy()
    return out


def minimise(x: np.ndarray, tol: float, max_iter: int, memory: int = MEMORY, start: Callable[[], np.ndarray] | None = None) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS as a generator: yields points, is sent loss and gradient there, and returns the minimum.

    It stops when the gradient is ``tol`` times as long as at ``x``, also if it goes on from another ``start``.
    """
    f, g = yield x
    enough = tol * float(np.linalg.norm(g))
    if start is not None:
        x = start()
        f, g = yield x
    past: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=memory)
    for _ in range(max_iter):
        if np.linalg.norm(g) <= enough:
            break
        d, kept = -g, []
        for s, v, sv in reversed(past):
            a = float(s @ d) / sv
            d = d - a * v
            kept.append(a)
        if past:
            s, v, sv = past[-1]
            d *= sv / float(v @ v)
        for (s, v, sv), a in zip(past, reversed(kept), strict=True):
            d += s * (a - float(v @ d) / sv)
        slope = float(g @ d)
        step = 1.0 if past else min(1.0, 1.0 / float(np.linalg.norm(g)))
        for _ in range(40):
            to = x + step * d
            f_to, g_to = yield to
            if f_to <= f + 1e-4 * step * slope + 1e-14 * abs(f):
                break
            # the minimum of the parabola through both losses, kept within a tenth and a half
            step *= min(0.5, max(0.1, -slope * step / (2.0 * (f_to - f - slope * step))))
        else:
            break  # no descent beyond rounding
        s, v = to - x, g_to - g
        sv = float(s @ v)
        if sv > 1e-300:
            past.append((s, v, sv))
        x, f, g = to, f_to, g_to
    return x


def _penalised(problem: Problem, w: np.ndarray, loss: float, gradient: np.ndarray) -> tuple[float, np.ndarray]:
    penalty = w.copy()
    if problem.loss == LOG:
        penalty[:, -1] = 0.0
    return loss + 0.5 * float((penalty * penalty).sum()), (gradient + penalty).ravel()


class _Fit:
    """One problem under way. With the hinge loss its classes share nothing: each has an optimiser of its own and ends by itself."""

    def __init__(self, problem: Problem, n_classes: int, size: int, tol: float, max_iter: int, start: Callable[[], np.ndarray] | None):
        self.problem = problem
        each = [[k] for k in range(n_classes)] if problem.loss == SQUARED_HINGE else [list(range(n_classes))]
        self.weights = np.zeros((n_classes, size + 1))
        begin = lambda own: None if start is None else lambda: start()[own].ravel()
        self.running = [(own, minimise(np.zeros(len(own) * (size + 1)), tol, max_iter, start=begin(own))) for own in each]
        for _, optimiser in self.running:
            next(optimiser)

    def classes(self) -> np.ndarray:
        return np.array([k for own, _ in self.running for k in own])

    def asked(self) -> np.ndarray:
        return self.weights[self.classes()]

    def told(self, losses_: np.ndarray, gradient: np.ndarray) -> None:
        """Moves on from the losses and gradients at what was asked."""
        left, at = [], 0
        for own, optimiser in self.running:
            rows, at = slice(at, at + len(own)), at + len(own)
            try:
                to = optimiser.send(_penalised(self.problem, self.weights[own], float(losses_[rows].sum()), gradient[rows]))
                left.append((own, optimiser))
            except StopIteration as done:
                to = done.value
            self.weights[own] = to.reshape(len(own), -1)
        self.running = left


def _starts(problems: Sequence[Problem]) -> dict[int, int]:
    """Fits without a fold that start from the one of all documents: its minimum is near theirs."""
    whole = {replace(p, left_out=None): i for i, p in enumerate(problems) if p.left_out is None}
    return {i: whole[replace(p, left_out=None)] for i, p in enumerate(problems) if p.left_out is not None and replace(p, left_out=None) in whole}


def fit_together(
    blocks: DataFrame, problems: Sequence[Problem], sizes: dict[str, int], n_classes: int, tol: float = 1e-4, max_iter: int = 1000, most_weights: int = MOST_WEIGHTS
) -> list[np.ndarray]:
    """Weights of each problem, classes by features, the intercepts last; ``sizes``: features of each data.

    ``blocks`` are PACKED rows of all data, and are read once a step: keep them in memory. Problems are
    taken in turns of at most ``most_weights`` numbers; one alone that is larger is refused.
    """
    counts = _class_counts(blocks, n_classes)
    blocks = blocks.coalesce(TASKS * blocks.sparkSession.sparkContext.defaultParallelism)
    # a problem's gradient comes from as many tasks as its data has blocks, at most
    n_tasks = min(blocks.rdd.getNumPartitions(), max((r["count"] for r in blocks.groupBy("data").count().collect()), default=1))
    out: list[np.ndarray | None] = [None] * len(problems)
    starts = _starts(problems)
    todo = deque(sorted(range(len(problems)), key=lambda i: i in starts))
    while todo:
        turn, room = [], most_weights
        while todo and (need := n_classes * (sizes[problems[todo[0]].data] + 1)) <= room:
            room -= need
            turn.append(todo.popleft())
        if not turn:
            raise ValueError(f"more than {most_weights} weights in one classifier: set max_features or a higher min_df")
        start = lambda i: (lambda: out[starts[i]]) if i in starts else None
        running = {i: _Fit(problems[i], n_classes, sizes[problems[i].data], tol, max_iter, start(i)) for i in turn}
        weights = {i: _class_weights(counts[problems[i].data], problems[i], n_classes) for i in turn}
        known: dict[int, tuple] = {}  # what was found for those that wait for their start
        while running:
            asked = {i: (problems[i], weights[i], fit.asked(), fit.classes()) for i, fit in running.items() if i not in known}
            known |= _evaluate(blocks, n_tasks, asked)
            # those that others start from are told first
            for i in turn:
                if i in known and (i not in starts or out[starts[i]] is not None):
                    running[i].told(*known.pop(i))
                    if not running[i].running:
                        out[i] = running.pop(i).weights
    return out


def _class_counts(blocks: DataFrame, n_classes: int) -> dict[str, dict[int, np.ndarray]]:
    """Documents per class of each data and fold; a row of numbers for each."""

    def counted(batches):
        for batch in batches:
            for row in batch.to_pylist():
                y, fold = np.frombuffer(row["y"], "<i4"), np.frombuffer(row["fold"], "<i4")
                folds, at = np.unique(fold, return_inverse=True)
                for k, f in enumerate(folds.tolist()):
                    n = np.bincount(y[at == k], minlength=n_classes).tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([row["data"]] * n_classes), pa.array([f] * n_classes, pa.int32()), pa.array(range(n_classes), pa.int32()), pa.array(n, pa.int64())], names=["data", "fold", "y", "n"])

    rows = blocks.select("data", "y", "fold").mapInArrow(counted, "data string, fold int, y int, n long").groupBy("data", "fold", "y").agg(F.sum("n").alias("n")).collect()
    out: dict[str, dict[int, np.ndarray]] = {}
    for r in rows:
        out.setdefault(r["data"], {}).setdefault(r["fold"], np.zeros(n_classes))[r["y"]] = r["n"]
    return out


def _class_weights(counts: dict[int, np.ndarray], problem: Problem, n_classes: int) -> np.ndarray:
    if not problem.balanced:
        return np.ones(n_classes)
    n = np.sum([c for fold, c in counts.items() if fold != problem.left_out], axis=0)
    seen = n > 0
    return np.where(seen, n.sum() / (seen.sum() * np.where(seen, n, 1.0)), 0.0)


def block_margins(blocks: DataFrame, weights: dict[str, list[np.ndarray]]) -> DataFrame:
    """``data, model, id, y, fold, margins`` of every document under each of its data's weights."""
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    names = ["data", "model", "id", "y", "fold", "margins"]

    def scored(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                n = len(block.y)
                for k, w in enumerate(sent.value.get(row["data"], [])):
                    columns = [pa.array([row["data"]] * n), pa.array([k] * n, pa.int32()), pa.array(block.ids, pa.string()), pa.array(block.y, pa.int32()), pa.array(block.fold, pa.int32()), pa.array(block.margins(w).tolist(), pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.mapInArrow(scored, "data string, model int, id string, y int, fold int, margins array<double>")


def vector_margins(df: DataFrame, weights: np.ndarray, features: str = "features") -> Column:
    """Margins of a vector column: one number per row of ``weights``, whose last column are the intercepts."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def score(vectors: pd.DataFrame) -> pd.Series:
        w = sent.value
        out = []
        for kind, idx, val in zip(vectors["type"], vectors["indices"], vectors["values"], strict=True):
            part = w[:, :-1] if kind == 1 else w[:, np.asarray(idx, dtype=np.int64)]
            out.append(part @ np.asarray(val, dtype=float) + w[:, -1])
        return pd.Series(out, dtype=object)

    score.__annotations__ = {"vectors": pd.DataFrame, "return": pd.Series}
    return F.pandas_udf(score, returnType=ArrayType(DoubleType()))(F.unwrap_udt(F.col(features)))


def kept_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks written once and held in memory as far as there is room, to be unpersisted: what has no room is read again, not put on disk twice."""
    made = keep_table(blocks).persist(StorageLevel.MEMORY_ONLY)
    made.count()
    return made


def spread(blocks: Iterable[DataFrame], cores: int | None = None) -> DataFrame:
    """Blocks of all data, kept in memory; to be unpersisted. They stay where they are made."""
    out = None
    for b in blocks:
        out = b if out is None else out.unionByName(b)
    made = out.persist()
    made.count()
    return made
