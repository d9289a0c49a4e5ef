"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors are folded first. Cells come from spherical k-means on a bounded sample; every vector has
the cell of its nearest centroid as home. A vector also visits each cell in which a vector linked to it
may have its home: with cosine at least s, that one lies no further across the plane between two
centroids than the sine of the angle, so the visits are exact and no link is lost. In a cell, blocks of
bounded size are multiplied pair by pair; every block of homes meets every block of members, so each
link is counted once from either end. Tasks return counts and the local components, not pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuslens.llm.common import Scratch, components, read
from corpuslens.llm.registry import query

SIMILARITY = 0.98
#: Vectors that k-means is fitted on, vectors to a cell on the average, and cells at most.
SAMPLE, CELL, MOST_CELLS = 40_000, 4096, 1024
#: Rows of a block.
BLOCK = 2048


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors; the first distinct vectors are the start, an empty cell keeps its centroid."""
    centroids = vectors[:cells].copy()
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1)
        moved = np.where(norms[:, None] > 0, sums / np.where(norms > 0, norms, 1)[:, None], centroids)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids


def fit_cells(classes: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centroids by dimension, from at most SAMPLE vectors in the order of a hash."""
    sample = classes.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE).select("embedding").toPandas()["embedding"]
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(np.asarray(v, dtype=np.float64))
    out = {}
    for size, rows in by_size.items():
        x = np.array(rows)
        x /= np.linalg.norm(x, axis=1)[:, None]
        share = n * len(x) / max(1, len(sample))
        out[size] = spherical_kmeans(x, int(min(MOST_CELLS, len(x), max(1, math.ceil(share / CELL)))))
    return out


def _visits(centroids: dict[int, np.ndarray], similarity: float, kind: str):
    reach = math.sin(math.acos(min(1.0, similarity)))

    def visit(batches):
        for batch in batches:
            rows = []
            for cid, label, n, vector in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                rows.append((cid, label, n, np.asarray(vector, dtype=np.float64)))
            out = []
            for size in sorted({len(r[3]) for r in rows}):
                own = [r for r in rows if len(r[3]) == size]
                c = centroids.get(size)
                if c is None or len(c) == 1:
                    out += [(label, size, 0, True, cid, n, v.astype(kind).tobytes()) for cid, label, n, v in own]
                    continue
                gaps = np.linalg.norm(c[:, None] - c[None], axis=2) if len(c) <= 256 else np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))
                x = np.array([r[3] for r in own])
                s = (x / np.linalg.norm(x, axis=1)[:, None]) @ c.T
                home = s.argmax(axis=1)
                near = s[np.arange(len(x)), home][:, None] - s <= reach * gaps[home] + 1e-9
                for i, j in zip(*near.nonzero(), strict=True):
                    cid, label, n, v = own[i]
                    out.append((label, size, int(j), bool(home[i] == j), cid, n, v.astype(kind).tobytes()))
            for k in range(0, len(out), 5000):
                cols = list(zip(*out[k : k + 5000], strict=True))
                types = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(cols, types, strict=True)], names=["label", "size", "cell", "home", "cid", "n", "v"])

    return visit


def _products(similarity: float, kind: str):
    def multiply(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["left"]], pdf[pdf["right"]]
        stack = lambda part: np.frombuffer(b"".join(part["v"]), dtype=kind).reshape(len(part), -1).astype(np.float64)
        if not len(left) or not len(right):
            return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        x, y = stack(left), stack(right)
        cos = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None])
        a, b = left["cid"].to_numpy(), right["cid"].to_numpy()
        linked = (cos >= similarity) & (a[:, None] != b[None])
        links = linked @ right["n"].to_numpy().astype(np.float64)
        i, j = linked.any(axis=1), linked.any(axis=0)
        sub, sa, sb = linked[np.ix_(i, j)], a[i], b[j]
        ids, place = np.unique(np.concatenate([sa, sb]), return_inverse=True)
        root, pa_, pb = np.arange(len(ids)), place[: len(sa)], place[len(sa) :]
        while len(ids):
            before = root.copy()
            np.minimum.at(root, pa_, np.where(sub, root[pb][None], len(ids)).min(axis=1))
            np.minimum.at(root, pb, np.where(sub, root[pa_][:, None], len(ids)).min(axis=0))
            root = root[root]
            if (root == before).all():
                break
        counts = pd.DataFrame({"cid": a, "links": links.astype("int64"), "root": a})
        stars = pd.DataFrame({"cid": ids, "links": 0, "root": ids[root]})
        return pd.concat([counts[counts["links"] > 0], stars[stars["cid"] != stars["root"]]]).astype("int64")

    return multiply


def link_vectors(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vec_id, embedding, label``.

    Vectors link when their labels are equal and not null and their cosine, in double precision, is at
    least ``similarity``. Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing, and vectors of different length do not link. Equal vectors of one label are linked
    with each other. ``component_id`` is the smallest vec_id reachable; of a group the row with that id is
    kept (repeated rows of it all are). A null vec_id is never the smallest beside others.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    kind = "<f4" if dict(rows.dtypes)["embedding"] == "array<float>" else "<f8"
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    classes = rows.filter(usable).groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
    classes = scratch.keep(classes.withColumn("cid", F.monotonically_increasing_id()))

    visit = _visits(fit_cells(classes, classes.count()), similarity, kind)
    members = scratch.keep(classes.select("cid", "label", "n", "embedding").mapInArrow(visit, "label long, size int, cell int, home boolean, cid long, n long, v binary"))
    cell = ["label", "size", "cell"]
    blocks = members.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(blocks, cell).withColumn("b", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # in its own pair of blocks a home row is on both sides
    as_member = F.transform(every, lambda k: F.struct(k.alias("i"), F.col("b").alias("j"), (F.col("home") & (k == F.col("b"))).alias("left"), F.lit(True).alias("right")))
    as_home = F.transform(F.filter(every, lambda k: F.col("home") & (k != F.col("b"))), lambda k: F.struct(F.col("b").alias("i"), k.alias("j"), F.lit(True).alias("left"), F.lit(False).alias("right")))
    pairs = placed.select(*cell, "cid", "n", "v", F.explode(F.concat(as_member, as_home)).alias("p")).select(*cell, "cid", "n", "v", "p.*")
    found = pairs.groupBy(*cell, "i", "j").applyInPandas(_products(similarity, kind), "cid long, links long, root long")
    found = scratch.keep(found)
    scratch.drop(members)

    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    member = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), scratch)
    group = classes.join(member.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    first = group.groupBy("component").agg(F.min("first_id").alias("component_id"))
    done = group.join(first, "component").join(links, "cid", "left")
    done = scratch.keep(done.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("grouped")))
    out = rows.join(done, ["label", "embedding"], "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


SQL = f"""
WITH RECURSIVE vec AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS n2 FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.n2 > 0 AND b.n2 > 0
  WHERE list_inner_product(a.e, b.e) / (sqrt(a.n2) * sqrt(b.n2)) >= {SIMILARITY}
), reach(a, b) AS (SELECT vec_id, vec_id FROM vec UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (SELECT a, min(b) AS c FROM reach GROUP BY a
), links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM vec JOIN component ON component.a = vec_id LEFT JOIN links ON links.a = vec_id
"""


@query(SQL)
def op3_cell_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(read(spark, sf_dir, "embeddings"))
