"""Shared by the operators: scratch tables, words, and connected components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuslens.sources.tables import shared_folder

#: White space between words.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Rows of a text table that a task turns into Python values at a time.
ROWS = 256


def sliced(batches, rows: int = ROWS):
    """Arrow batches in slices of a few rows, so that the texts of a whole batch are never Python values at once."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
        del batch
        pa.default_memory_pool().release_unused()


class Remembered(dict):
    """Values by key, made where they are missing; all are forgotten when the keys take about ``memory`` bytes."""

    def __init__(self, make, memory: int = 16 << 20):
        super().__init__()
        self.make, self.memory, self.size = make, memory, 0

    def __missing__(self, key):
        value, cost = self.make(key), len(key) + 120
        if cost * 100 < self.memory:
            self.size += cost
            if self.size > self.memory:
                self.clear()
                self.size = cost
            self[key] = value
        return value


class Scratch:
    """Tables of one run in the shared folder; each can be dropped as soon as nothing reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.top = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self) -> str:
        self.n += 1
        return f"{self.top}/{self.n}"

    def keep(self, df: DataFrame, compression: str | None = None) -> DataFrame:
        """Write the rows once and go on from the files, so that a lost executor costs no recomputation."""
        path = self.path()
        df.write.parquet(path, compression=compression)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, df: DataFrame) -> None:
        self.drop_path(df.scratch_path)

    def drop_path(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` of every node in ``edges (a, b)``; the component is its smallest node.

    Large-star and small-star steps in turn: every node points its larger neighbours, then its smaller
    ones, to the least of them, until all edges are stars. Rows never exceed the edges. Minima are
    combined before the shuffle, and the joins back are plain sort-merge joins, whose skewed partitions
    (hubs) Spark splits. Null ends and loops link nothing.
    """
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, before = scratch.keep(e), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.keep(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        new = scratch.keep(small.select("e.*").filter("a <> b").distinct())
        scratch.drop(e)
        scratch.drop(large)
        e = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


class Forest:
    """Union-find over int64 ids, for the links one task has found."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (y := up.get(r, r)) != r:
            r = y
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.up)]


def contracted(edges: DataFrame) -> DataFrame:
    """The edges (a, b) of each partition as stars: same components, fewer rows. For int64 ids."""

    def stars(batches):
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.link(a, b)
        rows = forest.edges()
        for i in range(0, len(rows), 100_000):
            part = np.array(rows[i : i + 100_000], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], names=["a", "b"])

    return edges.select("a", "b").filter("a is not null and b is not null").mapInArrow(stars, "a long, b long")


#: Up to so many ids are sent to every task; more are joined by shuffle.
BROADCAST_IDS = 1_000_000


def flagged(df: DataFrame, ids: DataFrame, key: str, flag: str, most: int = BROADCAST_IDS) -> DataFrame:
    """``df`` with a boolean ``flag``: whether its key is among ``ids`` (a table of unique non-null keys).

    The ids are counted first: a table of at most ``most`` goes to every task, so that texts stay where
    they are; a larger one is joined by shuffle.
    """
    ids = ids.select(F.col(key), F.lit(True).alias(flag))
    if ids.limit(most + 1).count() <= most:
        ids = F.broadcast(ids)
    return df.join(ids, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def with_small(df: DataFrame, small: DataFrame, on: list[str], most: int = BROADCAST_IDS) -> DataFrame:
    """Left join; ``small`` is counted, and goes to every task if it has at most ``most`` rows."""
    return df.join(F.broadcast(small) if small.limit(most + 1).count() <= most else small, on, "left")
