"""TF-IDF in long form: fit a vocabulary on one set of documents, weigh any set with it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuslens.functions.counting import Channel, Count, count_characters, count_words, rows_by_text, vectors_by_text
from corpuslens.functions.text import char_ngrams, char_wb_ngrams, join_tokens, pad_words, spaced_words, squeeze_spaces, word_ngrams, word_tokens
from corpuslens.operators.ngrams import char_term_stats, char_wb_term_stats, count_char_terms, count_char_wb_terms, count_word_terms, weigh_in_row, word_term_stats
from corpuslens.plans.joins import HOT_ROWS, salted_join
from corpuslens.sources.tables import keep_table

# A vocabulary up to this size is broadcast; max_features of at most this makes the bound certain.
BOUNDED_TERMS = 262_144
# Positions that a fitted model may have.
MOST_POSITIONS = 20_000_000
#: Vocabularies that are made at a time.
AT_ONCE = 4


def count_rows(df: DataFrame) -> Column:
    """Row count as a scalar subquery: no job while the plan is built, nothing on the driver."""
    return df.agg(F.count("*")).scalar()


def term_stats(counts: DataFrame) -> DataFrame:
    """``term, df, cf`` from ``id, term, tf``."""
    return counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def most_frequent(terms: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms with the highest ``cf``, ties by term. ``terms`` should be kept: it is read four times.

    No task ranks the vocabulary: terms are counted per frequency, which tells the frequency the cut
    falls into; its terms are counted per prefix, and only those of one prefix are ranked.
    """
    above = Window.orderBy(F.desc("cf"))
    by_cf = terms.groupBy("cf").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(above))
    cut = by_cf.filter(F.col("upto") > k).agg(F.max(F.struct("cf", (F.lit(k) - F.col("upto") + F.col("n")).alias("need")))).scalar()
    ties = terms.filter(F.col("cf") == cut["cf"]).withColumn("__prefix", F.substr("term", F.lit(1), F.lit(4)))
    by_prefix = ties.groupBy("__prefix").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(Window.orderBy("__prefix")))
    last = by_prefix.filter(F.col("upto") > cut["need"]).agg(F.min(F.struct("__prefix", (cut["need"] - F.col("upto") + F.col("n")).alias("need")))).scalar()
    before = ties.filter(last.isNull() | (F.col("__prefix") < last["__prefix"]))
    ranked = ties.filter(F.col("__prefix") == last["__prefix"]).withColumn("__rank", F.row_number().over(Window.partitionBy("__prefix").orderBy("term")))
    whole = terms.filter(cut.isNull() | (F.col("cf") > cut["cf"]))
    return whole.unionByName(before.drop("__prefix")).unionByName(ranked.filter(F.col("__rank") <= last["need"]).drop("__prefix", "__rank"))


def numbered(df: DataFrame, by: str, out_col: str) -> DataFrame:
    """``df`` with the place of each row in the order of ``by``, from 0; ``by`` is unique.

    Rows are sorted by ranges and written with their place in the range; ranges are counted, and what
    lies before each is added. No task sees more than its range, and the table of ranges is small.
    """
    ranged = df.repartitionByRange(by).sortWithinPartitions(by)
    rows = keep_table(ranged.withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    placed = rows.withColumn("__part", part).join(F.broadcast(before), "__part")
    return placed.select(*df.columns, (F.col("__before") + place).cast("int").alias(out_col))


@dataclass
class Vocabulary:
    """``terms``: ``term, df, cf, idf``; ``bounded`` tells that it holds at most BOUNDED_TERMS rows."""

    terms: DataFrame
    bounded: bool

    @staticmethod
    def fit(
        counts: DataFrame,
        n_docs: Column,
        min_df: int = 1,
        max_df: float | int = 1.0,
        max_features: int | None = None,
    ) -> "Vocabulary":
        """Terms in [min_df, max_df] documents, then the most frequent ``max_features`` (ties by term).

        A float ``max_df`` is a share of the documents. IDF is smoothed: ``ln((1+N)/(1+df)) + 1``.
        """
        return Vocabulary.from_stats(term_stats(counts), n_docs, min_df, max_df, max_features)

    @staticmethod
    def from_stats(
        stats: DataFrame, n_docs: Column, min_df: int = 1, max_df: float | int = 1.0, max_features: int | None = None
    ) -> "Vocabulary":
        """The same from ``term, df, cf``."""
        kept = stats.filter(F.col("df") >= min_df)
        if isinstance(max_df, int):
            kept = kept.filter(F.col("df") <= max_df)
        elif max_df < 1.0:
            kept = kept.filter(F.col("df") <= F.lit(max_df) * n_docs)
        if max_features is not None:
            kept = most_frequent(keep_table(kept), max_features)
        idf = F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0))) + F.lit(1.0)
        return Vocabulary(kept.withColumn("idf", idf), max_features is not None and max_features <= BOUNDED_TERMS)

    def indexed(self) -> DataFrame:
        """Terms with their position in alphabetical order, for models that keep one weight per position
        and class on the driver. A vocabulary beyond MOST_POSITIONS is refused, never cut."""
        if not self.bounded and self.terms.count() > MOST_POSITIONS:
            raise ValueError(f"more than {MOST_POSITIONS} terms: set max_features or a higher min_df")
        return numbered(self.terms, "term", "idx")

    def kept(self) -> "Vocabulary":
        """Written once, because every later step reads it."""
        return Vocabulary(keep_table(self.terms), self.bounded)

    def counted(self) -> "Vocabulary":
        """Kept, and known to be bounded if its terms, counted, are few."""
        kept = keep_table(self.terms)
        return Vocabulary(kept, self.bounded or kept.limit(BOUNDED_TERMS + 1).count() <= BOUNDED_TERMS)


def weigh(
    counts: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    keep: Sequence[str] = (),
    sublinear: bool = True,
    normalise: bool = True,
    hot_rows: int = HOT_ROWS,
    extra: Sequence[str] = (),
) -> DataFrame:
    """``(id, term, w)`` for the terms in the vocabulary; unknown terms are ignored.

    A bounded vocabulary is broadcast and the counts stay where they are, so on input partitioned by
    document the norm needs no shuffle either. An unbounded one is joined by term, with terms that
    occur in very many documents split over several tasks.
    """
    terms = vocabulary.terms
    if vocabulary.bounded:
        joined = counts.join(F.broadcast(terms.select("term", "idf", *extra)), "term")
    else:
        joined = salted_join(counts, terms.select("term", "df", "idf", *extra), "term", "df", F.col(id_col), hot_rows)
    tf = F.log("tf") + F.lit(1.0) if sublinear else F.col("tf").cast("double")
    weighed = joined.select(id_col, *keep, "term", *extra, (tf * F.col("idf")).alias("w"))
    if not normalise:
        return weighed
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return weighed.withColumn("w", F.col("w") / norm)


@dataclass(frozen=True)
class Block:
    """Settings of one feature channel."""

    channel: str  # "word", "char" or "char_wb"
    lo: int
    hi: int
    min_df: int = 2
    max_df: float | int = 1.0
    max_features: int | None = None
    min_len: int = 1
    sublinear: bool = True

    def counts(self, df: DataFrame, id_col: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
        if self.channel == "word":
            return count_word_terms(df, id_col, text, self.lo, self.hi, self.min_len, keep=keep)
        if self.channel == "char":
            return count_char_terms(df, id_col, text, self.lo, self.hi, keep)
        if self.channel == "char_wb":
            return count_char_wb_terms(df, id_col, text, self.lo, self.hi, keep)
        raise ValueError(f"unknown channel: {self.channel}")

    def stats(self, df: DataFrame, text: str) -> DataFrame:
        """``term, df, cf`` over all documents."""
        if self.channel == "word":
            return word_term_stats(df, text, self.lo, self.hi, self.min_len)
        if self.channel == "char":
            return char_term_stats(df, text, self.lo, self.hi)
        if self.channel == "char_wb":
            return char_wb_term_stats(df, text, self.lo, self.hi)
        raise ValueError(f"unknown channel: {self.channel}")

    def counting(self, text: str) -> tuple[Column, Count]:
        """What is counted of a row's text, and how."""
        lowered = F.lower(F.col(text))
        if self.channel == "word":
            return spaced_words(lowered), count_words(self.lo, self.hi, self.min_len)
        if self.channel == "char":
            return squeeze_spaces(lowered), count_characters(self.lo, self.hi)
        if self.channel == "char_wb":
            return pad_words(lowered), count_characters(self.lo, self.hi, lines=True)
        raise ValueError(f"unknown channel: {self.channel}")

    def terms(self, text: str) -> Column:
        """The terms of one row's text, repeats included."""
        lowered = F.lower(F.col(text))
        if self.channel == "word":
            return word_ngrams(join_tokens(word_tokens(lowered, self.min_len)), self.lo, self.hi)
        if self.channel == "char":
            return char_ngrams(squeeze_spaces(lowered), self.lo, self.hi)
        if self.channel == "char_wb":
            return char_wb_ngrams(pad_words(lowered), self.lo, self.hi)
        raise ValueError(f"unknown channel: {self.channel}")

    def fit(self, df: DataFrame, id_col: str, text: str) -> "FittedBlock":
        stats = self.stats(df, text)
        return FittedBlock(
            self, Vocabulary.from_stats(stats, count_rows(df), self.min_df, self.max_df, self.max_features).kept()
        )


@dataclass
class FittedBlock:
    block: Block
    vocabulary: Vocabulary

    def transform(self, df: DataFrame, id_col: str, text: str, keep: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
        if self.vocabulary.bounded and not extra:
            # at most BOUNDED_TERMS rows, which every task is sent
            known = self.vocabulary.terms.select("term", "idf").toArrow()
            return weigh_in_row(df, id_col, *self.block.counting(text), known, self.block.sublinear, keep)
        counts = self.block.counts(df, id_col, text, keep)
        return weigh(counts, self.vocabulary, id_col, keep, self.block.sublinear, extra=extra)


# Defaults of the three builders.
def word_block(lo: int = 1, hi: int = 2, min_df: int = 2, max_df: float = 0.90, max_features: int | None = 25_000) -> Block:
    return Block("word", lo, hi, min_df, max_df, max_features)


def char_block(
    lo: int = 3, hi: int = 5, min_df: int = 3, max_df: float = 0.90, max_features: int | None = 35_000, channel: str = "char_wb"
) -> Block:
    return Block(channel, lo, hi, min_df, max_df, max_features)


def word_char_blocks(min_df: int = 2, word_features: int = 25_000, char_features: int = 35_000) -> list[Block]:
    return [
        word_block(min_df=min_df, max_features=word_features),
        char_block(min_df=min_df, max_features=char_features),
    ]


def feature_blocks(feature_type: str = "word_char") -> list[Block]:
    """Blocks for ``word``, ``char`` or ``word_char``."""
    if feature_type == "word":
        return [word_block()]
    if feature_type == "char":
        return [char_block()]
    if feature_type == "word_char":
        return word_char_blocks()
    raise ValueError(f"Unknown feature_type: {feature_type}")


@dataclass
class FeatureUnion:
    """Several channels side by side; each is normalised on its own, terms are told apart by channel."""

    blocks: list[Block]
    fitted: list[FittedBlock] = field(default_factory=list)

    def fit(self, df: DataFrame, id_col: str = "doc_id", text: str = "clean") -> "FeatureUnion":
        return FeatureUnion(self.blocks, [b.fit(df, id_col, text) for b in self.blocks])

    def transform(self, df: DataFrame, id_col: str = "doc_id", text: str = "clean", keep: Sequence[str] = ()) -> DataFrame:
        """``(id, channel, term, w)``."""
        out = None
        for part in self.fitted:
            rows = part.transform(df, id_col, text, keep).withColumn("channel", F.lit(part.block.channel))
            out = rows if out is None else out.unionByName(rows)
        return out

    def terms(self) -> DataFrame:
        """``(channel, term, df, cf, idf, idx)``: positions run through the channels in block order."""
        out = None
        offset = F.lit(0)
        for part in self.fitted:
            rows = part.vocabulary.indexed().withColumn("idx", (F.col("idx") + offset).cast("int"))
            rows = rows.withColumn("channel", F.lit(part.block.channel))
            out = rows if out is None else out.unionByName(rows)
            offset = offset + part.vocabulary.terms.agg(F.count("*")).scalar()
        return out

    def channels(self, table: DataFrame, text: str) -> tuple[list[Column], list[Channel]]:
        """What is counted of a row's text in each block, and how; ``table``: ``channel, term, idf`` and what goes with a term."""
        known = table.toArrow()
        texts, out = [], []
        for i, part in enumerate(self.fitted):
            counted, count = part.block.counting(text)
            texts.append(counted.alias(f"c{i}"))
            own = known.filter(pc.equal(known["channel"], part.block.channel)).drop_columns(["channel"]).combine_chunks()
            out.append(Channel(count, own, part.block.sublinear))
        return texts, out

    def vectors(self, df: DataFrame, terms: DataFrame, size: int, id_col: str = "doc_id", text: str = "clean", keep: Sequence[str] = (), out_col: str = "features") -> DataFrame:
        """One sparse vector per document, for Spark ML; documents without known terms get zeros.

        Bounded vocabularies go to every task and a document's vector is made where the document is: no row
        per cell, no shuffle.
        """
        if all(part.vocabulary.bounded for part in self.fitted):
            texts, channels = self.channels(terms.select("channel", "term", "idf", "idx"), text)
            counting = [(c.count, c.sublinear) for c in channels]
            sent = df.sparkSession.sparkContext.broadcast([c.vocabulary for c in channels])

            @F.arrow_udf(VectorUDT())
            def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
                return vectors_by_text([Channel(c, v, s) for (c, s), v in zip(counting, sent.value, strict=True)], size)(batches)

            return df.select(id_col, *keep, vectors(F.struct(*texts)).alias(out_col))
        positions = F.broadcast(terms.select("channel", "term", "idx"))
        rows = self.transform(df, id_col, text).join(positions, ["channel", "term"])
        return as_vectors(df.select(id_col, *keep), rows, size, id_col, out_col)


def as_vectors(docs: DataFrame, cells: DataFrame, size: int, id_col: str = "doc_id", out_col: str = "features") -> DataFrame:
    """``docs`` with a sparse vector of the cells ``(id, idx, w)`` of each."""
    packed = cells.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("__cells"))
    vector = _to_vector(size)(F.col("__cells.idx"), F.col("__cells.w"))
    return docs.join(packed, id_col, "left").withColumn(out_col, vector).drop("__cells")


class CountedCorpus:
    """Sparse rows of the documents for every block, from one count per channel for the widest range that any block asks for.

    Vocabularies are taken from term statistics of the ``train`` documents, which are made once per channel.
    Blocks with a bounded vocabulary are weighed where the document is, all blocks of a channel from one
    count; the terms of others are joined by term. Word boundaries pad short words, so ranges inside words
    are counted each for itself.
    """

    def __init__(self, docs: DataFrame, blocks: Sequence[Block], id_col: str = "doc_id", text: str = "clean", split: str = "split"):
        self.docs, self.id_col, self.text, self.split = docs, id_col, text, split
        train = docs.filter(F.col(split) == "train")
        self.n_train = train.count()
        self.counts: dict[tuple, DataFrame] = {}
        self.stats: dict[tuple, DataFrame] = {}
        self.widest: dict[tuple, Block] = {}
        self.rows: dict[Block, tuple[DataFrame, int]] = {}
        for key in dict.fromkeys(self._key(b) for b in blocks):
            same = [b for b in dict.fromkeys(blocks) if self._key(b) == key]
            widest = self.widest[key] = Block(key[0], min(b.lo for b in same), max(b.hi for b in same), min_len=key[1])
            bounded = [b for b in same if b.max_features is not None and b.max_features <= BOUNDED_TERMS]
            if len(bounded) < len(same):
                self.counts[key] = keep_table(widest.counts(docs, id_col, text, [split]), id_col)
                self.stats[key] = keep_table(term_stats(self.counts[key].filter(F.col(split) == "train")))
            else:
                self.stats[key] = keep_table(widest.stats(train, text))
            # vocabularies are rows of small jobs
            with ThreadPoolExecutor(AT_ONCE) as pool:
                fitted = dict(zip(same, pool.map(lambda b: self.vocabulary(b).indexed(), same), strict=True))
            self._in_row(widest, {b: fitted[b] for b in bounded})
            for b in same:
                if b not in self.rows:
                    self.rows[b] = self._by_term(b, fitted[b])

    @staticmethod
    def _key(block: Block) -> tuple:
        return (block.channel, block.min_len, block.sublinear, *((block.lo, block.hi) if block.channel == "char_wb" else ()))

    @staticmethod
    def _in_range(block: Block) -> Column:
        if block.channel == "char_wb":
            return F.lit(True)
        n = F.length("term") if block.channel == "char" else F.regexp_count("term", F.lit(" ")) + 1
        return n.between(block.lo, block.hi)

    def vocabulary(self, block: Block) -> Vocabulary:
        stats = self.stats[self._key(block)].filter(self._in_range(block))
        return Vocabulary.from_stats(stats, F.lit(self.n_train), block.min_df, block.max_df, block.max_features).counted()

    def _in_row(self, widest: Block, fitted: dict[Block, DataFrame]) -> None:
        """Rows of all bounded blocks of a channel, as one table with a column for each."""
        if not fitted:
            return
        names = [f"b{i}" for i in range(len(fitted))]
        known: dict[str, list] = {}
        sizes = []
        for i, terms in enumerate(fitted.values()):
            found = terms.select("term", "idf", "idx").toArrow()
            sizes.append(len(found))
            for term, idf, idx in zip(*(found[c].to_pylist() for c in ("term", "idf", "idx")), strict=True):
                known.setdefault(term, [idf, *[None] * len(names)])[i + 1] = idx
        kinds = [pa.float64(), *[pa.int32()] * len(names)]
        columns = [pa.array([v[i] for v in known.values()], kind) for i, kind in enumerate(kinds)]
        sent = self.docs.sparkSession.sparkContext.broadcast(pa.table([pa.array(known, pa.string()), *columns], names=["term", "idf", *names]))
        text, count = widest.counting(self.text)
        sublinear = next(iter(fitted)).sublinear

        @F.arrow_udf(", ".join(f"{n} struct<idx: array<int>, w: array<double>>" for n in names))
        def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return rows_by_text(count, sent.value, names, sublinear)(batches)

        table = keep_table(self.docs.select(self.id_col, rows(text).alias("r")).select(self.id_col, "r.*"), self.id_col)
        for block, name, size in zip(fitted, names, sizes, strict=True):
            self.rows[block] = table.select(self.id_col, F.col(f"{name}.idx").alias("idx"), F.col(f"{name}.w").alias("w")), size

    def _by_term(self, block: Block, terms: DataFrame) -> tuple[DataFrame, int]:
        placed = Vocabulary(keep_table(terms), False).counted()
        counts = self.counts[self._key(block)].filter(self._in_range(block))
        cells = weigh(counts, placed, self.id_col, (), block.sublinear, extra=["idx"])
        packed = cells.groupBy(self.id_col).agg(F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("c"))
        return keep_table(packed.select(self.id_col, F.col("c.idx").alias("idx"), F.col("c.w").alias("w")), self.id_col), placed.terms.count()

    def block_rows(self, block: Block) -> tuple[DataFrame, int]:
        """``(id, idx, w)``, one row per document (none, if no block of its kind is bounded and the document has no term), and the number of positions."""
        return self.rows[block]


def _moved(by: int):
    return lambda position: position + F.lit(by)


def side_by_side(docs: DataFrame, parts: Sequence[tuple[DataFrame, int]], id_col: str = "doc_id", out_col: str = "features") -> tuple[DataFrame, int]:
    """``docs`` with the ``cells`` (indices and values) and the vector of several blocks as one matrix: positions run through the blocks."""
    size, idx, w = 0, [], []
    for i, (rows, n) in enumerate(parts):
        docs = docs.join(rows.select(id_col, F.col("idx").alias(f"__i{i}"), F.col("w").alias(f"__w{i}")), id_col, "left")
        idx.append(F.transform(F.coalesce(f"__i{i}", F.array().cast("array<int>")), _moved(size)))
        w.append(F.coalesce(f"__w{i}", F.array().cast("array<double>")))
        size += n
    held = [f"__{c}{i}" for i in range(len(parts)) for c in "iw"]
    out = docs.withColumn("cells", F.struct(F.concat(*idx).alias("indices"), F.concat(*w).alias("values"))).drop(*held)
    return out.withColumn(out_col, _to_vector(size)(F.col("cells.indices"), F.col("cells.values"))), size


def _to_vector(size: int):
    def pack(indices: pd.Series, values: pd.Series) -> pd.DataFrame:
        import numpy as np
        import pandas

        n = len(indices)
        fill = lambda cells, kind: [np.asarray([] if c is None else c, dtype=kind) for c in cells]
        return pandas.DataFrame(
            {"type": np.zeros(n, dtype="int8"), "size": [size] * n, "indices": fill(indices, "int32"), "values": fill(values, "float64")}
        )

    pack.__annotations__ = {"indices": pd.Series, "values": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(pack, returnType=VectorUDT())


def term_totals(weights: DataFrame) -> DataFrame:
    """Per term: documents, total and largest weight."""
    return weights.groupBy("term").agg(
        F.count("*").alias("n_docs"), F.round(F.sum("w"), 6).alias("sum_w"), F.round(F.max("w"), 6).alias("max_w")
    )


def feature_shape(weights: DataFrame, n_docs: Column, n_terms: Column) -> DataFrame:
    """Rows, columns, stored cells and density of the document-term matrix."""
    return weights.agg(F.count("*").alias("nnz")).select(
        n_docs.alias("n_docs"),
        n_terms.alias("n_terms"),
        "nnz",
        F.round(F.coalesce(F.try_divide(F.col("nnz").cast("double"), n_docs * n_terms), F.lit(0.0)), 9).alias("density"),
    )
