"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A table with at most this many rows may be broadcast after its size was checked.
BROADCAST_ROWS = 1_000_000
# Keys above this many rows are split over several tasks; at most HOT_KEYS of them are.
HOT_ROWS = 5_000_000
HOT_KEYS = 100_000
# Copies of the small side when it is too large to broadcast and key sizes are unknown.
SALTS = 32


def lookup_join(
    big: DataFrame, small: DataFrame, on: Sequence[str] | str, how: str = "inner", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a fact side with a per-key table.

    ``small`` is computed once, kept, and counted up to the limit. Within the limit it is broadcast
    and ``big`` does not move; beyond it both sides are shuffled on the key plus a salt, so that a
    hot key of ``big`` is spread over ``SALTS`` tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = small.persist()
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), keys, how)
    row_salt = F.pmod(F.xxhash64(*[F.col(c) for c in _hashable(big)]), F.lit(SALTS))
    salted_big = big.withColumn("__salt", row_salt.cast("int"))
    salted_small = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_big.join(salted_small, [*keys, "__salt"], how).drop("__salt")


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    size_col: str,
    spread_by: Column,
    hot_rows: int = HOT_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Inner join where ``small`` has one row per key and knows the key's row count in ``big``.

    Keys with more than ``hot_rows`` rows are cut into pieces of that size: their row in ``small`` is
    repeated once per piece and the rows of ``big`` are dealt to the pieces by hash. The table of hot
    keys is a top-k, so its broadcast is bounded whatever the data; both sides read the same table,
    so the result is exact also when there are more hot keys than that.
    """
    hot = (
        small.filter(F.col(size_col) > hot_rows)
        .orderBy(F.desc(size_col), key)
        .limit(hot_keys)
        .select(key, F.ceil(F.col(size_col) / F.lit(hot_rows)).cast("int").alias("__pieces"))
    )
    piece = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("__pieces")).cast("int"), F.lit(0))
    last = F.coalesce(F.col("__pieces"), F.lit(1)) - 1
    left = big.join(F.broadcast(hot), key, "left").withColumn("__piece", piece).drop("__pieces")
    right = (
        small.join(F.broadcast(hot), key, "left")
        .withColumn("__piece", F.explode(F.sequence(F.lit(0), last)))
        .drop("__pieces")
    )
    return left.join(right, [key, "__piece"]).drop("__piece")
