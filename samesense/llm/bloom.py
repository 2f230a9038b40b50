"""Bloom filters for column functions, and bitmaps for tasks in Python, all of bounded size."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samesense.llm.words import fresh, let


@dataclass(frozen=True)
class Level:
    """One filter: a one-row table of its 64-bit words, their number, the hashes, and the seed.

    The words are data, not part of a plan: a column function reads them through a scalar
    subquery, which Spark runs once and hands to the tasks as one value.
    """

    table: DataFrame
    size: int
    hashes: int
    seed: int

    def words(self) -> Column:
        return self.table.scalar()


def _places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    """Bit positions of a key: double hashing from two seeded 31-bit hashes."""
    first = F.shiftrightunsigned(F.xxhash64(F.lit(2 * seed), key), 33)
    second = F.shiftrightunsigned(F.xxhash64(F.lit(2 * seed + 1), key), 33)
    return [F.pmod(first + j * second, F.lit(bits)) for j in range(hashes)]


def bits_needed(n: int, rate: float) -> int:
    return max(64, 64 * math.ceil(1.4427 * n * max(1, math.ceil(math.log2(1 / rate))) / 64))


def build(keys: DataFrame, n: int, rate: float, seed: int, max_bytes: int, shrink: bool = False) -> Level:
    """A filter over ``n`` distinct ``key`` rows that admits other keys at ``rate``.

    The driver holds the words twice for a moment, as numbers and as the table: at most
    ``max_bytes`` each, and twelve bytes per word while they arrive.

    Its size is ``1.44 n log2(1 / rate)`` bits. If that is more than ``max_bytes`` it is an
    error, or with ``shrink`` the filter stays at the bound and admits more.
    """
    hashes, bits = max(1, math.ceil(math.log2(1 / rate))), bits_needed(n, rate)
    if bits > 8 * max_bytes:
        if not shrink:
            raise ValueError(f"a filter over {n} keys takes {bits // 8} bytes; the bound is {max_bytes}")
        bits = 64 * (max_bytes // 8)
        hashes = max(1, min(hashes, round(0.693 * bits / n)))
    found = (
        keys.select(F.explode(F.array(*_places(F.col("key"), bits, hashes, seed))).alias("place"))
        .groupBy(F.expr("cast(place div 64 as int)").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        .toArrow()
    )
    words = np.zeros(bits // 64, "int64")
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    row = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words))
    return Level(keys.sparkSession.createDataFrame(pa.table({"words": row})), len(words), hashes, seed)


def admits(key: Column, level: Level, words: Column | None = None) -> Column:
    """Whether the filter holds ``key``; inside a lambda ``words`` come from ``with_words``."""
    words = level.words() if words is None else words
    found = F.lit(True)
    for place in _places(key, 64 * level.size, level.hashes, level.seed):
        word = F.get(words, F.shiftrightunsigned(place, 6).cast("int"))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))
        found = found & (word.bitwiseAND(bit) != 0)
    return found


def with_words(rows: DataFrame, name: str, levels: list[Level], body: Callable[[list[Column]], Column]) -> DataFrame:
    """``rows`` with a column ``name``: ``body`` of the words of each level, for use inside lambdas.

    A subquery may not stand inside a lambda, so the words come as a column, used once; Spark
    folds both projections into one, so no row ever carries the words.
    """
    if not levels:
        return rows.withColumn(name, body([]))
    held = fresh(rows, "_words")
    listed = rows.withColumn(held, F.array(*[level.words() for level in levels]))
    made = let(F.col(held), lambda words: body([F.get(words, F.lit(i)) for i in range(len(levels))]))
    return listed.withColumn(name, made).drop(held)


def split(rows: DataFrame, key: Column, keys: DataFrame, n: int, max_bytes: int = 32 << 20) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have one of the ``n`` hashes ``keys(key)``, and those that surely have none.

    The first part is to be joined exactly; the second needs no shuffle.
    """
    level = build(keys, n, 0.005, 5, max_bytes, shrink=True)
    return rows.where(admits(key, level)), rows.where(~admits(key, level))


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """One bit per possible value of the top ``bits`` bits of a column ``key`` of 64-bit hashes.

    ``2^bits / 8`` bytes whatever the number of keys; more keys only admit more. Returned as
    unsigned 64-bit words, for ``in_bitmap`` inside tasks.
    """
    rows = (
        hashes.select(F.shiftrightunsigned("key", 64 - bits).alias("bit"))
        .groupBy(F.expr("cast(bit div 64 as int)").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    )
    words = np.zeros(1 << (bits - 6), "int64")
    found = rows.toArrow()
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.view("uint64")


def in_bitmap(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    top = hashes >> np.uint64(64 - (len(words) * 64).bit_length() + 1)
    return (words[(top >> np.uint64(6)).astype("int64")] >> (top & np.uint64(63))) & np.uint64(1) > 0


def without(rows: DataFrame, keys: list[str], gone: DataFrame, n: int) -> DataFrame:
    """``rows`` whose ``keys`` columns are not among the ``n`` rows of ``gone`` (null-safe).

    Rows that a filter over ``gone`` does not admit are kept without a shuffle.
    """
    if not n:
        return rows
    likely, other = split(rows, F.xxhash64(*keys), gone.select(F.xxhash64(*keys).alias("key")), n)
    listed = gone.select(*[F.col(k).alias(f"_gone_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_gone_{i}"))
    return likely.join(listed, same, "left_anti").unionByName(other)
