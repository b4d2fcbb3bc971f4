"""A reproducible shuffle: a Feistel permutation of global row numbers.

The permutation of 0..n-1 is computed from the number alone, so any reader can tell where a row
goes without looking at other rows. Rounds work on a rectangle of a x b cells with a * b barely
above n; numbers that land outside 0..n-1 walk on along their cycle until they are inside.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.shared import number_rows

# A prime; all products below stay under 2^62, so up to about 4 * 10^18 rows can be numbered.
PRIME = 2147483647
MULTIPLIER = 1103515245
# One key per round; their number is even, so that the sides of the rectangle end as they began.
KEYS = (362436069, 521288629, 88675123, 5783321, 6615241, 1218640798)


def sides(n: int) -> tuple[int, int]:
    """The rectangle: a * b is at least n and less than n + a."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def keyed(seed: int) -> list[int]:
    return [(k + seed * MULTIPLIER) % PRIME for k in KEYS]


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _quotient(number: Column, by: int) -> Column:
    return F.call_function("div", number, _long(by))


def permuted(number: Column, n: int, seed: int = 0) -> Column:
    """One application of the rounds to a number below a * b; the result is below a * b too."""
    a, b = sides(n)
    rounds = F.array(*[
        F.struct(_long(k).alias("key"), _long(b if i % 2 else a).alias("side"))
        for i, k in enumerate(keyed(seed))
    ])
    cell = F.struct(_quotient(number, b).alias("left"), (number % _long(b)).alias("right"))

    def step(at: Column, r: Column) -> Column:
        mixed = (at["right"] * _long(MULTIPLIER) + r["key"]) % _long(PRIME)
        turned = (at["left"] + mixed * mixed % _long(PRIME)) % r["side"]
        return F.struct(at["right"].alias("left"), turned.alias("right"))

    return F.aggregate(rounds, cell, step, lambda at: at["left"] * _long(b) + at["right"])


def walk_length(spark: SparkSession, n: int, seed: int = 0) -> int:
    """Applications after which every number from 0 to n-1 has walked back inside.

    Only the a * b - n numbers outside can prolong a walk (fewer than the root of n), so they
    alone are followed. Some of them may lie on cycles that never come inside; no walk that begins
    inside meets those. Once a step takes no more numbers back inside, only such cycles are left.
    """
    a, b = sides(n)
    outside, steps = spark.range(n, a * b).select(F.col("id").alias("x")), 1
    left = a * b - n
    while left:
        x = F.col("x")
        outside = outside.select(permuted(x, n, seed).alias("x")).where(x >= n)
        still = outside.count()
        if still == left:
            break
        left, steps = still, steps + 1
    return steps


def place(number: Column, n: int, walk: int, seed: int = 0) -> Column:
    """Where the permutation of 0..n-1 puts a number."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(walk)),
        number.cast("long"),
        lambda at, i: F.when((i > 1) & (at < F.lit(n)), at).otherwise(permuted(at, n, seed)),
    )


def sharded(df: DataFrame, order: Sequence[Column], shards: int, seed: int = 0) -> DataFrame:
    """Adds `shard` and `slot` to each row of a narrow frame.

    Rows are numbered by `order` over the whole frame; place p of the permutation is shard
    p mod `shards`, slot p div `shards`. So counts differ by one at most and slots have no gaps.
    Rows equal in `order` may swap their places.
    """
    numbered = number_rows(df, order, "__row")
    n = numbered.count()
    where = place(F.col("__row"), n, walk_length(df.sparkSession, n, seed), seed)
    found = numbered.withColumn("__place", where)
    return found.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__place") % shards).cast("int").alias("shard"),
        _quotient(F.col("__place"), shards).alias("slot"),
    )


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus 8; a NULL text has none) and text_crc32, with a text hash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("__text"),
    )
