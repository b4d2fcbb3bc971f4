"""A sieve for rows by key: a bitmap of bounded size that tells which keys are none of those given.

A key sets a few bits of one word of the bitmap. A key whose bits are not all set there is certainly
none of those given; of the others about one in a hundred passes all the same. So rows can be told
apart where they lie, by a filter that a plan may push below joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.skew import check_comparable, key_hash
from tidewright.session import checkpointed

# Bits a key has a share of, and bits it sets. Above the most words more keys pass, none is lost.
BITS_PER_KEY, BITS_SET, WORD, MOST_WORDS = 16, 4, 64, 1 << 20


def _place(df: DataFrame, keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word a row's key belongs to, and the bits it sets there."""
    hashed = key_hash(df, keys)
    again = F.xxhash64(hashed)
    bits = [F.shiftright(again, 6 * i).bitwiseAND(F.lit(WORD - 1)).cast("int") for i in range(BITS_SET)]
    one = F.lit(1).cast("bigint")
    mask = reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", one, b) for b in bits])
    return F.pmod(hashed, F.lit(words)).cast("int"), mask


@dataclass(frozen=True)
class Sieve:
    """The bitmap, kept as one row with the array of its words, and a frame with the keys' types."""

    bitmap: DataFrame
    words: int
    like: DataFrame

    def passes(self, df: DataFrame) -> Column:
        """Whether a row's key may be one of those given; never NULL."""
        keys = self.like.columns
        check_comparable(df, self.like, keys)
        word, mask = _place(df, keys, self.words)
        return F.get(self.bitmap.scalar(), word).bitwiseAND(mask) == mask


def sieve(keys: DataFrame) -> Sieve:
    """The sieve of a frame's distinct keys, which are all of its columns."""
    spark = keys.sparkSession
    words = min(MOST_WORDS, max(1, -(-keys.count() * BITS_PER_KEY // WORD)))
    word, mask = _place(keys, keys.columns, words)
    every = spark.range(words).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("b"))
    filled = keys.select(word.alias("w"), mask.alias("b")).union(every).groupBy("w").agg(F.bit_or("b").alias("b"))
    in_order = F.sort_array(F.collect_list(F.struct("w", "b")))
    return Sieve(checkpointed(filled.agg(in_order["b"].alias("bitmap"))), words, keys.limit(0))
