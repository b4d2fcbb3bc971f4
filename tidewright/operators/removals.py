"""Rows that are gone from a source, found by checksums of key ranges.

Deltas by change time never show a removed row. Comparing all keys of source and copy would move
both. So each side is first reduced to one order-free checksum per key range, combined map-side, and
these are rolled up into a tree. Only below nodes that differ are ranges compared, and only the keys of
ranges that differ meet row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.change import delete_by_key
from tidewright.operators.skew import any_null, key_hash

# Ranges that are told apart, and how many of them share a node of the tree above.
RANGES, FAN = 4096, 64
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class KeyRanges:
    """Ranges of a whole-number key, or of the hash of any other key."""

    def __init__(self, source: DataFrame, copy: DataFrame, keys: Sequence[str], ranges: int = RANGES
                 ) -> None:
        self.keys, self.ranges = list(keys), ranges
        first = self.keys[0]
        self.whole = all(isinstance(df.schema[first].dataType, _WHOLE) for df in (source, copy))
        self.low, self.high = 0, 0
        if self.whole:
            # Answered from the footers' statistics or a scan of one column.
            ends = [df.agg(F.min(first).alias("a"), F.max(first).alias("b")).first() for df in (source, copy)]
            known = [x for r in ends for x in (r["a"], r["b"]) if x is not None]
            self.low, self.high = min(known, default=0), max(known, default=0)
        self.width = max(1, -(-(self.high - self.low + 1) // ranges))

    def of(self, df: DataFrame) -> Column:
        """The number of a row's range."""
        if not self.whole:
            return F.pmod(key_hash(df, self.keys), F.lit(self.ranges))
        above = F.col(f"`{self.keys[0]}`").cast("decimal(20,0)") - F.lit(self.low).cast("decimal(20,0)")
        return F.floor(above / F.lit(self.width)).cast("bigint")

    def within(self, df: DataFrame, numbers: Sequence[int]) -> Column:
        """Whether a row's range is among some; ranges of the key itself reach the scan."""
        if not self.whole:
            return self.of(df).isin(list(numbers))
        spans: list[list[int]] = []
        for n in sorted(numbers):
            if spans and spans[-1][1] == n:
                spans[-1][1] = n + 1
            else:
                spans.append([n, n + 1])
        column = F.col(f"`{self.keys[0]}`")
        inside = [column.between(max(self.low + a * self.width, -(1 << 63)),
                                 min(self.low + b * self.width - 1, (1 << 63) - 1)) for a, b in spans]
        return reduce(lambda a, b: a | b, inside, F.lit(False))


def checksums(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """(range, n, total, mixed) of the keys without a NULL; none depends on the order of rows."""
    keyed = df.select(*ranges.keys).dropna()
    # Two sums of different hashes: equal counts and sums of different keys would take both to collide.
    value = key_hash(keyed, ranges.keys)
    again = F.xxhash64(F.lit("again"), value)
    return keyed.select(ranges.of(keyed).alias("range"), value.alias("v"), again.alias("w")).groupBy(
        "range").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("total"),
                     F.bit_xor("w").alias("mixed"))


def rolled_up(leaves: DataFrame, fan: int = FAN) -> DataFrame:
    """The checksums of nodes that stand for `fan` ranges each."""
    node = F.floor(F.col("range") / F.lit(fan)).cast("bigint").alias("range")
    return leaves.groupBy(node).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.bit_xor("mixed").alias("mixed"))


def _differing(a: DataFrame, b: DataFrame) -> list[int]:
    """Numbers of ranges whose checksums are not the same on both sides; at most all of them."""
    sides = a.withColumn("side", F.lit(1)).union(b.withColumn("side", F.lit(-1)))
    net = sides.groupBy("range").agg(
        F.sum(F.col("n") * F.col("side")).alias("n"), F.sum(F.col("total") * F.col("side")).alias("total"),
        F.bit_xor("mixed").alias("mixed"))
    found = net.where((F.col("n") != 0) | (F.col("total") != 0) | (F.col("mixed") != 0))
    return sorted(r["range"] for r in found.select("range").collect())


def differing_ranges(source: DataFrame, copy: DataFrame, ranges: KeyRanges, fan: int = FAN) -> list[int]:
    """The ranges in which the keys of two frames differ, from the top of the tree downwards."""
    own, other = checksums(source, ranges), checksums(copy, ranges)
    # Kept, as both levels use them: one row per range.
    own, other = own.persist(), other.persist()
    try:
        nodes = _differing(rolled_up(own, fan), rolled_up(other, fan))
        if not nodes:
            return []
        below = F.floor(F.col("range") / F.lit(fan)).cast("bigint").isin(nodes)
        return _differing(own.where(below), other.where(below))
    finally:
        own.unpersist(), other.unpersist()


def removed(source: DataFrame, copy: DataFrame, keys: Sequence[str], ranges: int = RANGES) -> DataFrame:
    """Rows of the copy whose key the source no longer has; a key with a NULL is never missed.

    Repeated keys do not matter for the answer; a range in which only their number differs is
    compared and found complete.
    """
    cut = KeyRanges(source, copy, keys, ranges)
    numbers = differing_ranges(source, copy, cut)
    if not numbers:
        return copy.where(F.lit(False))
    kept = source.select(*keys).dropna().where(cut.within(source, numbers))
    suspects = copy.where(~any_null(list(keys))).where(cut.within(copy, numbers))
    return delete_by_key(suspects, kept, keys)
