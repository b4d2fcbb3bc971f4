"""Bloom filters of a segment's values, kept as small parquet tables of bitmaps.

A value sets a few bits of a long bitmap, which is cut into rows of 32,768 bits each. A value whose
bits are not all set is certainly not in the segment, so a check need not read it. Bitmaps are put
together by an aggregate that combines map-side; the driver sees none of them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.operators.sizing import are_small

# Bits per value and probes: about one value in 400 is taken for one that is there.
BITS_PER_VALUE, PROBES = 16, 4
CHUNK = 32768


def bits(rows: int) -> int:
    """The length of the bitmap for so many values, in whole chunks."""
    return max(1, -(-rows * BITS_PER_VALUE // CHUNK)) * CHUNK


def _places(df: DataFrame, length: Column | int) -> Column:
    """The places of a row's value, from 1 on."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    size = F.lit(length) if isinstance(length, int) else length
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *columns), size) + 1 for i in range(PROBES)])


def write(values: DataFrame, rows: int, path: str) -> None:
    """Writes the sketch of a frame's values; rows with a NULL collide with nothing and are left out."""
    known = values.dropna()
    place = known.select(F.explode(_places(known, bits(rows))).alias("place"))
    place.groupBy(F.bitmap_bucket_number("place").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")).write.parquet(path)


def holding(values: DataFrame, told: Mapping[str, tuple[str, int]]) -> set[str]:
    """The names of the sketches, given as path and rows, that may hold any of the values.

    One row per name comes back. Values that fit are broadcast to the bitmaps, which stay in place.
    """
    spark = values.sparkSession
    columns = [F.col(f"`{c}`") for c in values.columns]
    sizes = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(bits(rows)).cast("bigint").alias("size"))
                      for n, (_, rows) in told.items()])
    asked = values.distinct().withColumn("value", F.struct(*columns))
    asked = asked.select(*columns, "value", F.explode(sizes).alias("sketch"))
    places = _places(asked.select(*columns), F.col("sketch.size"))
    probes = asked.select(F.xxhash64("value").alias("id"), F.col("sketch.name").alias("name"),
                          F.explode(places).alias("place")).select(
        "id", "name", F.bitmap_bucket_number("place").alias("chunk"),
        F.bitmap_bit_position("place").alias("bit"))
    maps = reduce(DataFrame.union, [
        spark.read.parquet(path).select(F.lit(n).alias("name"), "chunk", "bitmap")
        for n, (path, _) in told.items()])
    asked_for = F.broadcast(probes) if are_small(probes) else probes
    # Bit b of a bitmap is bit b % 8 of its byte b // 8.
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.call_function("div", "bit", F.lit(8)).cast("int") + 1,
                                    F.lit(1))), 16, 10).cast("int")
    met = maps.join(asked_for, ["name", "chunk"]).where(
        F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    # A value has PROBES probes; those that fall on one place count as often as they were asked.
    full = met.groupBy("name", "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PROBES)
    return {r["name"] for r in full.select("name").distinct().collect()}
