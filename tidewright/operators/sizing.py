"""Broadcast a side only after its size has been measured."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20

# Bytes one value takes in a row, above the 8 bytes every field has.
_FIXED = 16


def _value_bytes(field: T.StructField) -> Column | None:
    """Bytes of one value of this column; None where no bound can be computed."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + F.lit(_FIXED)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return None
    return F.lit(_FIXED).cast("bigint")


def measured_bytes(*frames: DataFrame) -> list[int | None]:
    """Size of each frame, from one job that aggregates them all.

    The driver receives one number per frame. None means that a column of the frame has no
    measurable size, so the frame must be treated as large.
    """
    parts = []
    for i, frame in enumerate(frames):
        sizes = [_value_bytes(f) for f in frame.schema.fields]
        if any(s is None for s in sizes):
            continue
        total = F.coalesce(F.sum(reduce(lambda a, b: a + b, sizes)), F.lit(0)).cast("bigint")
        parts.append(frame.agg(F.lit(i).alias("i"), total.alias("bytes")))
    if not parts:
        return [None] * len(frames)
    found = {r["i"]: r["bytes"] for r in reduce(DataFrame.union, parts).collect()}
    return [found.get(i) for i in range(len(frames))]


def seems_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether Catalyst's estimate, which costs no job, leaves it worth measuring the whole frame."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


UNKNOWN_BYTES = 1 << 62


def read_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of what a frame reads: the sum of its sources, as joins have none of use.

    A checkpointed frame carries the estimate of the plan it was made by, which for joins is a product
    of sizes; with such a source the size is unknown.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sources = [leaves.apply(i) for i in range(leaves.size())]
    if any(x.nodeName() == "LogicalRDD" for x in sources):
        return UNKNOWN_BYTES
    return sum(int(x.stats().sizeInBytes()) for x in sources)


def fit(sizes: Sequence[int | None], limit: int = BROADCAST_BYTES) -> bool:
    """True when frames of these sizes together fit a broadcast of `limit` bytes."""
    return all(s is not None for s in sizes) and sum(sizes) <= limit


def are_small(*frames: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return fit(measured_bytes(*frames), limit)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, marked for a broadcast if it fits one."""
    return F.broadcast(df) if are_small(df, limit=limit) else df


def row_counts(*frames: DataFrame) -> list[int]:
    """Rows of each frame, from one job; plain parquet answers from its footers."""
    parts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
        for i, frame in enumerate(frames)
    ]
    found = {r["i"]: r["n"] for r in reduce(DataFrame.union, parts).collect()}
    return [found[i] for i in range(len(frames))]
