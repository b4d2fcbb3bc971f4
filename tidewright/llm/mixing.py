"""Mixing of sources to target weights by proportionate-fair scheduling of blocks.

Each source's rows form blocks. With weight w of a total W, block i of a source may run from slot
floor(i * W / w) on and must run before slot ceil((i + 1) * W / w). One block runs per slot, always
the released one with the earliest deadline; all deadlines are met, so after any number of slots
each source is less than one block from its share. The schedule repeats every W slots, so one
period, made from the weights alone, places any number of blocks by arithmetic.

Every source found has a weight and a schedule of its own, also one without a listed weight and a
NULL source. When a source has no block left, a new phase shares the slots among the others by
their weights. No row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import BROADCAST_BYTES, broadcast_if_small, number_rows

BLOCK_ROWS = 32
# Weights are whole numbers, the listed ones and the default together at most this.
MOST_TOTAL = 10_000
# The key of the default weight, and the name that a NULL source goes by.
OTHER = "other"


def checked(weights: Mapping[str, int], other: int) -> dict[str, int]:
    """The weights with the default of sources not named; whole positive numbers of a bounded sum."""
    full = {**weights, OTHER: other} if OTHER not in weights else dict(weights)
    if any(not isinstance(w, int) or w < 1 for w in full.values()) or sum(full.values()) > MOST_TOTAL:
        raise ValueError(f"weights must be whole, positive and at most {MOST_TOTAL} in sum")
    return full


def weights_of(sources: Collection[str], weights: Mapping[str, int], other: int = 1,
               shared: bool = False) -> dict[str, int]:
    """The weight of each source found: its listed weight, or else `other`.

    With `shared`, the sources not listed have equal parts of `other`: all weights are multiplied
    by their number, and then by what keeps them whole and least.
    """
    full = checked(weights, other)
    listed = {s: w for s, w in weights.items() if s != OTHER}
    rest = sum(s not in listed for s in sources)
    times = rest if shared and rest else 1
    found = {s: listed[s] * times if s in listed else full[OTHER] for s in sources}
    least = math.gcd(*found.values()) if shared else 1
    return {s: w // least for s, w in found.items()}


def _slots(weights: Mapping[str, int]) -> Iterator[str]:
    """The source of each slot of one period, by earliest deadline first; ties go by name."""
    total = sum(weights.values())
    done = dict.fromkeys(weights, 0)
    waiting = [(0, s) for s in weights]
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, s = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(done[s] + 1) * total // weights[s]), s))
        _, s = heapq.heappop(ready)
        yield s
        done[s] += 1
        if done[s] < weights[s]:
            heapq.heappush(waiting, (done[s] * total // weights[s], s))


def period(weights: Mapping[str, int]) -> list[str]:
    """The source of each slot of one period."""
    return list(_slots(weights))


def phases(weights: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[dict]:
    """For each phase its first slot, its period, and the blocks each source has run before it.

    There is at most one phase per weight. Of a period only the slots up to the phase's end are
    made, so that there are no more of them than blocks, however many sources there are.
    """
    left = {s: n for s, n in blocks.items() if n}
    before, slot = dict.fromkeys(blocks, 0), 0
    while left:
        shares = {s: weights[s] for s in left}
        total = sum(shares.values())
        # In each whole period a source runs as many blocks as its weight. All sources have at
        # least a block left after so many, and one runs out in the period that follows.
        whole = min((n - 1) // shares[s] for s, n in left.items())
        rest = {s: n - whole * shares[s] for s, n in left.items()}
        at: dict[str, list[int]] = {s: [] for s in shares}
        length = 0
        slots = _slots(shares)
        for i, s in enumerate(slots):
            at[s].append(i)
            if len(at[s]) == rest[s]:
                length = i + 1
                break
        ran = {s: whole * shares[s] + len(at[s]) for s in shares}
        if whole:
            for i, s in enumerate(slots, length):
                at[s].append(i)
        yield {"slot": slot, "slots": total, "before": {s: before[s] for s in shares},
               "ran": ran, "at": at, "weights": shares}
        slot += whole * total + length
        for s in shares:
            before[s] += ran[s]
            left[s] -= ran[s]
        left = {s: n for s, n in left.items() if n}


def scheduled(rows: DataFrame, order: list[Column], weights: Mapping[str, int], other: int = 1,
              block_rows: int = BLOCK_ROWS, shared: bool = False) -> DataFrame:
    """Adds to narrow rows with a `source`: mix_group, block, phase, release, deadline, slot, position.

    Every source is a group of its own; one without a listed weight has the weight `other`, or with
    `shared` an equal part of it (`weights_of`). A NULL source is called OTHER, in brackets if a
    source has that name, and its weight is never a listed one. Rows of a group are cut into
    blocks by `order`; `position` is the row's place in the mixed order, from 0. Release and
    deadline are slots too. Rows equal in `order` may swap their places.
    """
    checked(weights, other)
    placed = number_rows(rows, order, "__row", "source")
    # One small row per source.
    counted = {r["source"]: r["n"] for r in placed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    unnamed = OTHER
    while unnamed in counted or (unnamed in weights and unnamed != OTHER):
        unnamed = f"({unnamed})"
    placed = placed.withColumn("mix_group", F.coalesce("source", F.lit(unnamed)))
    sizes = {unnamed if s is None else s: n for s, n in counted.items()}
    full = weights_of(sizes, weights, other, shared)
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    spark = rows.sparkSession
    spans, slots, short = [], [], 0
    for i, p in enumerate(phases(full, blocks)):
        for s, w in p["weights"].items():
            if p["ran"][s]:
                spans.append((s, i, p["before"][s], p["ran"][s], p["slot"], p["slots"], w, short))
                slots += [(s, i, j, at) for j, at in enumerate(p["at"][s])]
        # A phase ends with the last block of a group, which may be short; rows after it move up.
        short += sum(blocks[s] * block_rows - sizes[s] for s in p["weights"]
                     if p["before"][s] + p["ran"][s] == blocks[s])
    span = spark.createDataFrame(
        spans, "__g string, phase int, __before long, __ran long, __slot long, __slots long, __w long,"
        " __short long")
    slot = spark.createDataFrame(slots, "__s string, __p int, __j long, __at long")
    block = F.floor(F.col("__row") / block_rows).cast("long")
    own = F.col("block") - F.col("__before")
    w, total = F.col("__w"), F.col("__slots")

    def small(table: DataFrame, found: list[tuple]) -> DataFrame:
        return F.broadcast(table) if len(found) * 64 <= BROADCAST_BYTES else table

    # Both tables follow from the weights and blocks, and have no more rows than there are blocks
    # and slots in the periods that are run through.
    found = placed.withColumn("block", block).join(
        small(span, spans),
        (F.col("mix_group") == F.col("__g")) & (own >= 0) & (own < F.col("__ran")),
    ).withColumn("__own", own).join(
        small(slot, slots),
        (F.col("mix_group") == F.col("__s")) & (F.col("phase") == F.col("__p"))
        & (F.col("__own") % w == F.col("__j")),
    )

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    run = F.col("__slot") + div(F.col("__own"), w) * total + F.col("__at")
    place = F.col("slot") * block_rows + F.col("__row") % block_rows - F.col("__short")
    return found.withColumn("slot", run).select(
        *[F.col(f"`{c}`") for c in rows.columns], "mix_group", "block", "phase",
        (F.col("__slot") + div(F.col("__own") * total, w)).alias("release"),
        (F.col("__slot") + div((F.col("__own") + 1) * total + w - 1, w)).alias("deadline"),
        "slot", place.cast("long").alias("position"),
    )


def mixed(docs: DataFrame, weights: Mapping[str, int], other: int = 1,
          block_rows: int = BLOCK_ROWS, shared: bool = False) -> DataFrame:
    """The rows themselves, sorted by their place in the mixed order over all partitions.

    Places are found on narrow rows; whole rows then move by the key of their place and by ranges
    of it. Written out, the files hold the mixture in order. Rows that share doc_id, source and
    text (or its 64-bit hash) count as one and stay together.
    """
    key = F.struct("doc_id", "source", F.xxhash64("text").alias("text"))
    narrow = docs.select(key.alias("__key")).distinct().select("__key.*")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("text")]
    places = scheduled(narrow, order, weights, other, block_rows, shared).select(
        F.struct("doc_id", "source", "text").alias("__key"), F.col("position").alias("__position"))
    joined = docs.withColumn("__key", key).join(broadcast_if_small(places), "__key")
    dealt = joined.repartitionByRange("__position").sortWithinPartitions("__position")
    return dealt.select(*[F.col(f"`{c}`") for c in docs.columns])
