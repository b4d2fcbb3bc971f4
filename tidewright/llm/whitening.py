"""Whitening of embeddings from exact, bit-sliced cross-products.

Components become whole numbers, and every distinct vector counts once. A task takes some thousand
vectors at a time, subtracts each dimension's least value, and packs each bit plane of a dimension
across rows into 64-bit words. The AND of two planes holds a one where both bits are set, so its
popcount, weighted by the two bits' worth, adds up to the exact sum of products of two dimensions.
Sums are added by Spark as counts per pair of dimensions and worth. The driver gets one exact number
per pair of dimensions, centres them as whole numbers, and only then turns to floating point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
# Vectors that are cut into bit planes at a time, and rows whose result is made at a time.
ROWS_PER_PLANE, ROWS_PER_RESULT = 4096, 1024
# A direction whose variance is so small a share of the whole holds nothing but rounding.
LEAST_SHARE = 1e-13
# Whole numbers lie within these bounds, beyond which a component is refused by an error.
MOST = 1 << 61


def whole_numbers(lists: pa.ListArray, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """floor(SCALE * component) + OFFSET for each vector, and the vectors' sizes.

    Vectors shorter than `width` (by default the widest) count as ended by zeros.
    """
    sizes = np.diff(lists.offsets.to_numpy())
    width = int(sizes.max(initial=0)) if width is None else width
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() >= MOST:
        raise ValueError("a component is too large for an exact whole number")
    found = np.full((len(sizes), width), OFFSET, np.int64)
    found[np.arange(width)[None, :] < sizes[:, None]] = scaled.astype(np.int64) + OFFSET
    return found, sizes


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows whose vector is not NULL, with finite components only."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("embedding").isNotNull()).where(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding")


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the least and greatest number a task has seen, and in how many vectors."""
    low, high, counts = (np.empty(0, np.int64) for _ in range(3))
    for batch in batches:
        found, sizes = whole_numbers(batch.column("embedding"))
        wider = found.shape[1] - len(low)
        if wider > 0:
            none = np.zeros(wider, np.int64)
            low, high = np.concatenate((low, none + OFFSET)), np.concatenate((high, none + OFFSET))
            counts = np.concatenate((counts, none))
        has = np.arange(found.shape[1])[None, :] < sizes[:, None]
        n = has.sum(axis=0)
        seen = counts[: len(n)] > 0
        least = np.where(has, found, np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max)
        most = np.where(has, found, np.iinfo(np.int64).min).max(axis=0, initial=np.iinfo(np.int64).min)
        low[: len(n)] = np.where(n == 0, low[: len(n)], np.where(seen, np.minimum(low[: len(n)], least), least))
        high[: len(n)] = np.where(n == 0, high[: len(n)], np.where(seen, np.maximum(high[: len(n)], most), most))
        counts[: len(n)] += n
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high), pa.array(counts)],
        ["dim", "low", "high", "n"])


def _packed(batches: Iterator[pa.RecordBatch], low: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    """vec_id and the numbers above each dimension's least, in as many bytes as the widest needs."""
    for batch in batches:
        found, _ = whole_numbers(batch.column("embedding"), len(low))
        shifted = (found - low).astype(kind)
        size = shifted.shape[1] * shifted.dtype.itemsize
        data = pa.py_buffer(np.ascontiguousarray(shifted).tobytes())
        keys = pa.Array.from_buffers(pa.binary(size), len(shifted), [None, data])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), keys.cast(pa.binary())],
                                         ["vec_id", "vector"])


def _unpacked(vectors: pa.BinaryArray, width: int, kind: str) -> np.ndarray:
    if not len(vectors) or not width:
        return np.empty((len(vectors), width), kind)
    _, offsets, data = vectors.buffers()
    begin = np.frombuffer(offsets, np.int32)[vectors.offset]
    return np.frombuffer(data, kind, len(vectors) * width, int(begin)).reshape(len(vectors), width)


def bit_planes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(dimension, bit, words): each bit of each dimension across rows, without planes of zeros."""
    bits = int(numbers.max(initial=0)).bit_length()
    rows = -(-len(numbers) // 64) * 64
    padded = np.zeros((numbers.shape[1], rows), np.uint64)
    padded[:, : len(numbers)] = numbers.T
    dims, at, planes = [], [], []
    for bit in range(bits):
        set_bits = (padded >> np.uint64(bit)) & np.uint64(1)
        words = np.packbits(set_bits.astype(bool), axis=1).view(np.uint64)
        used = np.flatnonzero(words.any(axis=1))
        dims.append(used), at.append(np.full(len(used), bit)), planes.append(words[used])
    if not planes:
        return np.empty(0, int), np.empty(0, int), np.empty((0, rows // 64), np.uint64)
    return np.concatenate(dims), np.concatenate(at), np.concatenate(planes)


def _scattered(batches: Iterator[pa.RecordBatch], width: int, kind: str) -> Iterator[pa.RecordBatch]:
    """(i, j, worth, n): n pairs of set bits worth 2^worth in dimensions i <= j; j = -1 are plain sums."""
    levels = 2 * 8 * np.dtype(kind).itemsize - 1
    # Popcounts by pair of dimensions and worth; they stay far below 2^63.
    pairs = np.zeros((levels, width, width), np.int64)
    single = np.zeros((levels, width), np.int64)
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS_PER_PLANE):
            numbers = _unpacked(batch.column("vector").slice(a, ROWS_PER_PLANE), width, kind)
            dims, bits, planes = bit_planes(numbers)
            ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
            np.add.at(single, (bits, dims), ones)
            for p in range(len(planes)):
                # Each pair of planes once; planes of one dimension meet in both orders.
                both = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)
                both[1:][dims[p + 1 :] == dims[p]] *= 2
                i, j = np.minimum(dims[p], dims[p:]), np.maximum(dims[p], dims[p:])
                np.add.at(pairs, (bits[p] + bits[p:], i, j), both)
    worth, i, j = np.nonzero(pairs)
    at, dim = np.nonzero(single)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((i, dim)).astype(np.int32)),
         pa.array(np.concatenate((j, np.full(len(dim), -1))).astype(np.int32)),
         pa.array(np.concatenate((worth, at)).astype(np.int32)),
         pa.array(np.concatenate((pairs[worth, i, j], single[at, dim])))],
        ["i", "j", "worth", "n"])


@dataclass(frozen=True)
class Whitening:
    """A fitted projection. Numbers are counted from each dimension's least value."""

    n: int
    low: np.ndarray
    kind: str
    # Exact sums of the shifted numbers, and the exact centred products times n^2.
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def width(self) -> int:
        return len(self.low)

    def centred(self, numbers: np.ndarray) -> np.ndarray:
        """n * x - S, exactly."""
        top = max((int(numbers.max(initial=0)) + 1) * self.n, *map(abs, self.sums), 1)
        kind = np.int64 if top < 1 << 62 else object
        return numbers.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, centred: np.ndarray) -> list[int]:
        most = int(np.abs(centred).max(initial=0))
        if centred.dtype != object and most * most * max(1, self.width) < 1 << 63:
            return (centred * centred).sum(axis=1).tolist()
        return [sum(c * c for c in row) for row in centred.tolist()]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(float) / self.n @ self.vectors / np.sqrt(self.values)


def centred_covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """(n * sum of products - product of sums) / n^2, rounded once."""
    width = len(sums)
    found = np.zeros((width, width))
    for i in range(width):
        for j in range(i, width):
            found[i, j] = found[j, i] = (n * products.get((i, j), 0) - sums[i] * sums[j]) / (n * n)
    return found


def packed(rows: DataFrame) -> tuple[DataFrame, np.ndarray, str]:
    """The usable rows as vec_id and packed vector, each dimension's least number, and the number type."""
    kept = usable(rows)
    seen = kept.select("embedding").mapInArrow(
        _bounds, "dim int, low long, high long, n long").groupBy("dim").agg(
        F.min(F.when(F.col("n") > 0, F.col("low"))).alias("low"),
        F.max(F.when(F.col("n") > 0, F.col("high"))).alias("high"), F.sum("n").alias("n"))
    # One row per dimension.
    dims = sorted(seen.collect(), key=lambda r: r["dim"])
    whole = max((r["n"] for r in dims), default=0)
    # Where vectors are shorter, their missing components are zeros.
    low = np.array([min(r["low"], OFFSET) if r["n"] < whole else r["low"] for r in dims], np.int64)
    high = [max(r["high"], OFFSET) if r["n"] < whole else r["high"] for r in dims]
    most = max((int(h) - int(b) for h, b in zip(high, low, strict=True)), default=0)
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if most < 1 << 8 * np.dtype(k).itemsize)
    found = kept.mapInArrow(lambda b: _packed(b, low, kind), "vec_id long, vector binary")
    return stored(found, "packed-vectors"), low, kind


def fit(vectors: DataFrame, low: np.ndarray, kind: str, components: int = COMPONENTS) -> Whitening:
    """The projection on the main directions of distinct packed vectors.

    The driver gets one row per pair of dimensions, however many vectors there are.
    """
    width = len(low)
    n = vectors.count()
    counts = vectors.mapInArrow(lambda b: _scattered(b, width, kind), "i int, j int, worth int, n long")
    # Counts of one worth are added as they are; only the driver multiplies by the worth, exactly.
    found = counts.groupBy("i", "j", "worth").agg(F.sum("n").alias("n")).groupBy("i", "j").agg(
        F.collect_list(F.struct("worth", "n")).alias("parts"))
    sums, products = [0] * width, {}
    for r in found.toLocalIterator():
        exact = sum(p["n"] << p["worth"] for p in r["parts"])
        if r["j"] < 0:
            sums[r["i"]] = exact
        else:
            products[r["i"], r["j"]] = exact
    if not n or not width:
        return Whitening(n, low, kind, sums, np.empty(0), np.empty((width, 0)), 0.0)
    values, directions = np.linalg.eigh(covariance := centred_covariance(n, sums, products))
    trace = float(np.trace(covariance))
    order = [i for i in np.argsort(-values, kind="stable") if values[i] > LEAST_SHARE * trace > 0]
    order = order[:components]
    return Whitening(n, low, kind, sums, values[order], directions[:, order], trace)


def _moments(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    """Sums of whitened components and of their products, of the rows of a task."""
    k = len(model.values)
    total, products = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS_PER_RESULT):
            numbers = _unpacked(batch.column("vector").slice(a, ROWS_PER_RESULT), model.width, model.kind)
            found = model.whitened(model.centred(numbers))
            total += found.sum(axis=0)
            products += found.T @ found
    i, j = np.triu_indices(k)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate((np.arange(k), i)).astype(np.int32)),
         pa.array(np.concatenate((np.full(k, -1), j)).astype(np.int32)),
         pa.array(np.concatenate((total, products[i, j])))], ["i", "j", "s"])


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity, as measured.

    The mean of the whitened components is zero but for rounding, so sums of products lose nothing.
    """
    found = vectors.mapInArrow(lambda b: _moments(b, model), "i int, j int, s double").groupBy(
        "i", "j").agg(F.sum("s").alias("s")).collect()
    sums = {r["i"]: r["s"] / model.n for r in found if r["j"] < 0}
    off = [abs(r["s"] / model.n - sums[r["i"]] * sums[r["j"]] - (r["i"] == r["j"]))
           for r in found if r["j"] >= 0]
    return max(off, default=0.0)


_RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
           "explained double, identity_error double")


def _results(batches: Iterator[pa.RecordBatch], model: Whitening, error: float) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    explained = model.values / model.trace if k else model.values
    for batch in batches:
        for a in range(0, batch.num_rows if k else 0, ROWS_PER_RESULT):
            part = batch.slice(a, ROWS_PER_RESULT)
            centred = model.centred(_unpacked(part.column("vector"), model.width, model.kind))
            whitened = model.whitened(centred)
            deviations = model.deviations(centred)
            if max(deviations, default=0) < 1 << 63:
                exact = pa.array(deviations, pa.int64()).cast(pa.decimal128(38, 0))
            else:
                # NULL where not even 38 digits hold it.
                exact = pa.array([Decimal(d) if d < 10**38 else None for d in deviations],
                                 pa.decimal128(38, 0))
            rows = np.repeat(np.arange(part.num_rows), k)
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(rows)),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                 pa.array(np.full(m, model.n)), exact.take(pa.array(rows)), pa.array(whitened.ravel()),
                 pa.array(np.tile(explained, part.num_rows)), pa.array(np.full(m, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    One row for each usable vector and each of the main components, numbered by falling variance.
    Left out are rows whose vector is NULL or holds a NULL or non-finite component; a NULL vec_id
    stays NULL. The fit counts equal vectors once, the result has every row, repeated ones too.
    Vectors shorter than the widest count as ended by zeros. Directions without variance are no
    components, so fewer than the dimensions may come back, and none from an empty table or from one
    vector alone. Only vec_id and embedding are read, whatever else a table has.
    """
    vectors, low, kind = packed(rows)
    # Copies are dropped by each task before the rest is shuffled.
    distinct = stored(vectors.select("vector").distinct(), "distinct-vectors")
    model = fit(distinct, low, kind, components)
    error = identity_error(distinct, model) if len(model.values) else 0.0
    return vectors.mapInArrow(lambda b: _results(b, model, error), _RESULT)
