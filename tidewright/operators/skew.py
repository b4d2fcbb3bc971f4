"""Work on keyed data in which a few keys hold a large part of the rows.

Finding such keys only decides how the work is laid out over tasks. Every function here
returns the same rows whichever keys are reported as hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import checkpointed

# Below this many rows no single group can be a burden for one task; a hot key is split into
# parts of about this size.
MIN_ROWS = 5_000_000
# A key is hot when it holds more than this share of the rows (so at most 10,000 keys are).
HOT_SHARE = 1 / 10_000
# Rows looked at to find the hot keys: a key at the threshold shows up about 200 times.
PROBE_ROWS = 2_000_000
# Pairs of one key that a task of a many-to-many join may form, and keys looked after there.
PAIRS_PER_TASK = 1 << 20
MOST_PAIRED = 10_000
# Numbers of parts a hot key may be split into. A few steps keep the expressions short.
PARTS = (8, 64, 512, 4096, 32768)
# Finest slicing of a hot group, and values looked at to place one cut.
MAX_SLICES = 4096
VALUES_PER_SLICE = 50


def _family(dtype: T.DataType) -> str | None:
    """The one type that keys which a join may find equal are hashed as; None for as they are."""
    if isinstance(dtype, T.NumericType):
        return "double"
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return None


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """A hash of a row's key that does not depend on the width of its types.

    Joins compare int with bigint or decimal, and date with timestamp, by value; so equal keys
    must hash alike on both sides. Rounding may give unequal keys one hash, which is harmless.
    """
    def part(name: str) -> Column:
        family = _family(df.schema[name].dataType)
        return F.col(name).cast(family) if family else F.col(name)

    return F.xxhash64(*[part(k) for k in keys])


def check_comparable(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    """Refuses key columns whose types have no common hash."""
    for name in on:
        a, b = left.schema[name].dataType, right.schema[name].dataType
        if _family(a) != _family(b) or (_family(a) is None and a != b):
            raise ValueError(f"key {name} is {a.simpleString()} on one side, {b.simpleString()} on the other")


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def is_large(rows: int, min_rows: int | None = None) -> bool:
    """Whether so many rows need any care about how they are laid out."""
    return rows > 0 and rows >= (MIN_ROWS if min_rows is None else min_rows)


@dataclass(frozen=True)
class HotKeys:
    """Hashes of hot keys, each with the number of rows it is estimated to hold.

    A key is split into parts of `per_part` rows, by default `MIN_ROWS`.
    """

    rows: Mapping[int, float] = field(default_factory=dict)
    per_part: int | None = None

    def __bool__(self) -> bool:
        return bool(self.rows)

    def __or__(self, other: HotKeys) -> HotKeys:
        """The keys hot in either; one hot in both is split into the larger number of parts."""
        if not self or not other:
            return self or other
        parts = {k: n / (self.per_part or MIN_ROWS) for k, n in self.rows.items()}
        for key, rows in other.rows.items():
            parts[key] = max(parts.get(key, 0), rows / (other.per_part or MIN_ROWS))
        return HotKeys(parts, 1)

    def _steps(self, most: int) -> dict[int, list[int]]:
        steps: dict[int, list[int]] = {}
        for key, rows in sorted(self.rows.items()):
            size = self.per_part or MIN_ROWS
            parts = next((p for p in PARTS if p * size >= rows), PARTS[-1])
            steps.setdefault(min(parts, most), []).append(key)
        return steps

    def most_parts(self, most: int = PARTS[-1]) -> int:
        return max(self._steps(most), default=1)

    def parts(self, df: DataFrame, keys: Sequence[str], most: int = PARTS[-1]) -> Column:
        """The number of parts a row's key is split into; 1 for keys that are not hot."""
        hashed, found = key_hash(df, keys), F.lit(1)
        for parts, hashes in self._steps(most).items():
            found = F.when(hashed.isin(hashes), F.lit(parts)).otherwise(found)
        return found

    def has(self, df: DataFrame, keys: Sequence[str]) -> Column:
        return key_hash(df, keys).isin(list(self.rows)) if self.rows else F.lit(False)


NONE_HOT = HotKeys()


def hot_keys(
    df: DataFrame, keys: Sequence[str], min_rows: int | None = None, rows: int | None = None
) -> HotKeys:
    """The keys that hold more than `HOT_SHARE` of the rows, at most 10,000.

    Costs a count (footers only, on plain parquet; none if `rows` is given) and, for a large
    frame, one scan of the key columns whose probe rows are counted with map-side combine.
    """
    rows = df.count() if rows is None else rows
    if not is_large(rows, min_rows):
        return NONE_HOT
    fraction = min(1.0, PROBE_ROWS / rows)
    # A key with a NULL counts like any other: windows group by it, and joins drop or spread it.
    probe = df.select(key_hash(df, keys).alias("h")).sample(fraction=fraction, seed=7)
    return _hot_in(probe, rows, fraction)


def _hot_in(probe: DataFrame, rows: int, fraction: float) -> HotKeys:
    floor = max(2.0, rows * fraction * HOT_SHARE)
    found = probe.groupBy("h").count().where(F.col("count") > floor).collect()
    return HotKeys({r["h"]: r["count"] / fraction for r in found})


def hot_pairs(
    left: DataFrame, right: DataFrame, on: Sequence[str], pairs: int | None = None
) -> tuple[HotKeys, HotKeys]:
    """The keys under which two frames form more than `pairs` pairs, for either side.

    Pairs are the product of a key's rows, so a key that is ordinary on both sides may still be
    a burden. Both sides of such a key are cut so that one cell of the grid forms about `pairs`.
    The driver gets the keys with the most pairs, at most `MOST_PAIRED`; any other key then
    forms less than 1/`MOST_PAIRED` of all pairs.
    """
    pairs = max(1, PAIRS_PER_TASK if pairs is None else pairs)

    def keyed(df: DataFrame, from_left: int) -> DataFrame:
        return df.dropna(subset=list(on)).select(key_hash(df, on).alias("h"), F.lit(from_left).alias("l"))

    # One count of both sides, combined map-side.
    both = keyed(left, 1).union(keyed(right, 0)).groupBy("h").agg(
        F.sum("l").alias("l"), F.sum(1 - F.col("l")).alias("r"))
    formed = F.col("l").cast("double") * F.col("r")
    found = both.where(formed > pairs).orderBy(formed.desc(), "h").limit(MOST_PAIRED).collect()
    side = isqrt(pairs)

    def cut(mine: str, others: str) -> HotKeys:
        parts = {x["h"]: ceil(x[mine] / max(side, pairs / x[others])) for x in found}
        return HotKeys({h: n for h, n in parts.items() if n > 1}, 1)

    return cut("l", "r"), cut("r", "l")


def _dealt(df: DataFrame, parts: Column) -> Column:
    # The task index separates equal rows; it does not depend on row order, so a task that
    # runs again after a lost executor gives its rows the same numbers.
    content = [F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *content), parts).cast("int")


def _copies(hot: Column, parts: Column) -> Column:
    zero = F.lit(0)
    return F.explode(F.when(hot, F.sequence(zero, parts - 1)).otherwise(F.array(zero)))


# Parts for rows with a NULL key, which no estimate covers.
NULL_PARTS = 512


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_left: HotKeys = NONE_HOT,
    hot_right: HotKeys = NONE_HOT,
    also: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on same-named columns that splits hot keys into parts.

    Rows of a hot key are dealt out over its parts on the side where it is hot and copied to
    each of them on the other side; a key hot on both sides is laid out as a grid. Rows whose
    key holds a NULL match nothing, so joins that keep them deal them out as well. Columns in
    `also` take part in the join but not in the hashes the hot keys are given by.
    """
    on, also = list(on), list(also)
    keeps_unmatched = how in ("left", "left_anti")
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a left-sided join: {how}")
    if hot_right and how != "inner":
        raise ValueError("copying left rows is only exact for an inner join")
    check_comparable(left, right, on)
    if not hot_left and not hot_right and not keeps_unmatched:
        return left.join(right, on + also, how)

    cells, zero = ["__l"], F.lit(0)
    dealt = F.when(hot_left.has(left, on), _dealt(left, hot_left.parts(left, on)))
    if keeps_unmatched:
        dealt = F.when(any_null(on), _dealt(left, F.lit(NULL_PARTS))).otherwise(dealt)
    l_cell = left.withColumn("__l", F.coalesce(dealt, zero))
    given = _copies(hot_left.has(right, on), hot_left.parts(right, on)) if hot_left else zero
    r_cell = right.withColumn("__l", given)
    if hot_right:
        cells.append("__r")
        dealt = F.when(hot_right.has(right, on), _dealt(right, hot_right.parts(right, on))).otherwise(zero)
        r_cell = r_cell.withColumn("__r", dealt)
        l_cell = l_cell.withColumn("__r", _copies(hot_right.has(left, on), hot_right.parts(left, on)))
    return l_cell.join(r_cell, on + also + cells, how).drop(*cells)


@dataclass(frozen=True)
class HotGroups:
    """Groups to number in slices, and the order-key values at which the slices are cut."""

    keys: HotKeys = NONE_HOT
    cuts: tuple[object, ...] = ()


def hot_groups(
    df: DataFrame, group: Sequence[str], order: str, min_rows: int | None = None
) -> HotGroups:
    """Hot groups of `df` and cut points that split their rows into similar shares."""
    rows = df.count()
    if not is_large(rows, min_rows):
        return HotGroups()
    fraction = min(1.0, PROBE_ROWS / rows)
    # Looked at twice, so the probe rows are kept rather than scanned for again.
    probe = checkpointed(
        df.select(key_hash(df, group).alias("h"), F.col(order).alias("o"))
        .sample(fraction=fraction, seed=7)
    )
    keys = _hot_in(probe, rows, fraction)
    if not keys:
        return HotGroups()
    slices = keys.most_parts(MAX_SLICES)
    # The values only place the cuts; about `MAX_SLICES * VALUES_PER_SLICE` at most.
    share = min(1.0, slices * VALUES_PER_SLICE / (fraction * sum(keys.rows.values())))
    hot = probe.where(F.col("h").isin(list(keys.rows)) & F.col("o").isNotNull())
    values = sorted(r["o"] for r in hot.sample(fraction=share, seed=7).collect())
    if not values:
        return HotGroups()
    return HotGroups(keys, tuple(values[len(values) * i // slices] for i in range(1, slices)))


def _with_slice(df: DataFrame, group: Sequence[str], order: str, hot: HotGroups) -> DataFrame:
    """Adds the slice a row of a hot group falls in; -1 for rows of other groups.

    The number of cuts below a value is found by halving, one projection per step. Smaller
    hot groups take several slices as one.
    """
    slices = len(hot.cuts) + 1
    dtype = T.ArrayType(df.schema[order].dataType)
    cuts = F.array(*[F.lit(c) for c in hot.cuts]).cast(dtype)
    found = df.withColumn("__slice", F.when(hot.keys.has(df, group), F.lit(0)))
    step = slices // 2
    while step:
        cut = F.get(cuts, F.col("__slice") + (step - 1))
        above = F.coalesce(F.col(order) > cut, F.lit(True))
        found = found.withColumn("__slice", F.col("__slice") + F.when(above, step).otherwise(0))
        step //= 2
    merged = F.floor(F.col("__slice") * hot.keys.parts(df, group, slices) / slices).cast("int")
    return found.withColumn("__slice", F.coalesce(merged, F.lit(-1)))


def number_in_groups(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    number: str,
    total: str,
    hot: HotGroups | None = None,
) -> DataFrame:
    """Adds each row's position in its group (by `order`) and the group's size.

    Ordinary groups take one window. A hot group is cut into slices of the order key; each
    slice is numbered by itself and the row counts of the slices before it are added. Those
    counts are pre-aggregated and joined on the window's own partitioning, so the rows move
    once either way.
    """
    in_order = F.col(order).asc_nulls_last()
    if not hot or not hot.keys:
        w = Window.partitionBy(*group)
        return df.withColumn(
            number, F.row_number().over(w.orderBy(in_order)).cast("bigint")
        ).withColumn(total, F.count(F.lit(1)).over(w))

    # A struct of the group columns compares its NULLs as equal, in windows and in joins.
    cell = ["__group", "__slice"]
    sliced = _with_slice(df, group, order, hot).withColumn("__group", F.struct(*group))
    w = Window.partitionBy(*cell)
    numbered = sliced.withColumn(
        number, F.row_number().over(w.orderBy(in_order)).cast("bigint")
    ).withColumn(total, F.count(F.lit(1)).over(w))
    # Taking the hot rows first keeps the filter short; a filter on the slice would be pushed
    # down through the halving steps and double with each.
    of_hot = _with_slice(df.where(hot.keys.has(df, group)), group, order, hot)
    counted = of_hot.groupBy(F.struct(*group).alias("__group"), "__slice").agg(
        F.count(F.lit(1)).alias("__n")
    )
    whole = Window.partitionBy("__group")
    before = whole.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        *cell,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("__all"),
    )
    return (
        numbered.join(offsets, cell, "left")
        .withColumn(number, F.col(number) + F.coalesce(F.col("__before"), F.lit(0)))
        .withColumn(total, F.coalesce(F.col("__all"), F.col(total)))
        .select(*df.columns, number, total)
    )
