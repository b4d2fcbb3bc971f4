"""Joins of frames that carry the time of their last change, in full and in delta form."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle, any_in_cycle, in_cycle, newest, not_in_cycle
from tidewright.operators.sizing import BROADCAST_BYTES, fit, measured_bytes, seems_small
from tidewright.operators.skew import NONE_HOT, HotKeys, hot_keys, spread_join


@dataclass(frozen=True)
class Timed:
    """Rows with the change times of every input they were made from.

    Where `df` is costly to make, `probe` may name a frame with the same key columns, and at
    least as many rows per key, in which hot keys can be looked for instead. `near` hands out the
    part of `df` that may have changed in a cycle, if its source can tell that without reading it.
    """

    df: DataFrame
    ts: tuple[str, ...]
    probe: DataFrame | None = None
    near: Callable[[Cycle], DataFrame] | None = None

    def keys(self, *on: str) -> DataFrame:
        return (self.df if self.probe is None else self.probe).select(*on)

    def changed(self, cycle: Cycle) -> DataFrame:
        """Rows with any input inside the cycle."""
        rows = self.df if self.near is None else self.near(cycle)
        return rows.where(any_in_cycle(self.ts, cycle))

    def unchanged(self, cycle: Cycle) -> DataFrame:
        rest = self.df
        for column in self.ts:
            rest = rest.where(not_in_cycle(column, cycle))
        return rest

    def newest(self) -> Column:
        return newest(self.ts)

    def as_one(self, name: str) -> Timed:
        """The same rows with a single change time, the newest of all inputs."""
        kept = [c for c in self.df.columns if c not in self.ts]
        return Timed(self.df.select(*kept, self.newest().alias(name)), (name,))


def timed(df: DataFrame, ts: str, name: str, columns: Sequence[str] | None = None) -> Timed:
    """The named columns of a table (all by default), its change time renamed to `name`."""
    kept = [c for c in df.columns if c != ts] if columns is None else list(columns)
    return Timed(df.select(*kept, F.col(ts).alias(name)), (name,))


def timed_table(
    source: Callable[[str], DataFrame], table: str, ts: str, name: str,
    columns: Sequence[str] | None = None, renamed: tuple[str, str] | None = None,
) -> Timed:
    """`timed` for a table of a source; one that knows its files' times reads only those near a cycle."""

    def of(df: DataFrame) -> Timed:
        return timed(df.withColumnRenamed(*renamed) if renamed else df, ts, name, columns)

    whole, within = of(source(table)), getattr(source, "within", None)
    if within is None:
        return whole
    return replace(whole, near=lambda cycle: of(within(table, cycle)).df)


def table_in_cycle(source: Callable[[str], DataFrame], table: str, cycle: Cycle | None) -> DataFrame:
    """A table, or the part of it that may hold rows of a cycle."""
    within = getattr(source, "within", None)
    return source(table) if cycle is None or within is None else within(table, cycle)


def combine(
    left: Timed,
    right: Timed,
    on: Sequence[str],
    hot_left: HotKeys = NONE_HOT,
    hot_right: HotKeys = NONE_HOT,
) -> Timed:
    """Inner equi-join; a small lookup is broadcast by Catalyst from its file size."""
    joined = spread_join(left.df, right.df, on, "inner", hot_left, hot_right)
    return Timed(joined, left.ts + right.ts)


def join_changed(
    left: Timed,
    right: Timed,
    on: Sequence[str],
    cycle: Cycle,
    limit: int | None = BROADCAST_BYTES,
    hot_left: HotKeys | None = None,
    hot_right: HotKeys = NONE_HOT,
) -> DataFrame:
    """Joined rows in which the left or the right row changed in the cycle.

    A filter `left changed or right changed` above the join reaches neither scan, so the join
    would read, shuffle and pair everything first. Three forms avoid that:

    * The right side as a whole fits a broadcast of `limit` bytes, and some of it changed: every left
      row has to be looked at, so it is, once, against all right rows.
    * Both changed sets fit: changed left rows against all right rows, plus unchanged left rows
      against changed right rows. Both window filters reach their scans and no large table is
      shuffled. A side without changes is left out, and then only the changes are read.
    * Otherwise (and without a limit) one shuffled join in which pairs of two unchanged rows
      never meet: a left row asks either for all right rows or for the changed ones only.

    Sizes are measured when the frame is put together, so the tables behind it must stay as
    they are until it runs; published zone tables and opened parquet files do.
    """
    on = list(on)
    if limit is not None:
        changes = left.changed(cycle), right.changed(cycle)
        whole = [right.df] if seems_small(right.df, limit) else []
        measured = measured_bytes(*changes, *whole)
        sizes, whole_size = measured[:2], measured[2:]
        if whole and fit(whole_size, limit) and sizes[1]:
            joined = left.df.join(F.broadcast(right.df), on)
            return joined.where(any_in_cycle(left.ts + right.ts, cycle))
        if fit(sizes, limit):
            from_left = F.broadcast(changes[0]).join(right.df, on)
            from_right = left.unchanged(cycle).join(F.broadcast(changes[1]), on)
            return union_of_changed([from_left, from_right], sizes)

    if hot_left is None:
        hot_left = hot_keys(left.keys(*on), on)
    everything, changed_only = F.lit(0), F.lit(1)
    l_asks = left.df.withColumn(
        "__asks",
        F.when(any_in_cycle(left.ts, cycle), everything).otherwise(changed_only),
    )
    r_gives = right.df.withColumn(
        "__asks",
        F.explode(
            F.when(any_in_cycle(right.ts, cycle), F.array(everything, changed_only))
            .otherwise(F.array(everything))
        ),
    )
    joined = spread_join(l_asks, r_gives, on, "inner", hot_left, hot_right, also=["__asks"])
    return joined.drop("__asks")


def union_of_changed(parts: Sequence[DataFrame], sizes: Sequence[int]) -> DataFrame:
    """The union of the parts that come from a change set which is not empty."""
    kept = [part for part, size in zip(parts, sizes, strict=True) if size]
    return reduce(DataFrame.unionByName, kept) if kept else parts[0].where(F.lit(False))


def rows_in_cycle(df: DataFrame, ts: str, cycle: Cycle | None) -> DataFrame:
    return df if cycle is None else df.where(in_cycle(ts, cycle))
