"""Builders for dimensions and facts, each in full and in delta form.

A builder without a cycle makes the whole table; with one it makes the rows to merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle, any_in_cycle, in_cycle, newest
from tidewright.operators.sizing import (
    BROADCAST_BYTES,
    are_small,
    broadcast_if_small,
    fit,
    measured_bytes,
    row_counts,
    seems_small,
)
from tidewright.operators.skew import (
    hot_groups,
    hot_keys,
    hot_pairs,
    is_large,
    number_in_groups,
    spread_join,
)
from tidewright.operators.timed import (
    Timed,
    combine,
    join_changed,
    rows_in_cycle,
    union_of_changed,
)
from tidewright.session import checkpointed

_FLAT_TS = "__flat_ts"


def passthrough(df: DataFrame, ts: str, cycle: Cycle | None = None) -> DataFrame:
    """A table as it is, or its rows of one cycle."""
    return rows_in_cycle(df, ts, cycle)


def qualifier(
    df: DataFrame,
    key: str,
    names: Sequence[str],
    ts: str,
    cycle: Cycle | None = None,
    current: DataFrame | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Members with a number that tells apart those of one name; NULL where a name is unique.

    In delta form the numbering sees only the rows of the cycle. Given `current`, the
    dimension as it stands, it sees every member of each name group the cycle touched (by its
    new or its former name) instead, which keeps the result equal to a full build.
    """
    names = list(names)
    rows = df.select(key, *names, ts)
    may_be_large = True
    if cycle is not None:
        changed = rows.where(in_cycle(ts, cycle))
        if current is None:
            rows = changed
        else:
            # The touched groups are costly to count; the table bounds them.
            may_be_large = is_large(rows.count(), min_rows)
            ids = broadcast_if_small(changed.select(key))
            former = current.join(ids, [key], "left_semi")
            touched = changed.select(*names).union(former.select(*names)).distinct()
            if may_be_large:
                touched = checkpointed(touched)
            touched = broadcast_if_small(touched.toDF(*[f"__t{i}" for i in range(len(names))]))
            same = reduce(
                lambda a, b: a & b,
                [F.col(n).eqNullSafe(F.col(f"__t{i}")) for i, n in enumerate(names)],
            )
            rows = rows.join(touched, same, "left_semi")
    hot = hot_groups(rows, names, key, min_rows) if may_be_large else None
    numbered = number_in_groups(rows, names, key, "__number", "__total", hot)
    only_shared = F.when(F.col("__total") > 1, F.col("__number")).alias("qualifier")
    return numbered.select(key, *names, only_shared, ts)


def lookup(
    rows: Timed,
    lookups: Timed,
    on: Sequence[str],
    columns: Sequence[str],
    out_ts: str,
    cycle: Cycle | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with attributes of a lookup table; rows without a lookup entry are dropped.

    The delta form has the rows where either side lies inside the cycle.
    """
    both = Timed(rows.df, rows.ts + lookups.ts)
    if cycle is None:
        hot = hot_keys(rows.keys(*on), on)
        joined = combine(rows, lookups, on, hot).df
    else:
        joined = join_changed(rows, lookups, on, cycle, limit=limit)
    return joined.select(*columns, both.newest().alias(out_ts))


def flatten(chain: Sequence[tuple[Timed, Sequence[str]]], base: Timed) -> Timed:
    """Joins a chain of lookups: `base` to the first, that to the second, and so on.

    The lookups are put together from the far end, so that the small ones meet first.
    """
    if not chain:
        return base
    (nearest, on), rest = chain[0], chain[1:]
    return combine(base, flatten(rest, nearest), on, hot_keys(base.keys(*on), on))


def snowflake(
    rows: Timed,
    lookups: Sequence[tuple[Timed, Sequence[str]]],
    columns: Sequence[str],
    out_ts: str,
    cycle: Cycle | None = None,
    both: bool = False,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows joined to a chain of lookups: the first to the rows, each other to the one before.

    Two delta forms are in use. The default takes rows that changed, or whose newest lookup
    time lies inside the cycle. With `both` a row must have changed itself and any one of its
    lookups as well.
    """
    (nearest, on), chain = lookups[0], lookups[1:]
    lookup_ts = tuple(ts for table, _ in lookups for ts in table.ts)
    time = newest((*rows.ts, *lookup_ts)).alias(out_ts)
    flat_time = newest((*rows.ts, _FLAT_TS)).alias(out_ts)
    if cycle is None:
        flat = flatten(chain, nearest).as_one(_FLAT_TS)
        hot = hot_keys(rows.keys(*on), on)
        return combine(rows, flat, on, hot).df.select(*columns, flat_time)

    changed = rows.changed(cycle)
    if both:
        if are_small(changed, limit=limit):
            joined = _down_the_chain(changed, lookups).where(any_in_cycle(lookup_ts, cycle))
        else:
            any_changed = _changed_chain(nearest, chain, cycle, limit)
            hot = hot_keys(rows.keys(*on), on)
            joined = spread_join(changed, any_changed, on, hot_left=hot)
        return joined.select(*columns, time)

    tables = [table for table, _ in lookups]
    if all(seems_small(t.df, limit) for t in tables):
        # One job measures the lookups, their changes and those of the rows.
        measured = measured_bytes(
            changed, *[t.changed(cycle) for t in tables], *[t.df for t in tables])
        of_rows, of_changes = measured[0], measured[1 : 1 + len(tables)]
        if not any(of_changes):
            # No lookup changed: nothing but the changed rows is read.
            few = F.broadcast(changed) if fit([of_rows], limit) else changed
            return _down_the_chain(few, lookups, bounded=True).select(*columns, time)
        if fit(measured[1 + len(tables) :], limit):
            flat = _flat_of_small(lookups).as_one(_FLAT_TS)
            joined = rows.df.join(F.broadcast(flat.df), list(on))
            return joined.where(any_in_cycle((*rows.ts, _FLAT_TS), cycle)).select(*columns, flat_time)

    # The newest lookup time can only lie inside the cycle if one of them does.
    any_changed = Timed(_changed_chain(nearest, chain, cycle, limit), lookup_ts)
    flat_changed = any_changed.as_one(_FLAT_TS).changed(cycle)
    sizes = measured_bytes(changed, flat_changed)
    if not fit(sizes, limit):
        flat = flatten(chain, nearest).as_one(_FLAT_TS)
        joined = join_changed(rows, flat, on, cycle, limit=None)
        return joined.select(*columns, flat_time)
    from_rows = _down_the_chain(changed, lookups).select(*columns, time)
    from_lookups = rows.unchanged(cycle).join(F.broadcast(flat_changed), list(on))
    return union_of_changed([from_rows, from_lookups.select(*columns, flat_time)], sizes)


def _changed_chain(
    nearest: Timed, chain: Sequence[tuple[Timed, Sequence[str]]], cycle: Cycle, limit: int
) -> DataFrame:
    """Rows of the flattened chain with any table of it inside the cycle."""
    if not chain:
        return nearest.changed(cycle)
    (following, on), rest = chain[0], chain[1:]
    return join_changed(nearest, flatten(rest, following), on, cycle, limit=limit)


def _flat_of_small(lookups: Sequence[tuple[Timed, Sequence[str]]]) -> Timed:
    """The flattened chain of lookups that were measured to fit a broadcast together."""
    (nearest, _), chain = lookups[0], lookups[1:]
    flat, ts = nearest.df, nearest.ts
    for following, keys in chain:
        flat, ts = flat.join(F.broadcast(following.df), list(keys)), ts + following.ts
    return Timed(flat, ts)


def _down_the_chain(
    few: DataFrame, lookups: Sequence[tuple[Timed, Sequence[str]]], bounded: bool = False
) -> DataFrame:
    """A small set of rows joined to each lookup in turn, so that only their entries are met.

    With `bounded` the caller has seen to its hints.
    """
    (nearest, on), chain = lookups[0], lookups[1:]
    joined = (few if bounded else F.broadcast(few)).join(nearest.df, list(on))
    for following, keys in chain:
        joined = joined.join(following.df, list(keys))
    return joined


def _touched(
    links: Sequence[Timed], entity: Timed, other: Timed, on: str, other_on: str, cycle: Cycle,
    limit: int,
) -> DataFrame | None:
    """Distinct entity keys with a changed input, if they fit a broadcast.

    They are needed in three joins, so they are computed once and kept.
    """
    first, second = links
    keys = [t.changed(cycle).select(on) for t in (first, entity, second)]
    others = other.changed(cycle).select(other_on)
    (size,) = measured_bytes(others)
    if size > limit:
        return None
    if size:
        via = second.df.select(on, other_on).join(F.broadcast(others), [other_on], "left_semi")
        keys.append(via.select(on))
    touched = checkpointed(reduce(DataFrame.union, keys).dropna().distinct())
    return touched if are_small(touched, limit=limit) else None


def _only(rows: Timed, keys: DataFrame, on: str) -> Timed:
    """The rows of a few entities."""

    def keep(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(keys), [on], "left_semi")

    return Timed(keep(rows.df), rows.ts, None if rows.probe is None else keep(rows.probe))


def bridge(
    first: Timed,
    entity: Timed,
    second: Timed,
    other: Timed,
    on: str,
    other_on: str,
    columns: Sequence[str],
    out_ts: str,
    cycle: Cycle | None = None,
    limit: int = BROADCAST_BYTES,
    min_rows: int | None = None,
) -> DataFrame:
    """One row for each pair of links that meet in an entity.

    `first` and `second` link the entity to two other tables; `other` is the table behind
    `second`. The result has as many rows per entity as the product of its links, so an entity
    with many links on either side is spread as a grid over many tasks.

    The delta form keeps pairs with any of the four inputs inside the cycle. On large tables,
    while the touched entities fit a broadcast, links of all other entities are dropped at the
    scans; pairs of which no input changed are never formed. `min_rows` stands in for the sizes
    above which keys count as hot, of rows and of pairs.
    """
    n_first, n_second = row_counts(first.keys(on), second.keys(on))
    if cycle is not None and is_large(n_first + n_second, min_rows):
        touched = _touched((first, second), entity, other, on, other_on, cycle, limit)
        if touched is not None:
            first, entity, second = (_only(t, touched, on) for t in (first, entity, second))
            n_first, n_second = row_counts(first.keys(on), second.keys(on))
    hot_first = hot_keys(first.keys(on), [on], min_rows, n_first)
    hot_second = hot_keys(second.keys(on), [on], min_rows, n_second)
    hot_other = hot_keys(second.keys(other_on), [other_on], min_rows, n_second)

    left = combine(first, entity, [on], hot_first)
    right = combine(second, other, [other_on], hot_other)
    paired_first, paired_second = hot_pairs(first.keys(on), second.keys(on), [on], min_rows)
    hot_first, hot_second = hot_first | paired_first, hot_second | paired_second
    time = Timed(left.df, left.ts + right.ts).newest().alias(out_ts)
    if cycle is None:
        pairs = combine(left, right, [on], hot_first, hot_second).df
    else:
        pairs = join_changed(
            left, right, [on], cycle, limit=None, hot_left=hot_first, hot_right=hot_second
        )
    if not n_first or not n_second:
        pairs = pairs.where(F.lit(False))
    return pairs.select(*columns, time)
