"""An index from lookup keys to the rows that depend on them, along a chain of lookups.

A changed country touches the stores in its cities, and no column of a store says so. For each link of
the chain there are two narrow tables: a row's key with the key it refers to, and the same pairs laid
out by the latter. A change of any lookup is followed down to the rows by these, and the rows with all
they refer to are then found by key; both read only files that may hold the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle, in_cycle
from tidewright.session import checkpointed
from tidewright.sources.zones import Zone, ZoneTable


@dataclass(frozen=True)
class Link:
    """A table, its key, and the column that holds the key of the chain's next table."""

    table: str
    key: str
    refers: str


class Dependents:
    """The links of a chain, the first from the rows, kept up to date with each change.

    The key a column refers to has the name of the next table's key. A row that refers to NULL
    depends on nothing. Applying a change again has no further effect, also after a failure on the way.
    """

    def __init__(self, spark: SparkSession, path: str, links: Sequence[Link]) -> None:
        if any(a.refers != b.key for a, b in zip(links, links[1:], strict=False)):
            raise ValueError("each link must refer to the key of the next one")
        self.links = list(links)
        zone = Zone(spark, path)
        self._own = {x.table: zone.table(f"{x.table}/own", [x.key]) for x in links}
        self._by_ref = {
            x.table: ZoneTable(spark, f"{path}/{x.table}/by_reference", [x.refers, x.key], lead=1)
            for x in links
        }

    def started(self) -> bool:
        return all(t.exists() for t in self._by_ref.values())

    def start(self, tables: Mapping[str, DataFrame]) -> None:
        for x in self.links:
            self._own[x.table].replace(tables[x.table].select(x.key, x.refers).dropna(subset=[x.key]))
            self._by_ref[x.table].replace(self._own[x.table].read().select(x.refers, x.key).dropna())

    def apply(self, table: str, changed: DataFrame) -> None:
        """Takes in new and changed rows of one of the chain's tables, one row per key."""
        (x,) = (link for link in self.links if link.table == table)
        own, by_ref = self._own[table], self._by_ref[table]
        new = checkpointed(changed.select(x.key, x.refers).dropna(subset=[x.key]))
        was = own.matching(new).withColumnRenamed(x.refers, "__was")
        moved = checkpointed(
            was.join(new, [x.key]).where(~F.col("__was").eqNullSafe(F.col(x.refers)))
            .select(F.col("__was").alias(x.refers), x.key).dropna())
        by_ref.upsert(new.select(x.refers, x.key).dropna())
        by_ref.remove(moved)
        # Last, as it tells what a change that is applied again has to take back.
        own.upsert(new)

    def reached(self, changed: Mapping[str, DataFrame]) -> DataFrame:
        """Keys of the rows that changed or that refer, over any number of links, to a changed key.

        `changed` has keys of any of the chain's tables; the table at its end goes by its key's name.
        """
        far = self.links[-1].refers
        keys = changed.get(far)
        for x in reversed(self.links):
            parts = [] if keys is None else [self._by_ref[x.table].holding(keys).select(x.key)]
            parts += [changed[x.table].select(x.key)] if x.table in changed else []
            if parts:
                found = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
                keys = checkpointed(found.dropna().distinct())
        if keys is None:
            raise ValueError("no changes were given")
        return keys


class Affected:
    """A source with the part of a chain's tables that one cycle's delta needs; others are as they are.

    A table of the chain is what the rows reached by the cycle's changes refer to, found by key.
    """

    def __init__(self, zone: Zone, index: Dependents, end: str, ts: str, cycle: Cycle) -> None:
        self._zone = zone
        far = index.links[-1].refers
        names = [*[x.table for x in index.links], end]

        def changed(name: str, key: str) -> DataFrame:
            return zone.within(name, cycle).where(in_cycle(ts, cycle)).select(key)

        told = {x.table: changed(x.table, x.key) for x in index.links} | {far: changed(end, far)}
        keys, self._parts = index.reached(told), {}
        refers = [*[x.refers for x in index.links], None]
        for name, key in zip(names, refers, strict=True):
            rows = zone.table(name).matching(keys)
            if key is not None:
                # Looked up by the next table, so not read again for that.
                rows = checkpointed(rows)
                keys = rows.select(key).dropna().distinct()
            self._parts[name] = rows

    def __call__(self, name: str) -> DataFrame:
        return self._parts[name] if name in self._parts else self._zone.read(name)
