"""Counts of references kept up to date, so that a check needs no join of whole tables.

For every key there is the number of rows that are it and the number of rows that refer to it. A
delta changes the counts of its own keys only. Keys that no row refers to, and keys referred to that
do not exist, are kept as small tables of their own, which is all a check reads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import checkpointed
from tidewright.sources.zones import Zone

PARENTS, CHILDREN = "parents", "children"
_STREAM = "changes"


class References:
    """The references from children to parents by one key, in three tables below a folder.

    Rows with a NULL key refer to nothing and are not counted. Each change has a number, one more than
    the last; one that is applied again, after a failure at any point, has no further effect.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        zone = Zone(spark, path)
        self.key = key
        self._counts = zone.table("counts", [key])
        self._childless = zone.table("childless", [key])
        self._orphaned = zone.table("orphaned", [key])

    def _counted(self, rows: Mapping[str, DataFrame], signs: Mapping[str, int]) -> DataFrame:
        """(key, parents, children): the sum of the signs of each key's rows, combined map-side."""
        zero = F.lit(0).cast("bigint")
        parts = None
        for name, df in rows.items():
            side, sign = name.split()[0], F.lit(signs[name]).cast("bigint")
            part = df.select(self.key).dropna().select(
                self.key, (sign if side == PARENTS else zero).alias(PARENTS),
                (sign if side == CHILDREN else zero).alias(CHILDREN))
            parts = part if parts is None else parts.unionByName(part)
        return parts.groupBy(self.key).agg(F.sum(PARENTS).alias(PARENTS), F.sum(CHILDREN).alias(CHILDREN))

    @staticmethod
    def _childless_in(counts: DataFrame) -> DataFrame:
        return counts.where((F.col(PARENTS) > 0) & (F.col(CHILDREN) == 0))

    @staticmethod
    def _orphaned_in(counts: DataFrame) -> DataFrame:
        return counts.where((F.col(PARENTS) == 0) & (F.col(CHILDREN) > 0))

    def start(self, parents: DataFrame, children: DataFrame) -> None:
        """Counts whole tables, once."""
        rows = {PARENTS: parents, CHILDREN: children}
        self._counts.replace(self._counted(rows, dict.fromkeys(rows, 1)))
        counts = self._counts.read()
        self._childless.replace(self._childless_in(counts).select(self.key))
        self._orphaned.replace(self._orphaned_in(counts).select(self.key))

    def last(self) -> int:
        """The number of the last change that was applied."""
        return self._counts.current().batches.get(_STREAM, 0)

    def apply(
        self,
        number: int,
        parents_added: DataFrame,
        parents_removed: DataFrame,
        children_added: DataFrame,
        children_removed: DataFrame,
    ) -> None:
        """Takes in the rows that came and went. Only counts of their keys are read and written."""
        rows = {f"{PARENTS} added": parents_added, f"{PARENTS} removed": parents_removed,
                f"{CHILDREN} added": children_added, f"{CHILDREN} removed": children_removed}
        signs = {name: 1 if name.endswith("added") else -1 for name in rows}
        change = checkpointed(self._counted(rows, signs))
        if number > self.last() + 1:
            raise ValueError(f"change {number} after {self.last()}")
        old = self._counts.matching(change)
        merged = old.unionByName(change).groupBy(self.key).agg(
            F.sum(PARENTS).alias(PARENTS), F.sum(CHILDREN).alias(CHILDREN))
        sound = F.when((F.col(PARENTS) < 0) | (F.col(CHILDREN) < 0),
                       F.raise_error(F.lit("more rows went than were there")))
        checked = merged.withColumn(PARENTS, F.coalesce(sound.cast("bigint"), F.col(PARENTS)))
        self._counts.upsert(checked, batch=(_STREAM, number))
        # From the counts as they are now, so doing it twice is the same as once.
        now = self._counts.matching(change)
        for table, found in ((self._childless, self._childless_in(now)), (self._orphaned, self._orphaned_in(now))):
            keys = found.select(self.key)
            table.remove(now.select(self.key).join(keys, [self.key], "left_anti"))
            table.upsert(keys)

    def counts(self) -> DataFrame:
        return self._counts.read()

    def childless(self) -> DataFrame:
        """Keys that exist and that nothing refers to."""
        return self._childless.read()

    def orphaned(self) -> DataFrame:
        """Keys that are referred to and do not exist."""
        return self._orphaned.read()
