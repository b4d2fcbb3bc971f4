"""The load cycle: full load, extract and load, transform, merge, checks."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tidewright.functions.windows import CYCLE_MINUTES, Cycle, floor_time, last_closed_cycle
from tidewright.operators.quality import (
    Check,
    CheckReport,
    require_keys,
    require_keys_after_upsert,
    run_checks,
)
from tidewright.operators.removals import removed
from tidewright.operators.reports import changed_tables, table_row_counts
from tidewright.operators.sizing import broadcast_if_small
from tidewright.operators.timed import rows_in_cycle, table_in_cycle
from tidewright.plans.checks import checks_from_files, warehouse_checks
from tidewright.plans.warehouse import (
    ACTOR_NAMES,
    BUILDERS,
    STORE_CHAIN,
    TS,
    Builder,
    actor_dim,
    store_dim,
)
from tidewright.sources.dependents import Affected, Dependents
from tidewright.sources.extract import Source, delta, pinned, snapshot
from tidewright.sources.numbers import Numbering
from tidewright.sources.runlog import (
    EXTRACT_LOAD,
    FAILED,
    FULL_LOAD,
    REMOVE,
    STEP,
    TRANSFORM,
    Line,
    RunLog,
)
from tidewright.sources.specs import SOURCES, TARGETS, TableSpec, TargetSpec
from tidewright.sources.zones import Zone

Item = TypeVar("Item")
DELTA_SCOPE, GROUP_SCOPE, STATE_SCOPE = "delta", "group", "state"


class CycleFailed(RuntimeError):
    """Some tables of a step failed; the others were published."""


@dataclass
class Warehouse:
    """Zones below one folder, and the jobs that move rows through them.

    raw       the rows of the current cycle (of the first load: everything)
    stg/src   the current copy of each source table
    stg/delta the rows of the current cycle for each warehouse table
    dw        dimensions and facts, merged by key

    Tables of one step do not depend on each other, so their jobs are submitted from
    `parallel` threads and share the cluster. Each table is published by itself; a table that
    fails keeps its former state, is written to the run log, and fails the step at its end. A
    warehouse table that fails does not hold up the others: the cycle counts as gone through, and
    the next one widens the window of that table alone until it is merged.

    Members that share a name are numbered within a cycle's rows (`qualifier_scope` "delta"), anew in
    each name group that a cycle touched ("group"), or after the highest number of the name, by a
    state that each cycle is merged into ("state").

    With `lookup_index`, the stores that a changed address, city or country touches are found by an
    index that each cycle keeps up to date, and not by reading all stores.
    """

    spark: SparkSession
    root: str
    source: Source
    sources: Sequence[TableSpec] = SOURCES
    targets: Sequence[TargetSpec] = TARGETS
    builders: Mapping[str, Builder] | None = None
    qualifier_scope: str = DELTA_SCOPE
    lookup_index: bool = False
    minutes: int = CYCLE_MINUTES
    lookback: timedelta = timedelta(0)
    parallel: int = 4
    # Versions of a table that stay readable; older segments are removed after a cycle.
    keep: int = 10

    def __post_init__(self) -> None:
        if self.qualifier_scope not in (DELTA_SCOPE, GROUP_SCOPE, STATE_SCOPE):
            raise ValueError(f"unknown qualifier scope {self.qualifier_scope}")
        self.raw = Zone(self.spark, f"{self.root}/raw")
        self.staging = Zone(self.spark, f"{self.root}/stg/src")
        self.deltas = Zone(self.spark, f"{self.root}/stg/delta")
        self.dw = Zone(self.spark, f"{self.root}/dw")
        self.log = RunLog(self.spark, f"{self.root}/_runs")
        self._builders = dict(self.builders or BUILDERS)
        self._numbering = Numbering(
            self.spark, f"{self.root}/stg/numbers/actor_dim", "actor_id", ACTOR_NAMES, TS)
        self._index = Dependents(self.spark, f"{self.root}/stg/index/store_dim", STORE_CHAIN)

    def _by_state(self, spec: TargetSpec) -> bool:
        return self.qualifier_scope == STATE_SCOPE and self._builders[spec.name] is actor_dim

    def _each(
        self, step: str, cycle: Cycle, items: Sequence[Item], work: Callable[[Item], int],
        windows: Mapping[str, Cycle] | None = None,
    ) -> list[tuple[Item, int]]:
        """Does the work on every item. With `windows`, items that fail are owed theirs, and the
        step is closed all the same."""
        run_id = uuid.uuid4().hex
        own = windows or {}

        def one(item: Item) -> Line:
            try:
                return Line(item.name, work(item), cycle=own.get(item.name))
            except Exception as problem:  # noqa: BLE001 - kept in the log, raised below
                return Line(item.name, None, FAILED, str(problem), own.get(item.name))

        with ThreadPoolExecutor(max(1, self.parallel)) as pool:
            lines = list(pool.map(inheritable_thread_target(self.spark)(one), items))
        failed = [x for x in lines if x.status == FAILED]
        if not failed or windows is not None:
            lines.append(Line(STEP, len(items) - len(failed)))
        self.log.add(run_id, step, cycle, lines)
        if failed:
            raise CycleFailed(step + ": " + "; ".join(f"{x.table_name}: {x.message}"
                                                       for x in failed))
        return [(item, line.n) for item, line in zip(items, lines, strict=False)]

    def full_load(self, as_of: datetime) -> None:
        """Copies every source table, builds the warehouse from the copy, and stages it.

        The staged copy is read from the raw one, not from the source again, so both are of
        one moment. A source that lists its base tables has all of them copied; those without a
        stated key are replaced by the next full load, not merged.
        """
        cycle = last_closed_cycle(as_of, self.minutes)
        listed = getattr(self.source, "tables", None)
        known = {spec.name for spec in self.sources}
        others = [TableSpec(n, ()) for n in listed() if n not in known] if callable(listed) else []
        copied = [*self.sources, *others]
        source = pinned(self.source, [spec.name for spec in copied])

        def copy(spec: TableSpec) -> int:
            n = self.raw.table(spec.name, spec.keys).replace(snapshot(source(spec.name)))
            self.staging.table(spec.name, spec.keys, spec.ts).replace(self.raw.read(spec.name))
            return n

        def build(spec: TargetSpec) -> int:
            n = self.dw.table(spec.name, spec.keys, uniques=spec.uniques).replace(
                self._builders[spec.name](self.raw.read, None),
                lambda df: require_keys(df, spec.keys, spec.uniques, spec.name),
            )
            if self._by_state(spec):
                self._numbering.start(self.dw.read(spec.name))
            return n

        self._each(FULL_LOAD + "/copy", cycle, copied, copy)
        if self.lookup_index:
            self._index.start({x.table: self.staging.read(x.table) for x in STORE_CHAIN})
        self._each(FULL_LOAD, cycle, self.targets, build)

    def extract_load(self, cycle: Cycle) -> DataFrame:
        """Replaces raw by the cycle's rows and merges those that changed into staging.

        Returns the changed tables with merge key and row count.
        """
        reach = cycle.reach_back(self.lookback)
        source = pinned(self.source, [spec.name for spec in self.sources])

        def extract(spec: TableSpec) -> int:
            rows = delta(source(spec.name), spec.ts, reach).hint("rebalance")
            return self.raw.table(spec.name, spec.keys).replace(rows)

        counted = self._each(EXTRACT_LOAD + "/raw", cycle, self.sources, extract)
        changed = [spec for spec, n in counted if n > 0]
        indexed = {x.table for x in STORE_CHAIN} if self.lookup_index else set()
        if indexed and not self._index.started():
            self._index.start({name: self.staging.read(name) for name in indexed})

        def load(spec: TableSpec) -> int:
            rows = self.raw.read(spec.name)
            if spec.name in indexed:
                # Before the rows show, so that no transform meets rows the index does not know.
                self._index.apply(spec.name, rows)
            return self.staging.table(spec.name, spec.keys, spec.ts).upsert(rows)

        self._each(EXTRACT_LOAD, cycle, changed, load)
        return changed_tables({s.name: (self.raw.read(s.name), s.keys) for s in self.sources})

    def transform(self, cycle: Cycle | None = None) -> None:
        """Builds each warehouse table's delta from staging, checks its keys, and merges it.

        Without a cycle it takes up the one that was extracted last.
        """
        cycle = cycle or self.log.last_cycle(EXTRACT_LOAD)
        if cycle is None:
            raise ValueError("no cycle was extracted yet")
        owed = self.log.owed([spec.name for spec in self.targets])
        self._merge(cycle, self.targets, owed)

    def _merge(
        self, cycle: Cycle, targets: Sequence[TargetSpec], owed: Mapping[str, Cycle]
    ) -> None:
        windows = {
            name: Cycle(min(late.start, cycle.start), max(late.upto, cycle.upto))
            for name, late in owed.items()
        }

        def merge(spec: TargetSpec) -> int:
            delta_table = self.deltas.table(spec.name, spec.keys)
            reach = windows.get(spec.name, cycle).reach_back(self.lookback)
            delta_table.replace(self._delta(spec, reach).hint("rebalance"))
            # The table checks its unique keys itself, in the segments that may hold a new value.
            n = self.dw.table(spec.name, spec.keys, uniques=spec.uniques).upsert(
                delta_table.read(),
                lambda merged, rows: require_keys_after_upsert(
                    merged, rows, spec.keys, name=spec.name
                ),
            )
            if self._by_state(spec):
                self._numbering.settled()
            return n

        self._each(TRANSFORM, cycle, targets, merge, windows)

    def _delta(self, spec: TargetSpec, cycle: Cycle) -> DataFrame:
        builder = self._builders[spec.name]
        if builder is actor_dim and self.qualifier_scope == GROUP_SCOPE:
            return actor_dim(self.staging, cycle, self.dw.read(spec.name))
        if self._by_state(spec):
            if not self._numbering.started():
                self._numbering.start(self.dw.read(spec.name))
            self._numbering.apply(rows_in_cycle(table_in_cycle(self.staging, "actor", cycle), TS, cycle))
            return self._numbering.pending()
        if builder is store_dim and self.lookup_index and self._index.started():
            return store_dim(Affected(self.staging, self._index, "country", TS, cycle), cycle)
        return builder(self.staging, cycle)

    def run_cycle(self, cycle: Cycle) -> DataFrame:
        """One whole cycle. Running it again leaves the warehouse as it is."""
        changed = self.extract_load(cycle)
        try:
            self.transform(cycle)
        finally:
            self.vacuum()
        return changed

    def remove_gone(self, as_of: datetime) -> DataFrame:
        """Removes what the source no longer has from the staged copies and the warehouse.

        Deltas never show a removed row, so this compares keys, by checksums of their ranges. The keys
        that went are published first: a run that fails half way is repeated with the same effect.
        Returns source tables with the number of rows that went. Rows of a warehouse table go with
        the source rows they follow (`TargetSpec.follows`); members that stay keep their numbers.
        """
        cycle = last_closed_cycle(as_of, self.minutes)
        source = pinned(self.source, [spec.name for spec in self.sources])
        gone_zone = Zone(self.spark, f"{self.root}/stg/gone")

        def find(spec: TableSpec) -> int:
            lost = removed(snapshot(source(spec.name)), self.staging.read(spec.name), spec.keys)
            fresh, table = lost.select(*spec.keys), gone_zone.table(spec.name)
            if table.exists():
                # What an unfinished run found is still to be taken, unless it came back.
                owed = table.read().union(fresh).distinct()
                fresh = removed(snapshot(source(spec.name)), owed, spec.keys)
            return table.replace(fresh)

        found = self._each(REMOVE + "/find", cycle, self.sources, find)
        lost = [spec for spec, n in found if n]

        def follow(spec: TargetSpec) -> int:
            table, n = self.dw.table(spec.name, spec.keys, uniques=spec.uniques), 0
            for name, columns in spec.follows:
                if any(s.name == name for s in lost):
                    keys = gone_zone.read(name).select(*columns)
                    if set(columns) != set(spec.keys):
                        keys = table.read().join(broadcast_if_small(keys), list(columns), "left_semi")
                    n += table.remove(keys.select(*spec.keys))
                    if self._by_state(spec) and self._numbering.started():
                        # Who is left alone under a name loses the number.
                        self._numbering.apply(table.read().limit(0), keys)
                        table.upsert(self._numbering.pending())
                        self._numbering.settled()
            return n

        self._each(REMOVE + "/warehouse", cycle, [t for t in self.targets if t.follows], follow)

        def forget(spec: TableSpec) -> int:
            n = self.staging.table(spec.name, spec.keys, spec.ts).remove(gone_zone.read(spec.name))
            gone_zone.table(spec.name).replace(gone_zone.read(spec.name).limit(0))
            return n

        counted = self._each(REMOVE, cycle, lost, forget)
        return self.spark.createDataFrame(
            sorted((spec.name, n) for spec, n in counted), "table_name string, n bigint")

    def pending(self, as_of: datetime) -> list[Cycle]:
        """Closed cycles after the last one completed, oldest first."""
        last = self.log.done_upto(TRANSFORM, FULL_LOAD)
        newest = last_closed_cycle(as_of, self.minutes)
        if last is None:
            return [newest]
        step = timedelta(minutes=self.minutes)
        missed, start = [], floor_time(last, self.minutes)
        while start + step <= newest.upto:
            missed.append(Cycle(start, start + step))
            start += step
        return missed

    def catch_up(self, as_of: datetime) -> Cycle | None:
        """Runs everything that is pending as one cycle.

        Source tables hold one version of a row, so one wide window brings the same rows as
        its parts would one after the other. With nothing pending, tables that are owed a
        window are tried again.
        """
        missed = self.pending(as_of)
        if not missed:
            return self.retry()
        cycle = Cycle(missed[0].start, missed[-1].upto)
        self.run_cycle(cycle)
        return cycle

    def retry(self) -> Cycle | None:
        """Merges only the tables whose last merge failed, over the windows they lack."""
        owed = self.log.owed([spec.name for spec in self.targets])
        if not owed:
            return None
        cycle = Cycle(min(c.start for c in owed.values()), max(c.upto for c in owed.values()))
        self._merge(cycle, [spec for spec in self.targets if spec.name in owed], owed)
        return cycle

    def run_checks(
        self,
        as_of: datetime,
        checks: Sequence[Check] | None = None,
        folder: str | None = None,
    ) -> CheckReport:
        """Runs the checks and keeps the samples of those that found rows.

        With a folder, the checks are its SQL files, over the tables of the warehouse.
        """
        if folder is not None:
            checks = checks_from_files(self.spark, folder, self.dw.read, self.dw.tables(), as_of)
        elif checks is None:
            checks = warehouse_checks(self.dw.read, as_of)
        report = run_checks(self.spark, checks)
        Zone(self.spark, f"{self.root}/checks").table("samples").replace(report.samples)
        return report

    def status(self, zone: Zone) -> DataFrame:
        """Row counts of a zone's tables."""
        return table_row_counts({name: zone.read(name) for name in zone.tables()})

    def vacuum(self, keep: int | None = None) -> None:
        """Removes segments that only versions before the last `keep` name."""
        for zone in (self.raw, self.staging, self.deltas, self.dw):
            for name in zone.tables():
                zone.table(name).vacuum(self.keep if keep is None else keep)
