"""Key constraints as jobs, and checks that pass when they return no rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.windows import instant, shift
from tidewright.operators.sizing import BROADCAST_BYTES, are_small
from tidewright.operators.skew import any_null, hot_keys, spread_join
from tidewright.session import checkpointed

SAMPLE_ROWS = 3
WARNING, ERROR = "warning", "error"
SUMMARY_SCHEMA = "check_name string, severity string, n bigint, status string, message string"
SAMPLE_SCHEMA = "check_name string, severity string, row string"


class ConstraintViolation(ValueError):
    """Rows that break a key of the table they were to be published in."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number; counted map-side first."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(any_null(keys))


def duplicate_uniques(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As `duplicate_keys`; rows with a NULL in the columns never collide."""
    return duplicate_keys(df.dropna(subset=list(columns)), columns)


def refuse(found: DataFrame, what: str) -> None:
    sample = found.limit(SAMPLE_ROWS).collect()
    if sample:
        raise ConstraintViolation(f"{what}: " + "; ".join(str(r.asDict()) for r in sample))


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their number of rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") > 1) | any_null(keys))


def require_keys(
    df: DataFrame, keys: Sequence[str], uniques: Sequence[Sequence[str]] = (), name: str = "table"
) -> None:
    """Refuses a whole table that breaks its primary key or one of its unique keys."""
    refuse(primary_key_violations(df, keys), f"{name}: duplicate or NULL primary key")
    for columns in uniques:
        found = duplicate_uniques(df.select(*columns), columns)
        refuse(found, f"{name}: duplicate {list(columns)}")


def require_keys_after_upsert(
    merged: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    uniques: Sequence[Sequence[str]] = (),
    name: str = "table",
) -> None:
    """The same verdict for a table that kept its keys before `delta` was merged into it.

    A primary key can then only break inside the delta. A unique key can only break at a value
    the delta holds, so the merged table is reduced to those values before it is counted; if
    they do not fit a broadcast, all of its values are counted. Zone tables check their unique keys
    themselves, as they know which segments may hold a value.
    """
    refuse(primary_key_violations(delta, keys), f"{name}: duplicate or NULL primary key")
    for columns in uniques:
        at_risk = merged.select(*columns)
        values = delta.select(*columns).dropna()
        if are_small(values):
            at_risk = at_risk.join(F.broadcast(values), list(columns), "left_semi")
        refuse(duplicate_uniques(at_risk, columns), f"{name}: duplicate {list(columns)}")


def orphans(
    rows: DataFrame, parents: DataFrame, on: Sequence[str], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows without a parent; a NULL in the key has none.

    The distinct keys (combined map-side, so a key with a third of the rows is one row per
    task) are checked against the parents first, and the missing ones kept. The rows themselves
    only meet those, which fit a broadcast unless the tables are badly out of step. Beyond that, rows
    of hot keys are dealt out, and those with a NULL meet nothing.
    """
    on = list(on)
    missing = checkpointed(
        rows.select(*on).distinct().join(
            parents.select(*on).dropna().distinct(), on, "left_anti"
        )
    )
    if not are_small(missing, limit=limit):
        keyed = rows.dropna(subset=on)
        met = spread_join(keyed, missing.dropna(), on, "left_semi", hot_keys(keyed.select(*on), on))
        return met.select(*rows.columns).union(rows.where(any_null(on)))
    missing = F.broadcast(missing.toDF(*[f"__m{i}" for i in range(len(on))]))
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__m{i}")) for i, k in enumerate(on)]
    )
    return rows.join(missing, same, "left_semi")


def childless_since(
    rows: DataFrame,
    children: DataFrame,
    on: Sequence[str],
    ts: str,
    age: timedelta,
    as_of: datetime,
) -> DataFrame:
    """Rows without a child that were last changed more than `age` before `as_of`.

    The age filter runs before the join, and the children are made distinct map-side. Rows of hot
    keys and rows with a NULL in theirs are dealt out.
    """
    on = list(on)
    old = rows.where(shift(ts, age) < instant(as_of))
    of_children = children.select(*on).dropna().distinct()
    return spread_join(old, of_children, on, "left_anti", hot_keys(old.select(*on), on)) \
        .select(*rows.columns)


@dataclass(frozen=True)
class Check:
    """A named query that should return nothing. `order` makes its sample repeatable."""

    name: str
    severity: str
    query: Callable[[], DataFrame]
    order: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.severity not in (WARNING, ERROR):
            raise ValueError(f"unknown severity {self.severity}")


def in_run_order(checks: Sequence[Check]) -> list[Check]:
    """Warnings first, then errors, each by name."""
    return sorted(checks, key=lambda c: (c.severity != WARNING, c.name))


def check_counts(checks: Sequence[Check]) -> DataFrame:
    """The number of rows each check returns, as one lazy frame."""
    counts = [
        c.query().agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "n"
        )
        for c in in_run_order(checks)
    ]
    return reduce(DataFrame.union, counts)


def check_verdicts(checks: Sequence[Check]) -> DataFrame:
    """`check_counts` with the status of each check and whether it fails the run."""
    found = F.col("n") > 0
    return check_counts(checks).select(
        "*",
        F.when(found, "found").otherwise("passed").alias("status"),
        (found & (F.col("severity") == ERROR)).alias("fails_run"),
    )


def _rows_as_json(check: Check, found: DataFrame) -> DataFrame:
    first = sample(found, check.order or tuple(found.columns))
    return first.select(
        F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"),
        F.to_json(F.struct("*")).alias("row"),
    )


def check_samples(checks: Sequence[Check]) -> DataFrame:
    """The first rows of every check that finds any, as one lazy frame."""
    return reduce(DataFrame.union, [_rows_as_json(c, c.query()) for c in in_run_order(checks)])


def sample(df: DataFrame, order: Sequence[str], rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows of a failing check, by a stated order."""
    return df.orderBy(*order).limit(rows)


@dataclass(frozen=True)
class CheckReport:
    summary: DataFrame
    samples: DataFrame
    exit_code: int


def run_checks(spark: SparkSession, checks: Sequence[Check]) -> CheckReport:
    """Runs every check, none cut short by another, and reports on them.

    A check that cannot run is `failed` and counts as an error, whatever its severity says.
    The exit code is 1 when an error check returned rows or any check failed to run.
    """
    lines, kept, exit_code = [], [], 0
    for check in in_run_order(checks):
        try:
            found = check.query()
            n = found.count()
            if n:
                kept += [tuple(r) for r in _rows_as_json(check, found).collect()]
            lines.append((check.name, check.severity, n, "found" if n else "passed", None))
            if n and check.severity == ERROR:
                exit_code = 1
        except Exception as problem:  # noqa: BLE001 - any failure of a check is its result
            lines.append((check.name, check.severity, None, "failed", str(problem)))
            exit_code = 1
    return CheckReport(
        spark.createDataFrame(lines, SUMMARY_SCHEMA),
        spark.createDataFrame(kept, SAMPLE_SCHEMA),
        exit_code,
    )
