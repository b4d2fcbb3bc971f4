"""Half-open cycle windows `[start, upto)` and the predicates built from them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CYCLE_MINUTES = 10


@dataclass(frozen=True)
class Cycle:
    """One load window: `start` belongs to it, `upto` does not. Wall-clock times."""

    start: datetime
    upto: datetime

    def __post_init__(self) -> None:
        if self.start.tzinfo or self.upto.tzinfo:
            raise ValueError("cycle bounds are wall-clock times without a zone")
        if self.start >= self.upto:
            raise ValueError(f"empty cycle: {self.start} .. {self.upto}")

    @classmethod
    def of(cls, start: str, upto: str) -> Cycle:
        return cls(datetime.fromisoformat(start), datetime.fromisoformat(upto))

    def reach_back(self, lookback: timedelta) -> Cycle:
        return Cycle(self.start - lookback, self.upto)


def last_closed_cycle(as_of: datetime, minutes: int = CYCLE_MINUTES) -> Cycle:
    """The newest window that had ended at `as_of`."""
    upto = floor_time(as_of, minutes)
    return Cycle(upto - timedelta(minutes=minutes), upto)


def floor_time(moment: datetime, minutes: int = CYCLE_MINUTES) -> datetime:
    _check_minutes(minutes)
    return moment.replace(minute=moment.minute - moment.minute % minutes, second=0, microsecond=0)


def _check_minutes(minutes: int) -> None:
    if not 1 <= minutes <= 60 or 60 % minutes:
        raise ValueError("the cycle length must divide an hour")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(moment: datetime) -> Column:
    """A typed literal, so a comparison with a timestamp column reaches the parquet scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def in_cycle(ts: Column | str, cycle: Cycle) -> Column:
    """Lower bound in, upper bound out; NULL is not in any cycle."""
    return (_col(ts) >= instant(cycle.start)) & (_col(ts) < instant(cycle.upto))


def not_in_cycle(ts: Column | str, cycle: Cycle) -> Column:
    """The exact complement of `in_cycle`: true where that is false or NULL."""
    return _col(ts).isNull() | (_col(ts) < instant(cycle.start)) | (_col(ts) >= instant(cycle.upto))


def any_in_cycle(columns: Iterable[Column | str], cycle: Cycle) -> Column:
    return reduce(lambda a, b: a | b, [in_cycle(c, cycle) for c in columns])


def newest(columns: Iterable[Column | str]) -> Column:
    """The latest of the given times; NULLs are skipped."""
    found = [_col(c) for c in columns]
    return F.greatest(*found) if len(found) > 1 else found[0]


def floor_to_cycle(ts: Column | str, minutes: int = CYCLE_MINUTES) -> Column:
    """Wall-clock floor of a time column.

    Plain minute arithmetic on the clock reading: no zone enters, and no text is formatted.
    """
    _check_minutes(minutes)
    t = _col(ts).cast("timestamp_ntz")
    past = F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(t) % F.lit(minutes), F.date_part(F.lit("SECOND"), t)
    )
    return t - past


def shift(ts: Column | str, by: timedelta) -> Column:
    return _col(ts) + F.lit(by)
