"""What each cycle did, kept as an append-only table."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle
from tidewright.sources.files import Folder

DONE, FAILED = "done", "failed"
EXTRACT_LOAD, TRANSFORM, FULL_LOAD, REMOVE = "extract_load", "transform", "full_load", "remove"
SCHEMA = (
    "run_id string, step string, table_name string, n bigint, status string, message string, "
    "cycle_from timestamp_ntz, cycle_upto timestamp_ntz, logged_at timestamp_ntz, day string"
)
# The name of the line that closes a step.
STEP = "*"


@dataclass(frozen=True)
class Line:
    table_name: str
    n: int | None
    status: str = DONE
    message: str | None = None
    # The window of this table, if it is not that of the step.
    cycle: Cycle | None = None


def _completed(lines: DataFrame, *steps: str) -> DataFrame:
    whole = (F.col("table_name") == STEP) & (F.col("status") == DONE)
    return lines.where(F.col("step").isin(*steps) & whole)


class RunLog:
    """One small file per step, in a folder per day of the cycle; it appears whole."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def add(self, run_id: str, step: str, cycle: Cycle, lines: Sequence[Line]) -> None:
        now = datetime.now()
        common = {"run_id": run_id, "step": step, "logged_at": now.isoformat()}

        def text_of(line: Line) -> str:
            of = line.cycle or cycle
            fields = {k: v for k, v in vars(line).items() if k != "cycle"}
            bounds = {"cycle_from": of.start.isoformat(), "cycle_upto": of.upto.isoformat()}
            return json.dumps({**common, **fields, **bounds})

        text = "\n".join(map(text_of, lines))
        # Names of a step's files sort by the time they were logged at.
        name = f"{step.replace('/', '-')}-{now:%Y%m%dT%H%M%S%f}-{run_id}.json"
        Folder(self.spark, f"{self.path}/day={cycle.upto.date()}").create_text(name, text)

    def read(self) -> DataFrame:
        if not Folder(self.spark, self.path).names():
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(self.path)

    def _by_day(self) -> Iterator[DataFrame]:
        """The lines of one day of cycles after the other, newest first; only days asked for are read."""
        days = [n for n in Folder(self.spark, self.path).names() if n.startswith("day=")]
        for day in sorted(days, reverse=True):
            yield self.spark.read.schema(SCHEMA).json(f"{self.path}/{day}")

    def done_upto(self, *steps: str) -> datetime | None:
        """The end of the newest cycle that one of the steps (by default the transform) closed."""
        for lines in self._by_day():
            closed = _completed(lines, *(steps or (TRANSFORM,)))
            upto = closed.agg(F.max("cycle_upto").alias("upto")).first()["upto"]
            if upto:
                return upto
        return None

    def owed(self, tables: Sequence[str]) -> dict[str, Cycle]:
        """The window that each of the tables still lacks, for those whose newest merge failed.

        A later attempt covers what earlier ones lacked, so the newest line of a table tells all.
        """
        wanted, found = set(tables), {}
        merged = (F.col("step") == TRANSFORM) | (
            (F.col("step") == FULL_LOAD) & (F.col("status") == DONE))
        order = F.struct("cycle_upto", "logged_at")
        last = F.max_by(F.struct("status", "cycle_from", "cycle_upto"), order).alias("last")
        for lines in self._by_day():
            if not wanted:
                break
            of_tables = lines.where(merged & F.col("table_name").isin(list(wanted)))
            for name, line in of_tables.groupBy("table_name").agg(last).collect():
                wanted.discard(name)
                if line["status"] == FAILED:
                    found[name] = Cycle(line["cycle_from"], line["cycle_upto"])
        return found

    def last_cycle(self, step: str) -> Cycle | None:
        """The cycle whose step was completed last, whichever day it covers."""
        days = [n for n in Folder(self.spark, self.path).names() if n.startswith("day=")]
        of_step = [(name, day) for day in days
                   for name in Folder(self.spark, f"{self.path}/{day}").names()
                   if name.startswith(f"{step.replace('/', '-')}-")]
        # From the newest file back to one that closes the step; older ones are not opened.
        for name, day in sorted(of_step, reverse=True):
            text = Folder(self.spark, f"{self.path}/{day}").read_text(name)
            for line in map(json.loads, text.splitlines()):
                if (line["step"], line["table_name"], line["status"]) == (step, STEP, DONE):
                    return Cycle.of(line["cycle_from"], line["cycle_upto"])
        return None
