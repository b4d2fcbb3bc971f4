"""A stream merged by key into a zone table, with the newest version of each key held as state.

Spark's state store holds, per key, the order of the newest version that the stream brought. A
micro-batch is settled by that, so it reads no rows of the table. What beats the state is newest if
it is later than all the table held when the stream began; only an earlier row (a late one) is
looked up in the table as well. No row is lost, and the result is that of `upserts.upsert_stream`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tidewright.operators.change import newest_per_key
from tidewright.operators.skew import any_null
from tidewright.sources.files import Folder
from tidewright.sources.zones import ZoneTable

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Rows travel through the state as text, so that no type is bent on the way through Python.
_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_HORIZON = "horizon.txt"
# Before every time.
_NEVER = -(1 << 62)


@dataclass(frozen=True)
class BatchCounts:
    """Rows of a micro-batch that beat what was known of their key, and how many of them were late."""

    number: int
    rows: int
    late: int


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a time; one without a zone counts as UTC, so that no clock change reorders it."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(ts)
    days = F.datediff(F.col(ts).cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint")
    rest = (F.extract(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("bigint")
    return (days * 86_400 + seconds) * 1_000_000 + rest


def millis(df: DataFrame, ts: str) -> Column:
    """Milliseconds of a time, floored."""
    micros = _micros(df, ts)
    return ((micros - F.pmod(micros, F.lit(1000))) / F.lit(1000)).cast("bigint")


def _rank(df: DataFrame, order: Sequence[str]) -> Column:
    """A text that sorts as the order columns do, missing values first."""

    def part(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            # The end sorts before every digit, so no text runs into the next column.
            value = F.concat(F.hex(F.encode(F.col(f"`{name}`"), "UTF-8")), F.lit("."))
        else:
            if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                number = _micros(df, name)
            elif isinstance(kind, T.DateType):
                number = F.unix_date(name)
            elif isinstance(kind, _WHOLE):
                number = F.col(f"`{name}`")
            else:
                raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
            shifted = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
            value = F.lpad(shifted.cast("string"), 20, "0")
        return F.coalesce(F.concat(F.lit("1"), value), F.lit("0"))

    return F.concat(*[part(c) for c in order])


def _settle(horizon: int, forget: bool) -> Callable:
    """The step of one key, defined here so that it reaches executors by value, without this package."""
    never = _NEVER

    def wait(state, ms: int) -> None:
        """The state is due once the watermark has passed its time; set anew with every call."""
        if forget:
            state.setTimeoutTimestamp(max(ms, state.getCurrentWatermarkMs()) + 1)

    def settle(key, frames, state):
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        best = None
        for frame in frames:
            top = frame.loc[frame["__rank"].idxmax()]
            if best is None or top["__rank"] > best["__rank"]:
                best = top
        rank, ms = best["__rank"], int(best["__ms"])
        known = state.get[0] if state.exists else None
        if known is not None and rank <= known:
            wait(state, state.get[1])
            return
        # A state below the horizon does not tell what the table holds.
        late = ms < horizon
        if ms != never:
            state.update((rank, ms))
            wait(state, ms)
        yield pd.DataFrame({"__row": [best["__row"]], "__late": [late]})

    return settle


def _thinned(keys: Sequence[str]) -> Callable:
    """Keeps the newest row per key of each Arrow batch, so that a hot key moves few rows."""
    keys = list(keys)

    def thin(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch]).sort_by([(c, "ascending") for c in (*keys, "__rank")])
            columns = [rows.column(k).combine_chunks() for k in keys]
            ends = [pc.not_equal(c.slice(0, len(c) - 1), c.slice(1)) for c in columns]
            last = pa.concat_arrays([reduce(pc.or_, ends), pa.array([True])])
            yield from rows.filter(last).to_batches()

    return thin


def _horizon(stream: DataFrame, table: ZoneTable, ts: str, checkpoint: str) -> int:
    """The first millisecond after all the table held when the query first started; a restart keeps it."""
    folder = Folder(stream.sparkSession, checkpoint)
    if _HORIZON not in folder.names():
        stored = table.read()
        newest = stored.agg(F.max(millis(stored, ts))).first()[0]
        folder.create_text(_HORIZON, str(_NEVER if newest is None else newest + 1))
    return int(folder.read_text(_HORIZON))


def newest_stream(
    stream: DataFrame,
    table: ZoneTable,
    order: Sequence[str],
    checkpoint: str,
    name: str,
    delay: str | None = None,
    every: str | None = None,
    told: Callable[[BatchCounts], None] | None = None,
) -> StreamingQuery:
    """Merges each micro-batch into `table`; of the versions of a row the last by `order` stays.

    `order` has times, dates, whole numbers and texts, a time first. Rows that tie with what is known
    are dropped. A row with a NULL in its key equals no other and is appended; a NULL time is the
    earliest. An empty micro-batch publishes nothing but its number.

    The state grows with the keys that the stream brings. With `delay` (such as "2 days") a key's state
    goes once the watermark, which lags by so much, has passed it, and Spark drops and counts rows
    behind the watermark (`numRowsDroppedByWatermark` of the query's progress).

    While the query lives, nothing else may bring newer rows into the table. The batch number is
    published with the rows, so a batch that runs again is skipped. `told` gets the counts of each
    micro-batch. Columns that begin with two underscores are refused.
    """
    keys, columns = list(table.keys), stream.columns
    if any(c.startswith("__") for c in columns):
        raise ValueError("columns that begin with two underscores are taken")
    if not isinstance(stream.schema[order[0]].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{order[0]} is no time")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {**_TEXT, "ignoreNullFields": "false"})
    marked = stream.select(
        *[F.col(f"`{c}`") for c in keys], _rank(stream, order).alias("__rank"),
        F.coalesce(millis(stream, order[0]), F.lit(_NEVER)).alias("__ms"), row.alias("__row"))
    keyed = marked.dropna(subset=keys)
    keyed = keyed.mapInArrow(_thinned(keys), keyed.schema)
    if delay:
        # Times without a zone cannot bear a watermark, instants can.
        instant = F.when(F.col("__ms") != _NEVER, F.timestamp_millis("__ms"))
        keyed = keyed.withColumn("__at", instant).withWatermark("__at", delay)
    settled = keyed.groupBy(*keys).applyInPandasWithState(
        _settle(_horizon(stream, table, order[0], checkpoint), bool(delay)),
        "__row string, __late boolean", "rank string, ms bigint", "update",
        GroupStateTimeout.EventTimeTimeout if delay else GroupStateTimeout.NoTimeout)
    unkeyed = marked.where(any_null(keys)).select("__row", F.lit(False).alias("__late"))
    told_apart = settled.unionByName(unkeyed)

    def publish(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            r = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if("__late").alias("late")).first()

            def rows(which: Column) -> DataFrame:
                read = F.from_json("__row", stream.schema, {**_TEXT, "mode": "FAILFAST"})
                return batch.where(which).select(read.alias("__row")).select("__row.*")

            newest = rows(~F.col("__late"))
            if r["late"]:
                newest = newest.unionByName(_looked_up(rows(F.col("__late")), table, order))
            table.upsert(newest, batch=(name, number))
        finally:
            batch.unpersist()
        table.vacuum()
        if told:
            told(BatchCounts(number, r["n"], r["late"]))

    writer = told_apart.writeStream.outputMode("update").foreachBatch(publish).queryName(name) \
        .option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def _looked_up(late: DataFrame, table: ZoneTable, order: Sequence[str]) -> DataFrame:
    """The late rows that are newer than the stored version of their key; equal ones are none."""
    fresh = late.withColumn("__stored", F.lit(False))
    stored = table.matching(late).select(*late.columns).withColumn("__stored", F.lit(True))
    both = newest_per_key(fresh.unionByName(stored), table.keys, [*order, "__stored"])
    return both.where(~F.col("__stored")).select(*late.columns)
