"""Rows per cycle of a stream, kept in a zone table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.functions.windows import CYCLE_MINUTES
from tidewright.sources.zones import ZoneTable
from tidewright.streaming.newest import millis

SCHEMA = "cycle_upto timestamp_ntz, n bigint"


def counts_table(spark, path: str) -> ZoneTable:
    """An empty table of counts, or the one that is there."""
    table = ZoneTable(spark, path, ["cycle_upto"])
    if not table.exists():
        table.replace(spark.createDataFrame([], SCHEMA))
    return table


def cycle_counts_stream(
    stream: DataFrame,
    ts: str,
    table: ZoneTable,
    checkpoint: str,
    name: str,
    minutes: int = CYCLE_MINUTES,
    delay: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keeps the number of rows that each cycle over a stream picks up, by the cycle's end.

    The counts are the stream's state, combined map-side; each micro-batch merges those it changed, so a
    batch that runs again changes nothing. Rows without a time are not counted. Cycles are cut by the
    wall clock for times without a zone, by UTC for others. With `delay` a cycle's state goes once the
    watermark, which lags by so much, has passed its end; rows of such cycles are dropped, and counted
    as `numRowsDroppedByWatermark` in the query's progress. Without it all are counted.
    """
    timed = stream.select(F.timestamp_millis(millis(stream, ts)).alias("at"))
    if delay:
        timed = timed.withWatermark("at", delay)
    upto = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.unix_seconds("cycle.end"))
    counts = timed.groupBy(F.window("at", f"{minutes} minutes").alias("cycle")).agg(
        F.count(F.lit(1)).alias("n")).select(upto.alias("cycle_upto"), "n")

    def publish(batch: DataFrame, number: int) -> None:
        table.upsert(batch, batch=(name, number))
        table.vacuum()

    writer = counts.writeStream.outputMode("update").foreachBatch(publish).queryName(name) \
        .option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
