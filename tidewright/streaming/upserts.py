"""A stream merged by key into a zone table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.change import newest_per_key
from tidewright.sources.zones import ZoneTable


def upsert_stream(
    stream: DataFrame,
    table: ZoneTable,
    order: Sequence[str],
    checkpoint: str,
    name: str,
    every: str | None = None,
) -> StreamingQuery:
    """Merges each micro-batch into `table`.

    Of the versions of a row in a batch and in the table the last by `order` stays, so batches
    may come out of order. The batch number is published together with the rows, so a batch that
    runs again after a failure is skipped. Segments no longer needed are removed. Without `every` (such
    as "10 minutes") the query takes what is there and ends.

    Only files of the table that may hold a key of the batch are read, and the batch is kept while
    it is looked at.
    """

    def publish(batch: DataFrame, number: int) -> None:
        newest = newest_per_key(batch, table.keys, order).persist()
        try:
            stored = table.matching(newest).select(*batch.columns)
            rows = newest_per_key(newest.unionByName(stored), table.keys, order)
            table.upsert(rows, batch=(name, number))
        finally:
            newest.unpersist()
        table.vacuum()

    writer = stream.writeStream.foreachBatch(publish).queryName(name) \
        .option("checkpointLocation", checkpoint)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()
