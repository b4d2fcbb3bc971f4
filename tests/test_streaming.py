from collections import Counter

from helpers import bag

from tidewright.sources.zones import ZoneTable
from tidewright.streaming.upserts import upsert_stream

SCHEMA = "k int, t int, v string"


def test_stream_merges_the_newest_of_each_batch(spark, folder):
    table = ZoneTable(spark, f"{folder}/t", ["k"])
    table.replace(spark.createDataFrame([(1, 0, "old"), (5, 0, "kept")], SCHEMA))

    def arrive(name, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{name}")

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in/*")
        query = upsert_stream(stream, table, ["t"], f"{folder}/checkpoint", "merge")
        query.awaitTermination()

    arrive("a", [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "d"), (None, 1, "e")])
    run()
    assert bag(table.read()) == Counter([(1, 3, "c"), (2, 1, "d"), (5, 0, "kept"), (None, 1, "e")])
    segments = table.current().segments
    run()
    assert table.current().segments == segments
    arrive("b", [(2, 9, "z")])
    run()
    assert bag(table.read()) == Counter([(1, 3, "c"), (2, 9, "z"), (5, 0, "kept"), (None, 1, "e")])
    assert table.current().batches == {"merge": 1}
    # A later batch may bring older versions.
    arrive("c", [(2, 4, "late"), (1, 2, "late"), (7, 1, "new")])
    run()
    assert bag(table.read()) == Counter([
        (1, 3, "c"), (2, 9, "z"), (5, 0, "kept"), (7, 1, "new"), (None, 1, "e")])


def test_stream_query_reads_a_directory(spark, folder):
    """The same rows as one file and as a directory of several."""
    import __spark_entry__ as entry

    one = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{one}/events.parquet")
    events.repartition(3, "event_id").write.parquet(f"{folder}/events.parquet")
    run = entry.queries()["stream_upsert"]
    assert bag(run(spark, folder)) == bag(run(spark, one))
