import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from helpers import bag

from tidewright.operators.reports import cycle_counts
from tidewright.sources.zones import ZoneTable
from tidewright.streaming.counts import counts_table, cycle_counts_stream
from tidewright.streaming.newest import newest_stream

SCHEMA = "k long, t timestamp_ntz, n int, v string"


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


class Arrivals:
    """A folder that files arrive in, and a table that a stream of them is merged into."""

    def __init__(self, spark, folder, rows, schema=SCHEMA, order=("t", "n"), delay=None):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.order, self.delay, self.counts, self.files = list(order), delay, [], 0
        self.table = ZoneTable(spark, f"{folder}/t", ["k"])
        self.table.replace(spark.createDataFrame(rows, schema))

    def bring(self, rows):
        self.files += 1
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(
            f"{self.folder}/in/{self.files}")
        stream = self.spark.readStream.schema(self.schema).parquet(f"{self.folder}/in/*")
        query = newest_stream(stream, self.table, self.order, f"{self.folder}/checkpoint", "merge",
                              delay=self.delay, told=self.counts.append)
        query.awaitTermination()
        return query


def test_random_arrivals_equal_the_newest_of_all(spark, folder):
    rng = random.Random(7)

    def some(n):
        return [(rng.randrange(12), None if rng.random() < 0.1 else day(rng.randrange(20)),
                 rng.choice([None, -3, 0, 5]), f"v{rng.random()}") for _ in range(n)]

    def rank(row):
        return (row[1] is not None, row[1] or 0, row[2] is not None, row[2] or 0)

    newest = {}
    stored = {r[0]: r for r in some(6)}
    newest.update(stored)
    arrivals = Arrivals(spark, folder, list(stored.values()))
    for _ in range(4):
        rows = list({(r[0], *rank(r)): r for r in some(15)}.values())
        for r in rows:
            if r[0] not in newest or rank(r) > rank(newest[r[0]]):
                newest[r[0]] = r
        arrivals.bring(rows)
        assert bag(arrivals.table.read()) == Counter(newest.values())


def test_late_rows_are_counted_and_looked_up(spark, folder, monkeypatch):
    arrivals = Arrivals(spark, folder, [(1, day(10), 0, "stored")])
    looked = []
    matching = ZoneTable.matching
    monkeypatch.setattr(ZoneTable, "matching", lambda self, keys: looked.append(1) or matching(self, keys))
    arrivals.bring([(1, day(12), 0, "a"), (2, day(11), 0, "b"), (2, day(11), 1, "c"), (None, day(1), 0, "n")])
    arrivals.bring([(1, day(11), 0, "older"), (2, day(11), 0, "older")])
    # Neither new keys nor newer or older versions of known ones make a batch look into the table.
    assert not looked
    assert [(c.rows, c.late) for c in arrivals.counts] == [(3, 0), (0, 0)]
    arrivals.bring([(3, day(5), 0, "first of its key")])
    assert looked and arrivals.counts[-1].late == 1
    assert bag(arrivals.table.read(), "k", "v") == Counter(
        [(1, "a"), (2, "c"), (3, "first of its key"), (None, "n")])


def test_a_late_version_does_not_hide_a_newer_stored_one(spark, folder):
    arrivals = Arrivals(spark, folder, [(1, day(10), 0, "stored")])
    arrivals.bring([(1, day(5), 0, "late")])
    arrivals.bring([(1, day(7), 0, "late, but later")])
    assert bag(arrivals.table.read(), "v") == Counter([("stored",)])
    assert [c.late for c in arrivals.counts] == [1, 1]


def test_a_delay_drops_state_and_counts_rows_behind_it(spark, folder):
    arrivals = Arrivals(spark, folder, [], delay="2 days")
    query = arrivals.bring([(k, day(k), 0, "a") for k in range(10)])
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress]
    # The watermark lies at day 7; states before it went, in the batch that follows.
    assert max(held) == 10 and held[-1] == 3
    query = arrivals.bring([(1, day(3), 0, "behind"), (1, day(8), 0, "newer"), (9, day(8), 0, "older")])
    dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert dropped == 0, "the newest of each key and Arrow batch goes on, and that is none behind"
    query = arrivals.bring([(2, day(3), 0, "behind")])
    assert sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress) == 1
    found = {r.k: (r.t, r.v) for r in arrivals.table.read().collect()}
    assert found[1] == (day(8), "newer") and found[2] == (day(2), "a") and found[9] == (day(9), "a")


def test_values_of_all_types_arrive_as_they_left(spark, folder):
    schema = ("k string, t timestamp, d date, x double, m decimal(20,4), i long, b binary, "
              "l array<int>, s struct<a:int,b:timestamp_ntz>, p map<string,double>, text string")
    row = ("é", datetime(2024, 3, 1, 1, 2, 3, 456789), date(2024, 1, 1), float("inf"), Decimal("1234567890123456.7891"),
           (1 << 62) + 1, bytearray(b"\x00\xff"), [1, None], (None, datetime(2024, 1, 1, 0, 0, 0, 1)),
           {"a": -0.5}, 'tab\t"quote"\n ')
    nulls = ("n", datetime(2024, 3, 1), *[None] * 9)
    arrivals = Arrivals(spark, folder, [], schema, order=["t", "d", "text"])
    arrivals.bring([row, nulls])
    assert sorted(map(tuple, arrivals.table.read().collect()), key=lambda r: r[0]) == [nulls, row]


def test_refuses_what_it_cannot_order(spark, folder):
    table = ZoneTable(spark, f"{folder}/t", ["k"])
    table.replace(spark.createDataFrame([], "k int, t timestamp_ntz, x double"))
    stream = spark.readStream.schema("k int, t timestamp_ntz, x double").parquet(folder)
    with pytest.raises(TypeError):
        newest_stream(stream, table, ["t", "x"], f"{folder}/c", "merge")
    with pytest.raises(TypeError):
        newest_stream(stream, table, ["k"], f"{folder}/c", "merge")
    with pytest.raises(ValueError):
        newest_stream(stream.withColumn("__a", stream.k), table, ["t"], f"{folder}/c", "merge")


@pytest.mark.parametrize("delay", [None, "1 hour"])
def test_cycle_counts_of_a_stream(spark, folder, delay):
    table = counts_table(spark, f"{folder}/counts")
    schema = "ts timestamp_ntz"

    def bring(name, *times):
        spark.createDataFrame([(t and datetime.fromisoformat(t),) for t in times], schema).coalesce(1) \
            .write.parquet(f"{folder}/in/{name}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in/*")
        query = cycle_counts_stream(stream, "ts", table, f"{folder}/checkpoint", "counts", delay=delay)
        query.awaitTermination()
        return query

    def counts():
        return {str(r.cycle_upto)[5:16]: r.n for r in table.read().collect()}

    bring("a", "2024-03-31 02:29:59.999999", "2024-03-31 02:30:00", None, "2024-03-31 02:39:00")
    assert counts() == {"03-31 02:30": 1, "03-31 02:40": 2}
    bring("b", "2024-03-31 02:31:00", "2024-03-31 06:00:00", "1969-12-31 23:59:00")
    early = {} if delay else {"01-01 00:00": 1}
    assert {k: v for k, v in counts().items() if k != "01-01 00:00"} == {
        "03-31 02:30": 1, "03-31 02:40": 3, "03-31 06:10": 1}
    query = bring("c", "2024-03-31 02:35:00", "2024-03-31 05:30:00")
    dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert dropped == (1 if delay else 0)
    found = counts()
    assert found["03-31 02:40"] == (3 if delay else 4) and found["03-31 05:40"] == 1
    assert early.items() <= found.items()
    # The same cycles as a batch finds, where nothing is dropped.
    if not delay:
        every = spark.read.schema(schema).parquet(f"{folder}/in/*").dropna()
        assert bag(table.read()) == bag(cycle_counts(every, "ts"))
