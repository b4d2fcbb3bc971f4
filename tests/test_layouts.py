"""The same results when everything counts as large, hot, and too big to broadcast."""

import pytest
from compare import assert_same, open_tables
from helpers import bag
from test_queries import FOLDER

import __spark_entry__ as entry
from tidewright.operators import builders, change, quality, skew, timed
from tidewright.operators.sizing import UNKNOWN_BYTES, read_bytes
from tidewright.session import checkpointed
from tidewright.sources import sketches, zones
from tidewright.sources.zones import ZoneTable

PREFIXES = ("dim_", "fact_bridge", "upsert_", "delete_", "check_", "cycle_", "zone_", "newest_")
NAMES = [n for n in sorted(entry.queries()) if n.startswith(PREFIXES)]
SETTINGS = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.session.timeZone": "America/New_York",
}


@pytest.fixture
def large_world(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 1)
    monkeypatch.setattr(skew, "PAIRS_PER_TASK", 16)
    for module in (builders, change, quality, timed, zones):
        if hasattr(module, "are_small"):
            monkeypatch.setattr(module, "are_small", lambda *frames, **limit: False)
        if hasattr(module, "broadcast_if_small"):
            monkeypatch.setattr(module, "broadcast_if_small", lambda df, *limit: df)
    for module in (builders, timed):
        monkeypatch.setattr(module, "measured_bytes", lambda *frames: [1 << 60] * len(frames))
    monkeypatch.setattr(zones, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(zones, "INLINE_PLACES", 3)
    monkeypatch.setattr(zones, "FILE_BYTES", 4096)
    monkeypatch.setattr(zones, "SKETCH_ROWS", 1)
    monkeypatch.setattr(sketches, "are_small", lambda *frames, **limit: False)
    before = {name: spark.conf.get(name) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def con():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_large_layout(spark, con, large_world, name):
    assert_same(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])


def test_the_size_of_a_checkpointed_join_is_unknown(spark):
    ids = spark.range(1000)
    few = checkpointed(ids.crossJoin(ids.toDF("other")).where("id = other"))
    assert read_bytes(few) == UNKNOWN_BYTES
    assert read_bytes(ids) < 1 << 20


def test_a_checkpointed_join_is_written_in_few_files(spark, folder, monkeypatch):
    monkeypatch.setattr("tidewright.sources.zones.FILE_BYTES", 1)
    ids = spark.range(100)
    few = checkpointed(ids.crossJoin(ids.toDF("other")).where("id = other"))
    table = ZoneTable(spark, folder, ["id"])
    table.replace(few)
    assert len(table.read().inputFiles()) <= 32 and bag(table.read()) == bag(few)
