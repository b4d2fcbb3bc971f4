from datetime import datetime, timedelta

import pytest
from helpers import at
from pyspark.sql import functions as F

from tidewright.functions.text import report_name
from tidewright.functions.windows import (
    Cycle,
    any_in_cycle,
    floor_to_cycle,
    in_cycle,
    last_closed_cycle,
    newest,
    not_in_cycle,
)

CYCLE = Cycle.of("2024-01-01 00:10:00", "2024-01-01 00:20:00")


@pytest.fixture
def times(spark):
    rows = [
        ("before", at("2024-01-01 00:09:59.999999")),
        ("first", at("2024-01-01 00:10:00")),
        ("last", at("2024-01-01 00:19:59.999999")),
        ("end", at("2024-01-01 00:20:00")),
        ("none", None),
    ]
    return spark.createDataFrame(rows, "name string, ts timestamp_ntz")


def test_bounds(times):
    names = {r.name for r in times.where(in_cycle("ts", CYCLE)).collect()}
    assert names == {"first", "last"}


def test_complement_is_exact(times):
    names = {r.name for r in times.where(not_in_cycle("ts", CYCLE)).collect()}
    assert names == {"before", "end", "none"}


def test_any_of_with_null(times):
    both = times.withColumn("other", F.lit("2024-01-01 00:15:00").cast("timestamp_ntz"))
    assert both.where(any_in_cycle(["ts", "other"], CYCLE)).count() == 5
    assert times.withColumn("other", F.col("ts")).where(
        any_in_cycle(["ts", "other"], CYCLE)).count() == 2


def test_bounds_reach_the_scan(spark, times, folder, capsys):
    times.write.parquet(f"{folder}/t")
    spark.read.parquet(f"{folder}/t").where(in_cycle("ts", CYCLE)).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_newest_skips_null(spark):
    df = spark.createDataFrame(
        [(at("2024-01-01"), None), (None, None), (at("2024-01-01"), at("2024-01-02"))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(newest(["a", "b"])).collect()]
    assert got == [at("2024-01-01"), None, at("2024-01-02")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kathmandu", "Europe/Berlin"])
def test_floor_is_wall_clock(spark, zone):
    # 02:35 on the last day does not exist in Berlin.
    moments = ["2024-01-01 00:09:59.999999", "2024-01-01 00:10:00", "2024-03-31 02:35:17.5"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(m,) for m in moments], "t string")
        floored = df.select(floor_to_cycle(F.col("t").cast("timestamp_ntz")).cast("string"))
        got = [r[0] for r in floored.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2024-01-01 00:00:00", "2024-01-01 00:10:00", "2024-03-31 02:30:00"]


def test_last_closed_cycle():
    cycle = last_closed_cycle(datetime(2024, 5, 1, 12, 34, 56))
    assert (cycle.start, cycle.upto) == (at("2024-05-01 12:20:00"), at("2024-05-01 12:30:00"))
    assert last_closed_cycle(at("2024-05-01 00:00:00")).start == at("2024-04-30 23:50:00")


def test_cycle_refuses_nonsense():
    with pytest.raises(ValueError):
        Cycle.of("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        Cycle(datetime.fromisoformat("2024-01-01T00:00:00+00:00"), datetime(2024, 1, 2))
    with pytest.raises(ValueError):
        last_closed_cycle(at("2024-01-01"), 7)


def test_lookback():
    assert CYCLE.reach_back(timedelta(minutes=5)).start == at("2024-01-01 00:05:00")


def test_report_name_pads_and_cuts(spark):
    got = spark.range(1).select(report_name("film"), report_name("a_very_long_table_name")).first()
    assert tuple(got) == ("film           ", "a_very_long_tab")
