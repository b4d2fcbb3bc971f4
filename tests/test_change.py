from decimal import Decimal
from collections import Counter

import pytest
from helpers import at, bag
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.operators import change
from tidewright.operators.change import (
    aligned,
    append,
    delete_by_key,
    insert_rows,
    newest_per_key,
    update_where,
    upsert,
)
from tidewright.operators.skew import HotKeys

SCHEMA = "k int, j int, v string"
TARGET = [(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d"), (3, None, "e"), (2, 1, "f")]
SOURCE = [(1, 1, "x"), (1, 1, "y"), (None, 1, "z"), (9, 9, "n")]


def model(target, source, width=2):
    gone = {r[:width] for r in source if None not in r[:width]}
    return Counter([r for r in target if r[:width] not in gone] + list(source))


@pytest.mark.parametrize("small", [True, False, None])
def test_upsert_nulls_and_copies(spark, small):
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    assert bag(upsert(t, s, ["k", "j"], small=small)) == model(TARGET, SOURCE)


@pytest.mark.parametrize("small", [True, False])
def test_upsert_single_key(spark, small):
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    assert bag(upsert(t, s, ["k"], small=small)) == model(TARGET, SOURCE, 1)


def test_upsert_twice_is_once(spark):
    t = spark.createDataFrame(TARGET, SCHEMA).dropna()
    s = spark.createDataFrame(SOURCE, SCHEMA).dropna()
    once = upsert(t, s, ["k", "j"])
    assert bag(upsert(once, s, ["k", "j"])) == bag(once)


def test_large_key_set_takes_the_shuffled_form(spark, monkeypatch):
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    monkeypatch.setattr(change, "hot_keys", lambda df, keys: HotKeys({
        r[0]: 1 for r in df.select(F.xxhash64(*keys)).distinct().collect()}))
    got = upsert(t, s, ["k", "j"], limit=0)
    assert "__l" in got._jdf.queryExecution().optimizedPlan().toString()
    assert bag(got) == model(TARGET, SOURCE)


rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 2)),
        st.sampled_from("abc"),
    ),
    max_size=12,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, source=rows, small=st.booleans())
def test_upsert_property(spark, target, source, small):
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    assert bag(upsert(t, s, ["k", "j"], small=small)) == model(target, source)


def test_delete_keeps_columns_in_order(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "v string, k int")
    kept = delete_by_key(t, spark.createDataFrame([(1,)], "k int"), ["k"])
    assert kept.columns == ["v", "k"] and bag(kept) == Counter([("b", 2)])


def test_append_goes_by_position(spark):
    t = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    s = spark.createDataFrame([(3, 4)], "b int, a int")
    got = append(t, s)
    assert got.schema == t.schema and bag(got) == Counter([(1, 2), (3, 4)])


@pytest.mark.parametrize("schema", ["a int", "a int, b int, c int"])
def test_append_refuses_other_width(spark, schema):
    with pytest.raises(ValueError):
        aligned(spark.createDataFrame([], schema), spark.createDataFrame([], "a int, b int").schema)


@pytest.mark.parametrize("schema", ["a int, b string", "a double, b int", "a timestamp, b int", "a decimal(9,1), b int"])
def test_append_refuses_other_types(spark, schema):
    with pytest.raises(TypeError):
        aligned(spark.createDataFrame([], schema), spark.createDataFrame([], "a int, b int").schema)


def test_append_puts_values_into_the_columns_types(spark):
    target = spark.createDataFrame([], "a int, b decimal(6,2), c timestamp_ntz, d string, e double")
    rows = spark.sql("""
        SELECT * FROM VALUES (2147483647L, 1234L, DATE '2024-02-29', 7, CAST(1.5 AS DECIMAL(9, 3))),
                             (NULL, NULL, NULL, NULL, NULL) AS t(v, w, x, y, z)""")
    got = append(target, rows)
    assert got.schema == target.schema
    assert bag(got) == Counter([(2147483647, Decimal("1234.00"), at("2024-02-29"), "7", 1.5), (None,) * 5])
    rounded = spark.sql("SELECT 1 AS v, CAST(2.345 AS DECIMAL(9, 3)) AS w, DATE '2024-01-01', true, 1")
    assert append(target, rounded).first()["b"] == Decimal("2.35")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_append_refuses_values_out_of_range(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        target = spark.createDataFrame([], "a int, b decimal(6,2)")
        for row in ("2147483648L, 1", "1, 12345L"):
            with pytest.raises(Exception, match="cannot hold"):
                append(target, spark.sql(f"SELECT {row}")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_update_where(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    got = update_where(t, F.col("k") == 1, {"v": "z"})
    assert bag(got) == Counter([(1, "z"), (2, "b"), (None, "c")])
    with pytest.raises(ValueError):
        update_where(t, F.col("k") == 1, {"w": 1})


def test_update_uses_former_values(spark):
    t = spark.createDataFrame([(1, 2)], "a int, b int")
    got = update_where(t, F.col("a") == 1, {"a": F.col("b"), "b": F.col("a")})
    assert bag(got) == Counter([(2, 1)])


def test_insert_fills_from_the_left(spark):
    t = spark.createDataFrame([(1, "a", 5)], "k int, v string, n int")
    got = insert_rows(t, [(2,), (3, "c")], defaults={"n": 7})
    assert bag(got) == Counter([(1, "a", 5), (2, None, 7), (3, "c", 7)])
    with pytest.raises(ValueError):
        insert_rows(t, [(1, "a", 2, 3)])


def test_newest_per_key(spark):
    t = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f")],
        "k int, t int, v string",
    )
    got = newest_per_key(t, ["k"], ["t"])
    assert got.columns == t.columns
    assert bag(got) == Counter([(1, 3, "b"), (2, 1, "d"), (None, 1, "e"), (None, 2, "f")])
