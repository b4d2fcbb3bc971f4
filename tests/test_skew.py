from collections import Counter

import pytest
from helpers import bag
from pyspark.sql import functions as F

from tidewright.operators import skew
from tidewright.operators.sizing import are_small, measured_bytes, row_counts
from tidewright.operators.skew import (
    MAX_SLICES,
    PARTS,
    HotGroups,
    HotKeys,
    hot_groups,
    hot_keys,
    number_in_groups,
    spread_join,
)


@pytest.fixture(scope="module")
def left(spark):
    # Key 7 holds a third of the rows, and they are all equal.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 40).cast("int").alias("k"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("l"),
    )


@pytest.fixture(scope="module")
def right(spark):
    return spark.range(400).select(
        F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 60).cast("int").alias("k"),
        F.col("id").alias("r"),
    )


def test_hot_keys_finds_the_large_key(spark, left):
    seven = spark.range(1).select(F.xxhash64(F.lit(7.0))).first()[0]
    assert hot_keys(left, ["k"], min_rows=0).rows[seven] == 1050
    assert not hot_keys(left, ["k"]) and not hot_keys(left.limit(0), ["k"], min_rows=0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [False, True])
def test_spread_join_equals_join(left, right, how, hot):
    hot_left = hot_keys(left, ["k"], min_rows=0) if hot else HotKeys()
    got = spread_join(left, right, ["k"], how, hot_left=hot_left)
    want = left.join(right, ["k"], how)
    assert got.columns == want.columns and bag(got) == bag(want)


def test_spread_join_grid(left, right):
    hot_left = hot_keys(left, ["k"], min_rows=0)
    hot_right = hot_keys(right, ["k"], min_rows=0)
    got = spread_join(left, right, ["k"], "inner", hot_left, hot_right)
    assert bag(got) == bag(left.join(right, ["k"]))


def test_spread_join_splits_equal_rows(left):
    hot = hot_keys(left, ["k"], min_rows=0)
    dealt = left.repartition(16, "l", F.rand(1)).withColumn(
        "cell", F.when(hot.has(left, ["k"]), skew._dealt(left, hot.parts(left, ["k"]))))
    cells = dealt.where("k = 7 and l = 0").groupBy("cell").count().collect()
    assert len(cells) > 1


def test_copying_left_rows_is_refused(left, right):
    with pytest.raises(ValueError):
        spread_join(left, right, ["k"], "left_anti", hot_right=HotKeys({1: 1}))
    with pytest.raises(ValueError):
        spread_join(left, right, ["k"], "right")


def numbered(rows):
    groups = {}
    for k, g in rows:
        groups.setdefault(g, []).append(k)
    return Counter(
        (k, g, 1 + sorted(groups[g]).index(k), len(groups[g])) for k, g in rows
    )


def test_sliced_numbering(spark):
    rows = [(i * 7 % 5003, None if i % 5 == 0 else "hot" if i % 2 else f"g{i % 300}")
            for i in range(2500)]
    df = spark.createDataFrame(rows, "k int, g string").repartition(8)
    hot = hot_groups(df, ["g"], "k", min_rows=0)
    assert len(hot.cuts) == 7
    got = number_in_groups(df, ["g"], "k", "n", "all", hot)
    assert bag(got) == numbered(rows)
    assert bag(number_in_groups(df, ["g"], "k", "n", "all")) == numbered(rows)


def test_parts_grow_with_the_key():
    hot = HotKeys({1: 2.0, 2: 3e8, 3: 4e11, 4: 9e12})
    assert hot._steps(PARTS[-1]) == {8: [1], 64: [2], 32768: [3, 4]} 
    assert hot.most_parts() == 32768 and hot.most_parts(MAX_SLICES) == 4096


def test_many_slices_and_smaller_hot_groups(spark, monkeypatch):
    """Groups of very different size, each cut as finely as its size asks for."""
    monkeypatch.setattr(skew, "MIN_ROWS", 20)
    monkeypatch.setattr(skew, "VALUES_PER_SLICE", 3)
    rows = [(i * 11 % 9001, "big" if i % 2 else f"g{i % 14}") for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, g string").repartition(8)
    hot = hot_groups(df, ["g"], "k", min_rows=0)
    assert len(hot.cuts) == 511 and len(hot.keys._steps(512)) > 1
    sliced = skew._with_slice(df, ["g"], "k", hot)
    found = {r["g"]: r["n"] for r in sliced.groupBy("g").agg(
        F.countDistinct("__slice").alias("n")).collect()}
    assert found["big"] > 300 and found["g2"] <= 64
    assert bag(number_in_groups(df, ["g"], "k", "n", "all", hot)) == numbered(rows)


def test_finest_slices(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 1)
    df = spark.range(20000).select("id", F.lit("x").alias("g"))
    hot = hot_groups(df, ["g"], "id", min_rows=0)
    assert len(hot.cuts) == MAX_SLICES - 1
    got = number_in_groups(df, ["g"], "id", "n", "all", hot)
    assert got.where((F.col("n") != F.col("id") + 1) | (F.col("all") != 20000)).count() == 0


def test_sliced_numbering_moves_rows_once(spark, folder):
    spark.range(5000).select("id", (F.col("id") % 2).alias("g")).write.parquet(f"{folder}/t")
    df = spark.read.parquet(f"{folder}/t")
    hot = hot_groups(df, ["g"], "id", min_rows=0)
    query = number_in_groups(df, ["g"], "id", "n", "all", hot)._jdf.queryExecution()
    # One exchange for the rows; the counts are grouped, added up, and brought to the rows.
    plan = query.executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange") == 4


@pytest.mark.parametrize("dtype", ["timestamp_ntz", "string"])
def test_slices_of_other_types(spark, dtype):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    key = start + F.make_dt_interval(F.col("id").cast("int")) if dtype != "string" \
        else F.format_string("key-%05d", "id")
    df = spark.range(900).select(key.alias("k"), F.lit("same").alias("g"), "id")
    hot = hot_groups(df, ["g"], "k", min_rows=0)
    got = number_in_groups(df, ["g"], "k", "n", "all", hot)
    assert len(hot.cuts) == 7
    assert got.where((F.col("n") != F.col("id") + 1) | (F.col("all") != 900)).count() == 0


def test_null_order_key_comes_last(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int").withColumn("g", F.lit("a"))
    (h,) = df.select(F.xxhash64("g")).distinct().collect()
    for hot in (None, HotGroups(HotKeys({h[0]: 3}), (1,))):
        got = number_in_groups(df, ["g"], "k", "n", "all", hot)
        assert bag(got, "k", "n", "all") == Counter([(1, 1, 3), (2, 2, 3), (None, 3, 3)])


def test_measured_sizes(spark):
    ids, texts = spark.range(100), spark.range(10).select(F.repeat(F.lit("é"), 50).alias("s"))
    nested = spark.range(1).select(F.array("id").alias("a"))
    assert measured_bytes(ids, texts, nested) == [1600, 1160, None]
    assert are_small(ids, texts, limit=2760) and not are_small(ids, texts, limit=2759)
    assert not are_small(nested) and are_small(ids.limit(0), limit=0)
    assert row_counts(ids, texts) == [100, 10]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("one, other", [
    ("int", "bigint"), ("bigint", "int"), ("int", "decimal(10,0)"), ("smallint", "decimal(12,2)"),
    ("date", "timestamp_ntz"), ("date", "timestamp")])
def test_spread_join_of_mixed_types(spark, how, one, other):
    def typed(rows, dtype, name):
        value = "k" if dtype not in ("date", "timestamp", "timestamp_ntz") else \
            "date_add(date'2024-01-01', k)"
        return spark.createDataFrame(rows, f"k int, {name} int").selectExpr(
            f"cast({value} as {dtype}) as k", name)

    left = typed([(7, i) for i in range(300)] + [(i, i) for i in range(40)], one, "l")
    right = typed([(i, i) for i in range(0, 30, 2)] + [(7, -1)], other, "r")
    hot = hot_keys(left, ["k"], min_rows=0)
    assert hot
    assert bag(spread_join(left, right, ["k"], how, hot)) == bag(left.join(right, ["k"], how))


def test_spread_join_refuses_types_without_a_common_one(spark, left):
    other = spark.createDataFrame([("7", 1)], "k string, r int")
    with pytest.raises(ValueError, match="key k"):
        spread_join(left, other, ["k"])
