import random
from collections import Counter

import pytest
from helpers import bag
from pyspark.sql import functions as F

from tidewright.operators import removals, sieve
from tidewright.operators import signed as signed_rows
from tidewright.operators.removals import KeyRanges, differing_ranges, removed
from tidewright.operators.signed import bridge_change, counted, signed, spent, with_change
from tidewright.sources import zones
from tidewright.sources.zones import ZoneTable


@pytest.mark.parametrize("keys", [["k"], ["k", "j"], ["j"]])
@pytest.mark.parametrize("seed", range(2))
def test_removed_equals_brute_force(spark, keys, seed):
    rng = random.Random(seed)
    schema = "k int, j string, v int"
    rows = [(rng.choice([None, *range(-40, 60)]), rng.choice([None, "a", "b", "c"]), i) for i in range(120)]
    source = [r for r in rows if rng.random() > 0.1] + [(500, "new", 1)]
    at = [["k", "j"].index(k) for k in keys]
    held = {tuple(r[i] for i in at) for r in source}
    want = [r for r in rows if None not in [r[i] for i in at] and tuple(r[i] for i in at) not in held]
    for ranges in (1, 16, 4096):
        found = removed(spark.createDataFrame(source, schema), spark.createDataFrame(rows, schema), keys, ranges)
        assert bag(found) == Counter(want)


def test_no_rows_on_either_side(spark):
    some, none = spark.range(5), spark.range(0)
    assert removed(none, some, ["id"]).count() == 5
    assert removed(some, none, ["id"]).count() == 0 and removed(none, none, ["id"]).count() == 0
    wide = spark.createDataFrame([(-(1 << 63),), (0,), ((1 << 63) - 1,)], "id bigint")
    assert bag(removed(wide.where("id <> 0"), wide, ["id"])) == Counter([(0,)])
    assert bag(removed(wide.where("id = 0"), wide, ["id"])) == bag(wide.where("id <> 0"))


def test_few_ranges_are_compared(spark, folder):
    spark.range(100_000).write.parquet(f"{folder}/copy")
    copy = spark.read.parquet(f"{folder}/copy")
    source = copy.where("id not in (17, 18, 70000)")
    cut = KeyRanges(source, copy, ["id"])
    numbers = differing_ranges(source, copy, cut)
    assert 1 <= len(numbers) <= 3
    found = removed(source, copy, ["id"])
    assert bag(found) == Counter([(17,), (18,), (70000,)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The ranges reach both scans.
    assert plan.count("GreaterThanOrEqual(id") >= 2
    assert differing_ranges(copy, copy.repartition(3), cut) == []


def test_checksums_do_not_depend_on_order(spark):
    rows = spark.range(1000).selectExpr("id % 300 as id")
    cut = KeyRanges(rows, rows, ["id"], 7)
    one, other = (removals.checksums(df, cut) for df in (rows, rows.orderBy(F.rand(3)).repartition(5)))
    assert bag(one) == bag(other)
    whole = removals.rolled_up(one, 100)
    assert whole.count() == 1 and whole.first()["n"] == 1000


@pytest.mark.parametrize("places", [2000, 3])
def test_rows_are_removed_from_a_table(spark, folder, monkeypatch, places):
    monkeypatch.setattr(zones, "INLINE_PLACES", places)
    table = ZoneTable(spark, f"{folder}/t", ["k", "j"])
    rows = [(i, "ab"[i % 2], i) for i in range(20)] + [(None, "a", 50)]
    table.replace(spark.createDataFrame(rows, "k int, j string, v int"))
    table.upsert(spark.createDataFrame([(3, "b", -1)], "k int, j string, v int"))
    gone = spark.createDataFrame([(3, "b"), (3, "a"), (4, "a"), (None, "a"), (4, "a"), (99, "a")], "k int, j string")
    assert table.remove(gone) == 2 and table.remove(gone) == 0
    assert bag(table.read()) == Counter(r for r in rows if r[0] not in (3, 4))
    assert table.current().live_rows() == 19
    table.compact()
    assert bag(table.read()) == Counter(r for r in rows if r[0] not in (3, 4))


def _facts(links_a, links_b):
    return Counter((f, a, b) for f, a in links_a for g, b in links_b if f == g and f is not None)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_signed_bridge_equals_a_rebuild(spark, limit):
    rng = random.Random(4)
    columns = ["f", "a", "b"]

    def random_links(n, key):
        return [(rng.choice([None, 1, 1, 1, *range(8)]), rng.randrange(6)) for _ in range(n)]

    a, b = random_links(40, "a"), random_links(40, "b")
    facts = spark.createDataFrame([(*k, n) for k, n in _facts(a, b).items()], "f int, a int, b int, n bigint")
    for _ in range(2):
        gone_a, gone_b = rng.sample(a, 8), rng.sample(b, 8)
        more_a, more_b = random_links(5, "a"), random_links(5, "b")
        for links, gone, more in ((a, gone_a, more_a), (b, gone_b, more_b)):
            for x in gone:
                links.remove(x)
            links += more

        def frame(links, name):
            return spark.createDataFrame(links, f"f int, {name} int")

        before = facts
        change = bridge_change(
            counted(frame(a, "a"), ["f", "a"]), signed(frame(more_a, "a"), frame(gone_a, "a"), ["f", "a"]),
            counted(frame(b, "b"), ["f", "b"]), signed(frame(more_b, "b"), frame(gone_b, "b"), ["f", "b"]),
            "f", columns, limit)
        facts = with_change(before, change, columns, limit)
        want = _facts(a, b)
        got = facts.collect()
        assert Counter({(r.f, r.a, r.b): r.n for r in got}) == want and len(got) == len(want)
        left = {(r.f, r.a, r.b) for r in before.collect()} - set(want)
        assert {tuple(r) for r in spent(change, before, columns).collect()} == left
        facts = spark.createDataFrame([tuple(r) for r in got], facts.schema)


def test_a_task_sums_up_a_bounded_number_of_pairs(spark, monkeypatch):
    monkeypatch.setattr(signed_rows, "PAIRS_PER_SUM", 500, raising=False)
    links = spark.range(4000).select((F.col("id") % 1000).alias("f"), F.col("id").alias("a"))
    others, columns = links.withColumnRenamed("a", "b"), ["f", "a", "b"]
    no_a, no_b = links.limit(0), others.limit(0)
    change = bridge_change(
        counted(links, ["f", "a"]), signed(links.where("a < 1000"), no_a, ["f", "a"]),
        counted(others, ["f", "b"]), signed(no_b, no_b, ["f", "b"]), "f", columns)
    per_task = [r["count"] for r in change.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 4000 and max(per_task) < 1000
    assert change.where("sign = 1 and a < 1000 and f = a and b % 1000 = f").count() == 4000


def test_changes_that_do_not_belong_are_refused(spark):
    facts = spark.createDataFrame([(1, 1, 1, 1)], "f int, a int, b int, n bigint")
    change = spark.createDataFrame([(1, 1, 1, -2)], "f int, a int, b int, sign bigint")
    with pytest.raises(Exception, match="more often"):
        with_change(facts, change, ["f", "a", "b"]).collect()


def _moved(node):
    """Rows that the exchanges of an executed plan wrote."""
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        return _moved(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return _moved(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if node.nodeName() == "Exchange" else 0
    return own + sum(_moved(node.children().apply(i)) for i in range(node.children().size()))


def _rows_moved(df):
    rows = df.collect()
    return len(rows), _moved(df._jdf.queryExecution().executedPlan())


def _spread_facts(spark):
    return spark.range(20000).select(
        (F.col("id") % 4000).alias("f"), F.col("id").alias("a"), F.lit(1).alias("b"), F.lit(2).alias("n"))


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_facts_of_unchanged_pairs_are_not_moved(spark, limit):
    change = spark.createDataFrame([(7, 7, 1, -2), (8, -1, 1, 1)], "f bigint, a bigint, b int, sign bigint")
    rows, moved = _rows_moved(with_change(_spread_facts(spark), change, ["f", "a", "b"], limit))
    assert rows == 20000 and moved < 2000


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_links_move_once_on_their_way_to_the_facts(spark, limit):
    links = spark.range(20000).select((F.col("id") % 4000).alias("f"), F.col("id").alias("a"))
    first, second = counted(links, ["f", "a"], "f"), counted(links.withColumnRenamed("a", "b"), ["f", "b"], "f")
    facts = first.join(second.withColumnRenamed("sign", "times"), "f").select("f", "a", "b", F.lit(1).alias("n"))
    change = spark.createDataFrame([(7, 7, 7, -1), (8, -1, 1, 1)], "f bigint, a bigint, b bigint, sign bigint")
    rows, moved = _rows_moved(with_change(facts, change, ["f", "a", "b"], limit, on="f"))
    assert rows == 100000 and moved < 42000


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("on", [None, "f"])
def test_a_change_of_facts_that_repeat_or_have_nulls(spark, limit, on):
    facts = spark.createDataFrame(
        [(1, 1, 1, 2), (1, 1, 1, 3), (2, None, 1, 4), (2, 2, 2, 1), (2, 2, 2, 1), (3, 1, 1, 5), (None, 1, 1, 6),
         (4, 1, 1, -1), (4, 2, 2, 9), (5, 5, 5, 5), (5, 5, 5, 5)], "f int, a int, b int, n int")
    change = spark.createDataFrame(
        [(1.0, 1, 1, -4), (2.0, None, 1, 7), (3.0, 1, 1, -5), (9.0, 9, 9, 1), (9.0, 9, 9, 1), (None, 1, 1, 1),
         (4.0, 2, 2, -1)], "f double, a bigint, b bigint, sign int")
    got = with_change(facts, change, ["f", "a", "b"], limit, on)
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "bigint", "bigint", "bigint"]
    assert bag(got) == Counter([
        (1, 1, 1, 1), (2, None, 1, 4), (2, None, 1, 7), (2, 2, 2, 1), (2, 2, 2, 1), (9, 9, 9, 2), (None, 1, 1, 6),
        (None, 1, 1, 1), (4, 1, 1, -1), (4, 2, 2, 8), (5, 5, 5, 5), (5, 5, 5, 5)])


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_changes_of_other_types_and_refused_ones(spark, limit):
    facts = spark.createDataFrame([("1", 1, 1, 1), ("2", 1, 1, 1)], "f string, a int, b int, n bigint")
    change = spark.createDataFrame([(1, 1, 1, 1)], "f int, a int, b int, sign bigint")
    kinds = with_change(facts, change, ["f", "a", "b"], limit).select(F.col("f").cast("int"), "a", "b", "n")
    assert bag(kinds) == Counter([(1, 1, 1, 2), (2, 1, 1, 1)])
    change = spark.createDataFrame([("1", 1, 1, -2)], "f string, a int, b int, sign bigint")
    with pytest.raises(Exception, match="more often"):
        with_change(facts, change, ["f", "a", "b"], limit, "f").collect()


@pytest.mark.parametrize("most", [1, 40, 1 << 18])
def test_counts_by_entity_do_not_depend_on_hot_ones(spark, monkeypatch, most):
    monkeypatch.setattr(signed_rows, "LINKS_PER_TASK", most)
    links = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3 * (F.col("id") % 50)).alias("f"), (F.col("id") % 7).alias("a"))
    assert bag(counted(links, ["f", "a"], "f")) == bag(counted(links, ["f", "a"]))


@pytest.mark.parametrize("most", [1, 8, 1 << 20])
def test_a_sieve_loses_none_of_its_keys(spark, monkeypatch, most):
    monkeypatch.setattr(sieve, "MOST_WORDS", most)
    given = spark.createDataFrame([(None, "x"), (0.0, "x"), (float("nan"), None), (-0.0, "z"),
                                   *[(float(i), "y") for i in range(500)]], "k double, j string")
    known = sieve.sieve(given)
    assert given.where(known.passes(given)).count() == given.count()
    others = spark.range(2000).select((F.col("id") + 1000).alias("k"), F.lit("y").alias("j"))
    assert others.where(known.passes(others)).count() < (100 if most > 8 else 2001)
    none = sieve.sieve(given.limit(0))
    assert given.where(none.passes(given)).count() == 0
