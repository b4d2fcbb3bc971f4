from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from helpers import at, bag

from tidewright.operators.quality import (
    ERROR,
    WARNING,
    Check,
    ConstraintViolation,
    check_counts,
    childless_since,
    duplicate_keys,
    duplicate_uniques,
    null_keys,
    orphans,
    primary_key_violations,
    require_keys,
    require_keys_after_upsert,
    run_checks,
)
from tidewright.operators.reports import changed_tables, schema_ddl, table_row_counts
from tidewright.sources.extract import base_tables, catalog_frame

KEYED = "k int, j int, v string"


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (None, 2, "d"), (None, 2, "e")], KEYED
    )
    assert bag(duplicate_keys(df, ["k", "j"])) == Counter([(1, 1, 2), (None, 2, 2)])
    assert bag(duplicate_uniques(df, ["k", "j"])) == Counter([(1, 1, 2)])
    assert bag(null_keys(df, ["k", "j"]), "v") == Counter([("d",), ("e",)])
    assert bag(primary_key_violations(df, ["k", "j"])) == Counter([(1, 1, 2), (None, 2, 2)])
    assert bag(primary_key_violations(df, ["v", "k"])) == Counter([("d", None, 1), ("e", None, 1)])


def test_require_keys(spark):
    good = spark.createDataFrame([(1, 1, "a"), (2, 1, None), (3, 1, None)], KEYED)
    require_keys(good, ["k"], [["v"]])
    with pytest.raises(ConstraintViolation, match="primary"):
        require_keys(good, ["j"])
    with pytest.raises(ConstraintViolation, match="primary"):
        require_keys(good, ["v"])
    with pytest.raises(ConstraintViolation, match="duplicate"):
        require_keys(good, ["k"], [["j"]])


def test_require_keys_after_upsert(spark):
    merged = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "b")], KEYED)
    require_keys_after_upsert(merged, merged.where("k = 1"), ["k"], [["v"]])
    with pytest.raises(ConstraintViolation, match="'v': 'b'"):
        require_keys_after_upsert(merged, merged.where("k = 3"), ["k"], [["v"]])
    twice = merged.where("k = 1").union(merged.where("k = 1"))
    with pytest.raises(ConstraintViolation, match="primary"):
        require_keys_after_upsert(merged, twice, ["k"])


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_orphans(spark, limit):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (3, "d")],
                                  "k int, v string")
    parents = spark.createDataFrame([(1,), (None,), (3,), (3,)], "k int")
    got = bag(orphans(facts, parents, ["k"], limit))
    assert got == Counter([(2, "b"), (2, "b"), (None, "c")])


def test_orphans_of_hot_keys(spark, monkeypatch):
    """Beyond a broadcast, with keys that are dealt out over parts."""
    from tidewright.operators import quality, skew

    monkeypatch.setattr(quality, "hot_keys", lambda df, keys: skew.hot_keys(df, keys, min_rows=1))
    facts = spark.range(900).selectExpr(
        "if(id % 3 = 0, 7, if(id % 10 = 1, null, id)) k", "if(id % 7 = 0, null, id % 4) l", "id")
    parents = spark.createDataFrame([(8, 0), (10, 2), (None, 1), (7, 3)], "k long, l long")
    has = {(8, 0), (10, 2), (7, 3)}
    wanted = Counter(tuple(r) for r in facts.collect() if (r.k, r.l) not in has)
    for limit in (1 << 20, 0):
        assert bag(orphans(facts, parents, ["k", "l"], limit)) == wanted
    aged = facts.withColumn("ts", F.lit(at("2024-01-01")).cast("timestamp_ntz"))
    found = childless_since(aged, parents, ["k", "l"], "ts", timedelta(days=1), at("2024-05-05"))
    assert bag(found, "k", "l", "id") == wanted


def test_childless_since(spark):
    now = at("2024-05-05 12:00:00")
    ages = {1: timedelta(hours=12), 2: timedelta(days=2), 3: timedelta(days=4),
            4: timedelta(days=9), 5: timedelta(days=1)}
    stores = spark.createDataFrame([(k, now - a) for k, a in ages.items()] + [(6, None)],
                                   "store_id int, last_update timestamp_ntz")
    inventory = spark.createDataFrame([(4,), (4,), (None,)], "store_id int")

    def hits(days):
        found = childless_since(stores, inventory, ["store_id"], "last_update",
                                timedelta(days=days), now)
        return sorted(r["store_id"] for r in found.collect())

    assert hits(1) == [2, 3] and hits(3) == [3]


def checks(spark):
    three = spark.createDataFrame([(5,), (4,), (3,), (2,)], "k int")

    def broken():
        raise RuntimeError("no such table")

    return three, [
        Check("z-error", ERROR, lambda: three.limit(0)),
        Check("b-warning", WARNING, lambda: three),
        Check("a-error", ERROR, lambda: three.where("k > 3")),
        Check("a-warning", WARNING, broken),
    ]


def test_run_checks(spark):
    _, all_checks = checks(spark)
    report = run_checks(spark, all_checks)
    assert [tuple(r)[:4] for r in report.summary.collect()] == [
        ("a-warning", WARNING, None, "failed"), ("b-warning", WARNING, 4, "found"),
        ("a-error", ERROR, 2, "found"), ("z-error", ERROR, 0, "passed"),
    ]
    assert [r["row"] for r in report.samples.where("check_name = 'b-warning'").collect()] == [
        '{"k":2}', '{"k":3}', '{"k":4}']
    assert report.exit_code == 1


@pytest.mark.parametrize("severity, code", [(WARNING, 0), (ERROR, 1)])
def test_exit_code_depends_on_errors(spark, severity, code):
    three, _ = checks(spark)
    assert run_checks(spark, [Check("c", severity, lambda: three)]).exit_code == code
    assert run_checks(spark, [Check("c", severity, lambda: three.limit(0))]).exit_code == 0


def test_failed_check_is_an_error(spark):
    missing = Check("c", WARNING, lambda: spark.table("no_such_table"))
    assert run_checks(spark, [missing]).exit_code == 1


def test_check_counts(spark):
    three, _ = checks(spark)
    got = check_counts([Check("e", ERROR, lambda: three), Check("w", WARNING, lambda: three)])
    assert [tuple(r) for r in got.collect()] == [("w", WARNING, 4), ("e", ERROR, 4)]
    with pytest.raises(ValueError):
        Check("c", "fatal", lambda: three)


def test_reports(spark):
    some = {f"t{n}": spark.range(n) for n in (10, 0, 1)}
    counts = [tuple(r) for r in table_row_counts(some).collect()]
    assert counts == [("t0".ljust(15), 0), ("t1".ljust(15), 1), ("t10".ljust(15), 10)]
    changed = changed_tables({n: (df, ["id", "x"]) for n, df in some.items()})
    assert bag(changed) == Counter([("t10", "id,x", 10), ("t1", "id,x", 1)])


def test_schema_ddl(spark):
    one = spark.createDataFrame([], "b int, a string, c timestamp_ntz")
    catalog = catalog_frame(spark, {"one": one, "two": spark.range(0)})
    got = schema_ddl(catalog, "table_name", "column_name", "data_type", "ordinal_position")
    assert bag(got) == Counter([
        ("one", "CREATE TABLE one(b int,a string,c timestamp_ntz);"),
        ("two", "CREATE TABLE two(id bigint);"),
    ])


def test_base_tables_leave_out_views(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(3).write.mode("overwrite").option("path", f"{folder}/t").saveAsTable("shop.items")
    spark.range(3).createOrReplaceTempView("item_view")
    try:
        assert base_tables(spark, "shop") == ["items"]
    finally:
        spark.sql("DROP TABLE shop.items")
        spark.catalog.dropTempView("item_view")
        spark.sql("DROP DATABASE shop")
