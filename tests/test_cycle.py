from collections import Counter
from datetime import timedelta
from pathlib import Path

import pytest
import rental
from helpers import at, bag
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle
from tidewright.operators.quality import ERROR
from tidewright.plans import warehouse
from tidewright.plans.cycle import GROUP_SCOPE, STATE_SCOPE, CycleFailed, Warehouse
from tidewright.sources.extract import base_tables, catalog_source, jdbc_source, parquet_source
from tidewright.sources.runlog import FAILED, FULL_LOAD, TRANSFORM, Line, RunLog
from tidewright.sources.specs import SOURCES, TARGETS, TableSpec, TargetSpec
from tidewright.sources.zones import Zone, ZoneTable

FULL_LOAD_AT = at("2024-01-01")


class Shop:
    """A source whose tables can be changed between runs."""

    def __init__(self, tables):
        self.tables = tables

    def __call__(self, name):
        return self.tables[name]


@pytest.fixture(scope="module")
def after_cycle(spark, tmp_path_factory):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, str(tmp_path_factory.mktemp("house")), shop)
    house.full_load(FULL_LOAD_AT)
    before = {t.name: bag(house.dw.read(t.name)) for t in TARGETS}
    shop.tables = rental.changed(shop.tables)
    changed = house.run_cycle(rental.CYCLE)
    return house, before, bag(changed)


def test_full_load(after_cycle):
    house, before, _ = after_cycle
    old = rental.OLD
    assert before["category_dim"] == Counter([(1, "Puppetry", old), (4, "Harvest", old)])
    assert before["actor_dim"] == Counter([
        (1, "ANNA", "HILL", None, old), (52, "CLARA", "REED", 1, old),
        (57, "CLARA", "REED", 2, old)])
    assert {r[0] for r in before["film_dim"]} == {1, 2}
    assert {r[4] for r in before["film_dim"]} == {"English"}
    assert before["film_fact"] == Counter([
        (1, 1, 1, old), (1, 1, 4, old), (1, 52, 1, old), (1, 52, 4, old), (2, 57, 1, old)])
    assert before["store_dim"] == Counter([
        (1, 1, 1, "12 Elm Street", None, "West", "Northam", "", "", "Nordland", old),
        (2, 2, 2, "5 Mill Lane", None, "East", "Southam", "", "", "Sudland", old)])
    assert sum(before["inventory_fact"].values()) == 2


def test_changed_tables(after_cycle):
    _, _, changed = after_cycle
    assert changed == Counter([
        ("actor", "actor_id", 1), ("city", "city_id", 1), ("film", "film_id", 1),
        ("film_actor", "actor_id,film_id", 1), ("film_category", "film_id,category_id", 1),
        ("inventory", "inventory_id", 1), ("language", "language_id", 1)])


def test_raw_holds_the_delta_only(after_cycle):
    house, _, _ = after_cycle
    counts = {r["table_name"].strip(): r["n"] for r in house.status(house.raw).collect()}
    assert counts["film_category"] == 1 and counts["country"] == 0 and counts["payment"] == 0
    assert len(counts) == 15


def test_staging_is_the_source(after_cycle, spark):
    house, _, _ = after_cycle
    source = rental.changed(rental.tables(spark))
    for spec in SOURCES:
        assert bag(house.staging.read(spec.name)) == bag(source[spec.name]), spec.name


def test_merged_warehouse(after_cycle):
    house, before, _ = after_cycle
    new, old = rental.INSIDE, rental.OLD

    def dw(name):
        return bag(house.dw.read(name))

    assert dw("category_dim") == before["category_dim"]
    # The actor who takes the shared name gets no number, since a cycle numbers only what it
    # changed; the others keep theirs.
    assert dw("actor_dim") == Counter([
        (1, "CLARA", "REED", None, new), (52, "CLARA", "REED", 1, old), (57, "CLARA", "REED", 2, old)])
    # A language that changes alone changes its films.
    assert Counter((r[0], r[4], r[-1]) for r in dw("film_dim").elements()) == Counter([
        (1, "Cornish", new), (2, "Cornish", new), (41, "Italian", new)])
    assert dw("film_fact") - before["film_fact"] == Counter([(41, 57, 4, new)])
    assert dw("inventory_fact") == Counter([(1, 1, 1, old), (2, 41, 2, new)])
    assert Counter((r[0], r[6], r[-1]) for r in dw("store_dim").elements()) == Counter([
        (1, "Northam", old), (2, "Eastham", new)])


def test_columns_in_order(after_cycle):
    house, _, _ = after_cycle
    assert house.dw.read("actor_dim").columns == [
        "actor_id", "first_name", "last_name", "qualifier", "last_update"]
    assert house.dw.read("film_dim").columns == [
        "film_id", "title", "description", "release_year", "language", "rental_duration",
        "rental_rate", "length", "replacement_cost", "rating", "last_update"]
    assert house.dw.read("store_dim").columns == [
        "store_id", "manager_staff_id", "address_id", "address", "address2", "district", "city",
        "postal_code", "phone", "country", "last_update"]
    assert house.dw.read("film_fact").columns == [
        "film_id", "actor_id", "category_id", "last_update"]


def test_running_again_changes_nothing(after_cycle):
    house, _, _ = after_cycle
    first = {t.name: bag(house.dw.read(t.name)) for t in TARGETS}
    house.run_cycle(rental.CYCLE)
    assert {t.name: bag(house.dw.read(t.name)) for t in TARGETS} == first
    house.vacuum(keep=1)
    assert {t.name: bag(house.dw.read(t.name)) for t in TARGETS} == first


def test_checks(after_cycle, spark):
    house, _, _ = after_cycle
    report = house.run_checks(at("2024-01-01"))
    assert [tuple(r)[:4] for r in report.summary.collect()] == [
        ("film_facts_without_film", "warning", 0, "passed"),
        ("stores_empty_for_1_day", ERROR, 0, "passed"),
        ("stores_empty_for_3_days", ERROR, 0, "passed")]
    assert report.exit_code == 0


def test_failing_checks(spark, folder):
    shop = Shop(rental.tables(spark))
    shop.tables["inventory"] = shop.tables["inventory"].where("store_id = 1")
    shop.tables["film"] = shop.tables["film"].withColumn(
        "language_id", F.when(F.col("film_id") == 1, 77).otherwise(F.col("language_id")))
    house = Warehouse(spark, folder, shop)
    house.full_load(FULL_LOAD_AT)
    report = house.run_checks(rental.OLD + timedelta(days=2))
    assert [r["n"] for r in report.summary.collect()] == [4, 1, 0]
    assert report.exit_code == 1
    kept = Zone(spark, f"{folder}/checks").read("samples")
    assert bag(kept) == bag(report.samples) and kept.count() == 4


def test_group_scope_equals_a_rebuild(spark, folder):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, folder, shop, qualifier_scope=GROUP_SCOPE)
    house.full_load(FULL_LOAD_AT)
    shop.tables = rental.changed(shop.tables)
    house.run_cycle(rental.CYCLE)
    assert bag(house.dw.read("actor_dim")) == bag(warehouse.actor_dim(shop))


@pytest.mark.parametrize("late", [False, True])
def test_a_changed_city_finds_its_stores_by_the_index(spark, folder, late):
    shop = Shop(rental.tables(spark))
    Warehouse(spark, folder, shop, lookup_index=not late).full_load(FULL_LOAD_AT)
    house = Warehouse(spark, folder, shop, lookup_index=True)
    shop.tables = rental.changed(shop.tables)
    house.run_cycle(rental.CYCLE)
    assert bag(house.dw.read("store_dim")) == bag(warehouse.store_dim(shop))
    assert house.deltas.read("store_dim").count() == 1


def test_state_scope_refuses_no_cycle(spark, folder, monkeypatch):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, folder, shop, qualifier_scope=STATE_SCOPE)
    house.full_load(FULL_LOAD_AT)
    shop.tables = rental.changed(shop.tables)
    shop.tables["actor"] = shop.tables["actor"].union(spark.createDataFrame(
        [(201, "CLARA", "REED", rental.INSIDE), (202, "ANNA", "HILL", rental.INSIDE)],
        rental.SCHEMAS["actor"]))
    upsert, failed = ZoneTable.upsert, []

    def fails_once(self, *args, **kwargs):
        if self.path.endswith("/dw/actor_dim") and not failed:
            failed.append(self)
            raise OSError("lost")
        return upsert(self, *args, **kwargs)

    monkeypatch.setattr(ZoneTable, "upsert", fails_once)
    with pytest.raises(CycleFailed, match="actor_dim.*lost"):
        house.run_cycle(rental.CYCLE)
    house.retry()

    def numbers():
        return {r.actor_id: (r.first_name, r.qualifier) for r in house.dw.read("actor_dim").collect()}

    assert numbers() == {1: ("CLARA", 3), 52: ("CLARA", 1), 57: ("CLARA", 2), 201: ("CLARA", 4),
                         202: ("ANNA", None)}
    shop.tables["actor"] = shop.tables["actor"].where("actor_id not in (52, 57, 201)")
    house.remove_gone(rental.CYCLE.upto)
    assert numbers() == {1: ("CLARA", None), 202: ("ANNA", None)}


def test_colliding_qualifier_is_refused_and_the_rest_published(spark, folder):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, folder, shop)
    house.full_load(FULL_LOAD_AT)
    before = bag(house.dw.read("actor_dim"))
    shop.tables = rental.changed(shop.tables)
    shop.tables["actor"] = shop.tables["actor"].union(spark.createDataFrame(
        [(201, "CLARA", "REED", rental.INSIDE), (202, "CLARA", "REED", rental.INSIDE)],
        rental.SCHEMAS["actor"]))
    with pytest.raises(CycleFailed, match="actor_dim.*duplicate"):
        house.run_cycle(rental.CYCLE)
    assert bag(house.dw.read("actor_dim")) == before
    assert house.dw.read("film_dim").count() == 3
    log = house.log.read().where("step = 'transform' and table_name <> '*'")
    assert {r["table_name"]: r["status"] for r in log.collect()} == {
        t.name: "failed" if t.name == "actor_dim" else "done" for t in TARGETS}
    # The cycle is over for all tables but the refused one, which is owed its window.
    upto, ten = rental.CYCLE.upto, timedelta(minutes=10)
    names = [t.name for t in TARGETS]
    assert house.log.done_upto() == upto
    assert house.log.owed(names) == {"actor_dim": rental.CYCLE}
    with pytest.raises(CycleFailed, match="actor_dim"):
        house.catch_up(upto + ten)
    log = house.log.read().where(F.col("step").isin("transform") & (F.col("cycle_upto") == upto + ten))
    starts = {r["table_name"]: r["cycle_from"] for r in log.collect()}
    assert starts.pop("actor_dim") == rental.CYCLE.start
    assert set(starts) == {*names, "*"} - {"actor_dim"} and set(starts.values()) == {upto}
    with pytest.raises(CycleFailed, match="actor_dim"):
        house.catch_up(upto + ten)  # nothing pending: the refused table alone is tried again
    # Renamed at the source, the actors get in, together with those of the window still owed.
    renamed = F.when(F.col("actor_id") > 200, F.concat(F.lit("N"), "actor_id"))
    shop.tables["actor"] = shop.tables["actor"].withColumns({
        "first_name": F.coalesce(renamed, "first_name"),
        "last_update": F.when(F.col("actor_id") > 200, F.lit(upto + ten).cast("timestamp_ntz"))
        .otherwise(F.col("last_update"))})
    house.catch_up(upto + 2 * ten)
    assert house.log.owed(names) == {} and house.catch_up(upto + 2 * ten) is None
    assert {(1, None), (201, None), (202, None)} <= set(bag(house.dw.read("actor_dim"), "actor_id", "qualifier"))


def test_full_load_settles_what_is_owed(spark, folder):
    log = RunLog(spark, f"{folder}/log")
    cycle, later = Cycle.of("2024-01-01", "2024-01-02"), Cycle.of("2024-01-02", "2024-01-03")
    log.add("a", TRANSFORM, cycle, [Line("x", None, FAILED), Line("y", 1)])
    assert log.owed(["x", "y", "z"]) == {"x": cycle}
    log.add("b", TRANSFORM, later, [Line("x", None, FAILED, cycle=Cycle(cycle.start, later.upto))])
    assert log.owed(["x", "y"]) == {"x": Cycle(cycle.start, later.upto)}
    log.add("c", FULL_LOAD, later, [Line("x", 5)])
    assert log.owed(["x", "y"]) == {}


def test_checks_from_files(after_cycle, spark, folder):
    house, _, _ = after_cycle
    files = Path(folder)
    for name, text in {
        "warnings/any_store.sql": "SELECT store_id FROM store_dim;",
        "errors/from_the_future.sql": "SELECT film_id FROM film_dim WHERE last_update > :as_of",
        "errors/broken.sql": "SELECT nothing FROM nowhere",
        "errors/notes.txt": "not a check",
    }.items():
        (files / name).parent.mkdir(exist_ok=True)
        (files / name).write_text(text)

    def run():
        report = house.run_checks(at("2030-01-01"), folder=folder)
        return [tuple(r)[:4] for r in report.summary.collect()], report

    lines, report = run()
    assert lines == [("any_store", "warning", 2, "found"), ("broken", ERROR, None, "failed"),
                     ("from_the_future", ERROR, 0, "passed")]
    assert report.exit_code == 1
    assert [r["row"] for r in report.samples.orderBy("row").collect()] == ['{"store_id":1}', '{"store_id":2}']
    (files / "errors/broken.sql").unlink()
    assert run()[1].exit_code == 0


def test_two_store_forms(spark):
    shop = rental.tables(spark)
    shop["city"] = shop["city"].withColumn(
        "last_update", F.when(F.col("city_id") == 10, F.lit("2024-03-01").cast("timestamp_ntz"))
        .otherwise(F.col("last_update")))
    source = Shop(shop)
    assert warehouse.store_dim(source, rental.CYCLE, both=True).count() == 0
    assert bag(warehouse.store_dim(source, rental.CYCLE), "store_id") == Counter([(1,)])


def test_windows_to_catch_up(spark, folder):
    item = TableSpec("item", ("id",), "ts")
    rows = [(i, at("2024-01-01 00:00:00") + timedelta(minutes=5 * i)) for i in range(10)]
    shop = Shop({"item": spark.createDataFrame([], "id int, ts timestamp_ntz")})
    house = Warehouse(
        spark, folder, shop, sources=[item], targets=[TargetSpec("item_dim", ("id",))],
        builders={"item_dim": lambda read, cycle: warehouse.passthrough(
            read("item"), "ts", cycle)})
    assert house.pending(at("2024-01-01 00:04:00")) == [
        Cycle.of("2023-12-31 23:50:00", "2024-01-01 00:00:00")]
    house.full_load(at("2024-01-01 00:04:00"))
    assert house.pending(at("2024-01-01 00:09:59")) == []
    assert house.catch_up(at("2024-01-01 00:09:59")) is None
    shop.tables = {"item": spark.createDataFrame(rows, "id int, ts timestamp_ntz")}
    missed = house.pending(at("2024-01-01 00:31:00"))
    assert [c.start.minute for c in missed] == [0, 10, 20]
    assert house.catch_up(at("2024-01-01 00:31:00")) == Cycle(missed[0].start, missed[-1].upto)
    assert sorted(r["id"] for r in house.dw.read("item_dim").collect()) == list(range(6))
    assert house.pending(at("2024-01-01 00:31:00")) == []
    # A row committed late, with an older time, is found by reaching back.
    late = spark.createDataFrame([(99, at("2024-01-01 00:25:00"))], "id int, ts timestamp_ntz")
    shop.tables = {"item": shop.tables["item"].union(late)}
    house.lookback = timedelta(minutes=10)
    house.catch_up(at("2024-01-01 00:41:00"))
    assert sorted(r["id"] for r in house.dw.read("item_dim").collect()) == [*range(8), 99]


def test_sources(spark, folder):
    spark.range(3).write.parquet(f"{folder}/items.parquet")
    assert parquet_source(spark, folder)("items").count() == 3
    spark.sql("CREATE DATABASE IF NOT EXISTS shop2")
    try:
        spark.sql(f"CREATE TABLE shop2.items USING parquet LOCATION '{folder}/items.parquet'")
        assert catalog_source(spark, "shop2")("items").count() == 3
        assert base_tables(spark, "shop2") == ["items"]
    finally:
        spark.sql("DROP DATABASE shop2 CASCADE")


def test_jdbc_options():
    """The options of a read; no database is at hand to run it."""
    seen = []

    class Reader:
        def format(self, name):
            seen.append(name)
            return self

        def options(self, **given):
            seen.append(given)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    split = {"film": ("film_id", "1", "900", 4)}
    source = jdbc_source(Session(), "jdbc:x://host/shop", {"user": "reader"}, split)
    assert source("city") == "frame" and source("film") == "frame"
    whole = {"url": "jdbc:x://host/shop", "preferTimestampNTZ": "true", "user": "reader"}
    parts = {"partitionColumn": "film_id", "lowerBound": "1", "upperBound": "900",
             "numPartitions": "4"}
    assert seen == ["jdbc", {**whole, "dbtable": "public.city"},
                    "jdbc", {**whole, "dbtable": "public.film"}, parts]


def test_unknown_scope(spark, folder):
    with pytest.raises(ValueError):
        Warehouse(spark, folder, Shop({}), qualifier_scope="all")


def test_what_left_the_source_leaves_the_warehouse(spark, folder):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, folder, shop)
    house.full_load(FULL_LOAD_AT)
    shop.tables = rental.changed(shop.tables)
    house.run_cycle(rental.CYCLE)
    after = dict(shop.tables)
    for name, gone in {"film_actor": "actor_id = 52 and film_id = 1", "film_category": "category_id = 4 and film_id = 41",
                       "inventory": "inventory_id = 1", "store": "store_id = 2", "actor": "actor_id = 52",
                       "payment": "payment_id = 1"}.items():
        after[name] = after[name].where(f"not ({gone})")
    shop.tables = after
    found = house.remove_gone(at("2025-01-01"))
    assert bag(found) == Counter([(n, 1) for n in (
        "actor", "film_actor", "film_category", "inventory", "payment", "store")])
    rebuilt = Warehouse(spark, f"{folder}/again", shop)
    rebuilt.full_load(at("2025-01-01"))
    for name in ("film_fact", "inventory_fact", "store_dim", "category_dim", "film_dim"):
        assert bag(house.dw.read(name)) == bag(rebuilt.dw.read(name)), name
    assert bag(house.dw.read("actor_dim"), "actor_id") == bag(rebuilt.dw.read("actor_dim"), "actor_id")
    for spec in SOURCES:
        assert bag(house.staging.read(spec.name)) == bag(shop(spec.name)), spec.name
    assert house.remove_gone(at("2025-01-01")).count() == 0


def test_an_unfinished_removal_is_taken_up(spark, folder, monkeypatch):
    shop = Shop(rental.tables(spark))
    house = Warehouse(spark, folder, shop)
    house.full_load(FULL_LOAD_AT)
    whole = shop.tables
    shop.tables = {**whole, "inventory": whole["inventory"].where("inventory_id = 2"),
                   "category": whole["category"].where("category_id <> 4")}
    remove = ZoneTable.remove

    def broken(self, keys_of):
        if self.path.endswith("inventory_fact"):
            raise OSError("lost")
        return remove(self, keys_of)

    monkeypatch.setattr(ZoneTable, "remove", broken)
    with pytest.raises(CycleFailed, match="inventory_fact: lost"):
        house.remove_gone(at("2025-01-01"))
    monkeypatch.setattr(ZoneTable, "remove", remove)
    # A row that came back meanwhile stays.
    shop.tables = {**shop.tables, "inventory": whole["inventory"]}
    assert bag(house.remove_gone(at("2025-01-01"))) == Counter([("category", 1)])
    assert bag(house.dw.read("inventory_fact")) == bag(whole["inventory"])


def test_all_base_tables_are_copied(spark, folder):
    tables = rental.tables(spark)
    for name, df in tables.items():
        df.write.parquet(f"{folder}/shop/{name}.parquet")
    spark.range(4).write.parquet(f"{folder}/shop/notes.parquet")
    house = Warehouse(spark, f"{folder}/house", parquet_source(spark, f"{folder}/shop"))
    house.full_load(FULL_LOAD_AT)
    assert sorted(house.raw.tables()) == sorted([*tables, "notes"])
    assert bag(house.raw.read("notes")) == bag(spark.range(4)) == bag(house.staging.read("notes"))
    house.full_load(FULL_LOAD_AT)
    house.run_cycle(rental.CYCLE)


def test_a_cycle_reads_its_source_as_it_was_at_the_start(spark, folder):
    def write(name, rows):
        spark.createDataFrame(rows, "k bigint, last_update timestamp_ntz").write.mode("append").parquet(
            f"{folder}/shop/{name}.parquet")

    for name in ("a", "b"):
        write(name, [(1, rental.INSIDE)])
    source = parquet_source(spark, f"{folder}/shop")
    specs = [TableSpec("a", ("k",)), TableSpec("b", ("k",))]
    house = Warehouse(spark, f"{folder}/house", source, specs, [], parallel=1)
    house.full_load(FULL_LOAD_AT)
    assert house.staging.read("b").count() == 1
    write("a", [(2, rental.INSIDE)])
    write("b", [(2, rental.INSIDE)])
    each = house._each

    def late(step, cycle, items, work, windows=None):
        # Rows that arrive while the cycle runs.
        if step.endswith("/raw"):
            write("b", [(3, rental.INSIDE)])
        return each(step, cycle, items, work, windows)

    house._each = late
    assert bag(house.extract_load(rental.CYCLE), "table_name", "n") == Counter([("a", 2), ("b", 2)])
    house._each = each
    assert bag(house.extract_load(rental.CYCLE), "table_name", "n") == Counter([("a", 2), ("b", 3)])
