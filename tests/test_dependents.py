import random

import pytest
from helpers import at, bag

from tidewright.functions.windows import Cycle
from tidewright.plans.warehouse import STORE_CHAIN as LINKS
from tidewright.plans.warehouse import store_dim
from tidewright.sources.dependents import Affected, Dependents
from tidewright.sources.zones import Zone, ZoneTable

SCHEMAS = {
    "store": "store_id int, manager_staff_id int, address_id int, last_update timestamp_ntz",
    "address": "address_id int, address string, address2 string, district string, city_id int,"
               " postal_code string, phone string, last_update timestamp_ntz",
    "city": "city_id int, city string, country_id int, last_update timestamp_ntz",
    "country": "country_id int, country string, last_update timestamp_ntz",
}
OLD = at("2023-01-01")


def row(name, key, rng, ts):
    ref = rng.choice([None, *range(6)])
    return {
        "store": (key, 1, ref, ts),
        "address": (key, f"a{rng.random()}", None, "d", ref, "p", "f", ts),
        "city": (key, f"c{rng.random()}", ref, ts),
        "country": (key, f"l{rng.random()}", ts),
    }[name]


@pytest.mark.parametrize("seed", range(2))
def test_deltas_by_the_index_equal_those_by_scans(spark, folder, seed):
    rng = random.Random(seed)
    zone = Zone(spark, f"{folder}/stg")
    keys = {x.table: [x.key] for x in LINKS} | {"country": ["country_id"]}

    def frame(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])

    for name, key in keys.items():
        rows = [row(name, k, rng, OLD) for k in range(12 if name == "store" else 6)]
        zone.table(name, key, "last_update").replace(frame(name, rows))
    index = Dependents(spark, f"{folder}/index", LINKS)
    assert not index.started()
    index.start({x.table: zone.read(x.table) for x in LINKS})
    assert index.started()
    for year, names in ((2024, ["country", "store"]), (2025, ["city", "address"])):
        ts, cycle = at(f"{year}-02-01"), Cycle.of(f"{year}-01-01", f"{year + 1}-01-01")
        for name in names:
            ids = rng.sample(range(8), 2)
            fresh = frame(name, [row(name, k, rng, ts) for k in ids])
            zone.table(name, keys[name], "last_update").upsert(fresh)
            for _ in range(2 if name != "country" else 0):
                index.apply(name, fresh)
        got = store_dim(Affected(zone, index, "country", "last_update", cycle), cycle)
        assert bag(got) == bag(store_dim(zone, cycle))


def test_keys_are_followed_down_the_chain(spark, folder):
    def pairs(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    index = Dependents(spark, folder, LINKS[1:])
    index.start({"address": pairs("address_id int, city_id int", (1, 10), (2, 10), (3, 11), (4, None)),
                 "city": pairs("city_id int, country_id int", (10, 20), (11, 21))})

    def reached(**keys):
        changed = {name: pairs(f"{key} int", *[(k,) for k in found]) for name, (key, found) in keys.items()}
        return sorted(r.address_id for r in index.reached(changed).collect())

    assert reached(country_id=("country_id", [20, 99])) == [1, 2]
    assert reached(city=("city_id", [11]), address=("address_id", [4])) == [3, 4]
    assert reached(country_id=("country_id", [])) == []
    index.apply("city", pairs("city_id int, country_id int", (10, 21), (12, None)))
    assert reached(country_id=("country_id", [20])) == []
    assert reached(country_id=("country_id", [21])) == [1, 2, 3]
    with pytest.raises(ValueError, match="no changes"):
        index.reached({})


def test_rows_of_leading_columns_come_from_few_files(spark, folder, monkeypatch):
    monkeypatch.setattr("tidewright.sources.zones.FILE_BYTES", 4000)
    table = ZoneTable(spark, folder, ["a", "b"], lead=1)
    table.replace(spark.range(4000).selectExpr("if(id % 3 = 0, 7, id % 500) a", "id b"))
    table.upsert(spark.createDataFrame([(9, 9), (9, 10000)], "a long, b long"))
    files = len({f for f in table.read().inputFiles()})
    asked = spark.createDataFrame([(9,), (None,)], "a long")
    found = table.holding(asked)
    assert files > 5 and len(set(found.inputFiles())) < files / 2
    assert bag(found) == bag(table.read().where("a = 9"))
    # The leading value that a third of the rows share lies in many files.
    assert table.holding(spark.createDataFrame([(7,)], "a long")).count() >= 1333
    table.remove(spark.createDataFrame([(9, 9)], "a long, b long"))
    table.compact()
    assert bag(table.holding(asked)) == bag(table.read().where("a = 9"))
    with pytest.raises(ValueError, match="leading"):
        ZoneTable(spark, f"{folder}/own", ["a"]).replace(spark.range(3).toDF("a")) and ZoneTable(
            spark, f"{folder}/own").holding(asked)
