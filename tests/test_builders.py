import random
from collections import Counter
from datetime import timedelta

import pytest
from helpers import at, bag
from pyspark.sql import functions as F

from tidewright.functions.windows import Cycle
from tidewright.operators.builders import bridge, lookup, qualifier, snowflake
from tidewright.operators.skew import HotKeys
from tidewright.operators.timed import Timed, join_changed

CYCLE = Cycle.of("2024-01-01", "2024-02-01")
EVERYTHING = Cycle.of("1900-01-01", "2100-01-01")


def inside(t):
    return t is not None and CYCLE.start <= t < CYCLE.upto


def latest(*times):
    known = [t for t in times if t is not None]
    return max(known) if known else None


def times(seed):
    rng = random.Random(seed)
    pool = [CYCLE.start, CYCLE.upto, CYCLE.start - timedelta(microseconds=1),
            CYCLE.upto - timedelta(microseconds=1), at("2024-01-15"), None]
    old = [at("2023-01-01") + timedelta(days=d) for d in range(30)]
    return rng, lambda: rng.choice(pool if rng.random() < 0.5 else old)


# Limits that force the broadcast form and the shuffled form.
FORMS = [1 << 20, 0]


@pytest.fixture(scope="module")
def linked(spark):
    """Links, entities, other links and their table, with a film that has a third of them."""
    rng, time = times(5)

    def film():
        return 1 if rng.random() < 0.33 else rng.randrange(2, 40)

    fa = {(film(), a): time() for a in range(300)}
    fc = {(film(), rng.randrange(30)): time() for _ in range(150)}
    f = {i: time() for i in range(1, 36)}
    c = {i: time() for i in range(28)}
    rows = {
        "fa": [(k[0], k[1], t) for k, t in fa.items()],
        "fc": [(k[0], k[1], t) for k, t in fc.items()],
        "f": list(f.items()),
        "c": list(c.items()),
    }
    schemas = {"fa": "film_id int, actor_id int, fa_ts timestamp_ntz",
               "fc": "film_id int, category_id int, fc_ts timestamp_ntz",
               "f": "film_id int, f_ts timestamp_ntz", "c": "category_id int, c_ts timestamp_ntz"}
    frames = {n: Timed(spark.createDataFrame(r, schemas[n]).cache(), (f"{n}_ts",))
              for n, r in rows.items()}
    full = [
        (film, a, cat, (t, f[film], u, c[cat]))
        for (film, a), t in fa.items() for (other, cat), u in fc.items()
        if film == other and film in f and cat in c
    ]
    return frames, full


def build_bridge(frames, cycle=None, **options):
    return bridge(frames["fa"], frames["f"], frames["fc"], frames["c"], "film_id", "category_id",
                  ["film_id", "actor_id", "category_id"], "last_update", cycle, **options)


@pytest.mark.parametrize("min_rows", [0, None])
def test_bridge_full(linked, min_rows):
    frames, full = linked
    want = Counter((f, a, c, latest(*ts)) for f, a, c, ts in full)
    assert bag(build_bridge(frames, min_rows=min_rows)) == want


@pytest.mark.parametrize("min_rows", [0, None])
@pytest.mark.parametrize("limit", FORMS)
def test_bridge_delta(linked, min_rows, limit):
    frames, full = linked
    want = Counter((f, a, c, latest(*ts)) for f, a, c, ts in full if any(map(inside, ts)))
    got = bag(build_bridge(frames, CYCLE, limit=limit, min_rows=min_rows))
    assert want and sum(want.values()) < len(full) and got == want


def test_bridge_with_quiet_other_table(linked):
    frames, full = linked
    quiet = Timed(frames["c"].df.withColumn("c_ts", F.lit(None).cast("timestamp_ntz")), ("c_ts",))
    want = Counter(
        (f, a, c, latest(*ts[:3])) for f, a, c, ts in full if any(map(inside, ts[:3])))
    assert bag(build_bridge({**frames, "c": quiet}, CYCLE, min_rows=0)) == want


def test_film_without_actor_or_category_has_no_row(spark):
    fa = spark.createDataFrame([(1, 1)], "film_id int, actor_id int")
    fc = spark.createDataFrame([(2, 1)], "film_id int, category_id int")
    f = spark.createDataFrame([(1,), (2,)], "film_id int")
    c = spark.createDataFrame([(1,)], "category_id int")
    stamp = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    frames = {n: Timed(df.withColumn(f"{n}_ts", stamp), (f"{n}_ts",))
              for n, df in {"fa": fa, "fc": fc, "f": f, "c": c}.items()}
    assert build_bridge(frames).count() == 0
    assert build_bridge(frames, CYCLE).count() == 0


@pytest.fixture(scope="module")
def looked_up(spark):
    rng, time = times(11)
    rows = [(i, None if i % 41 == 0 else rng.randrange(12), time()) for i in range(300)]
    names = [(k, f"n{k}", time()) for k in range(10)]
    return (
        Timed(spark.createDataFrame(rows, "id int, k int, r_ts timestamp_ntz").cache(), ("r_ts",)),
        Timed(spark.createDataFrame(names, "k int, name string, n_ts timestamp_ntz").cache(),
              ("n_ts",)),
        [(i, n, t, u) for i, k, t in rows for k2, n, u in names if k == k2],
    )


def test_lookup_full_drops_rows_without_entry(looked_up):
    rows, names, both = looked_up
    got = bag(lookup(rows, names, ["k"], ["id", "name"], "last_update"))
    assert got == Counter((i, n, latest(t, u)) for i, n, t, u in both)


@pytest.mark.parametrize("limit", FORMS)
def test_lookup_delta_any_side(looked_up, limit):
    rows, names, both = looked_up
    got = bag(lookup(rows, names, ["k"], ["id", "name"], "last_update", CYCLE, limit))
    want = Counter((i, n, latest(t, u)) for i, n, t, u in both if inside(t) or inside(u))
    assert got == want


def test_join_changed_with_hot_keys(looked_up):
    rows, names, both = looked_up
    hashes = HotKeys({
        r[0]: 1 for r in rows.df.select(F.xxhash64("k")).distinct().collect()})
    got = join_changed(rows, names, ["k"], CYCLE, limit=None, hot_left=hashes, hot_right=hashes)
    want = Counter((i, n) for i, n, t, u in both if inside(t) or inside(u))
    assert bag(got, "id", "name") == want


def test_lookup_shuffles_no_large_side(looked_up):
    rows, names, _ = looked_up
    plan = lookup(rows, names, ["k"], ["id", "name"], "last_update", CYCLE) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("quiet", ["rows", "names", "both"])
def test_side_without_changes_is_not_scanned(looked_up, quiet):
    def calm(t):
        return Timed(t.df.withColumn(t.ts[0], F.lit("2020-01-01").cast("timestamp_ntz")), t.ts)

    rows, names, both = looked_up
    got = lookup(calm(rows) if quiet != "names" else rows, calm(names) if quiet != "rows" else names,
                 ["k"], ["id", "name"], "last_update", CYCLE)
    hits = {"rows": lambda t, u: inside(u), "names": lambda t, u: inside(t),
            "both": lambda t, u: False}[quiet]
    assert bag(got, "id", "name") == Counter((i, n) for i, n, t, u in both if hits(t, u))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join") == (0 if quiet == "both" else 1)


@pytest.fixture(scope="module")
def chain(spark):
    rng, time = times(3)
    store = [(i, rng.randrange(14), time()) for i in range(80)]
    address = [(i, rng.randrange(7), time()) for i in range(12)]
    city = [(i, rng.randrange(4), time()) for i in range(6)]
    country = [(i, time()) for i in range(3)]

    def frame(rows, schema, ts):
        return Timed(spark.createDataFrame(rows, schema).cache(), (ts,))

    lookups = [
        (frame(address, "ad int, ci int, ad_ts timestamp_ntz", "ad_ts"), ["ad"]),
        (frame(city, "ci int, co int, ci_ts timestamp_ntz", "ci_ts"), ["ci"]),
        (frame(country, "co int, co_ts timestamp_ntz", "co_ts"), ["co"]),
    ]
    stores = frame(store, "st int, ad int, st_ts timestamp_ntz", "st_ts")
    joined = [
        (s, a, ci, co, t, (t1, t2, t3))
        for s, a, t in store for a2, ci, t1 in address if a == a2
        for ci2, co, t2 in city if ci == ci2 for co2, t3 in country if co == co2
    ]
    return stores, lookups, joined


def build_snowflake(chain, *options, **more):
    return bag(snowflake(chain[0], chain[1], ["st", "ad", "ci", "co"], "lu", *options, **more))


def as_rows(joined):
    return Counter((*r[:4], latest(r[4], *r[5])) for r in joined)


def test_snowflake_full(chain):
    assert build_snowflake(chain) == as_rows(chain[2])


@pytest.mark.parametrize("limit", FORMS)
def test_snowflake_or(chain, limit):
    want = as_rows([r for r in chain[2] if inside(r[4]) or inside(latest(*r[5]))])
    assert want and build_snowflake(chain, CYCLE, limit=limit) == want


@pytest.mark.parametrize("limit", FORMS)
def test_snowflake_and(chain, limit):
    want = as_rows([r for r in chain[2] if inside(r[4]) and any(map(inside, r[5]))])
    assert want and build_snowflake(chain, CYCLE, both=True, limit=limit) == want


def test_snowflake_forms_differ(spark):
    """A store that stayed while its city changed; and a city outdone by a later address."""
    inside_, old, late = at("2024-01-15"), at("2023-01-01"), at("2024-03-01")

    def one(ts, address_ts):
        store = spark.createDataFrame([(1, 1, old)], "st int, ad int, st_ts timestamp_ntz")
        address = spark.createDataFrame([(1, 1, address_ts)], "ad int, ci int, ad_ts timestamp_ntz")
        city = spark.createDataFrame([(1, ts)], "ci int, ci_ts timestamp_ntz")
        lookups = [(Timed(address, ("ad_ts",)), ["ad"]), (Timed(city, ("ci_ts",)), ["ci"])]
        args = (Timed(store, ("st_ts",)), lookups, ["st"], "lu", CYCLE)
        return snowflake(*args, both=True).count(), snowflake(*args).count()

    assert one(inside_, old) == (0, 1)
    assert one(inside_, late) == (0, 0)


ACTORS = [
    (1, "A", "B", "2023-01-01"), (2, "A", "B", "2024-01-10"), (3, "A", "B", "2024-01-11"),
    (4, "C", "D", "2024-01-12"), (5, "C", "D", "2023-01-01"), (6, None, "E", "2023-01-01"),
    (7, None, "E", "2023-01-01"), (8, "F", "G", "2023-01-01"),
]


@pytest.fixture(scope="module")
def actors(spark):
    return spark.createDataFrame(
        [(i, a, b, at(t)) for i, a, b, t in ACTORS],
        "id int, first string, last string, ts timestamp_ntz",
    )


def numbers(df):
    return {r["id"]: r["qualifier"] for r in df.collect()}


@pytest.mark.parametrize("min_rows", [0, None])
def test_qualifier(actors, min_rows):
    got = qualifier(actors, "id", ["first", "last"], "ts", min_rows=min_rows)
    assert got.columns == ["id", "first", "last", "qualifier", "ts"]
    assert dict(got.dtypes)["qualifier"] == "bigint"
    assert numbers(got) == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2, 6: 1, 7: 2, 8: None}


def test_qualifier_delta_sees_the_delta_only(actors):
    got = qualifier(actors, "id", ["first", "last"], "ts", CYCLE)
    assert numbers(got) == {2: 1, 3: 2, 4: None}


def test_qualifier_by_group_sees_old_and_new_names(spark, actors):
    dim = qualifier(actors, "id", ["first", "last"], "ts")
    renamed = actors.withColumn("first", F.when(F.col("id") == 7, "F").otherwise(F.col("first"))) \
        .withColumn("last", F.when(F.col("id") == 7, "G").otherwise(F.col("last"))) \
        .withColumn("ts", F.when(F.col("id") == 7, F.lit("2024-01-20").cast("timestamp_ntz"))
                    .otherwise(F.lit("2023-01-01").cast("timestamp_ntz")))
    got = qualifier(renamed, "id", ["first", "last"], "ts", CYCLE, current=dim)
    assert numbers(got) == {6: None, 7: 1, 8: 2}


def test_full_is_delta_over_everything(linked, looked_up, chain, actors):
    def untimed(t):
        filled = t.df
        for column in t.ts:
            filled = filled.withColumn(
                column, F.coalesce(column, F.lit("2020-01-01").cast("timestamp_ntz")))
        return Timed(filled, t.ts)

    frames = {n: untimed(t) for n, t in linked[0].items()}
    assert bag(build_bridge(frames)) == bag(build_bridge(frames, EVERYTHING))
    rows, names = untimed(looked_up[0]), untimed(looked_up[1])
    args = (rows, names, ["k"], ["id", "name"], "lu")
    assert bag(lookup(*args)) == bag(lookup(*args, EVERYTHING))
    filled = (untimed(chain[0]), [(untimed(t), on) for t, on in chain[1]])
    assert build_snowflake(filled) == build_snowflake(filled, EVERYTHING)
    args = (actors, "id", ["first", "last"], "ts")
    assert bag(qualifier(*args)) == bag(qualifier(*args, EVERYTHING))


def test_bridge_spreads_an_entity_with_many_links(spark):
    old = F.lit("2023-01-01").cast("timestamp_ntz")

    def links(n, column):
        rows = spark.range(n).select(
            F.lit(7).alias("film_id"), F.col("id").alias(column), old.alias("ts_" + column))
        made = rows.union(rows.limit(1).withColumn("film_id", F.lit(8)))
        return Timed(made, ("ts_" + column,))

    def table(rows, column):
        return Timed(rows.select(column, old.alias("t_" + column)).distinct(), ("t_" + column,))

    fa, fc = links(2000, "actor_id"), links(2000, "category_id")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        made = bridge(fa, table(fa.df, "film_id"), fc, table(fc.df, "category_id"),
                      "film_id", "category_id", ["film_id", "actor_id", "category_id"], "ts")
        sizes = made.groupBy(F.spark_partition_id()).count().collect()
        assert made.distinct().count() == 4_000_001
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    counts = [r["count"] for r in sizes]
    assert sum(counts) == 4_000_001 and len(counts) > 16 and max(counts) < 800_000
