"""The operators applied to the test tables, one function per query.

The tables stand in for a source database: orders, lineitem and events carry a change time;
customer, nation, region and supplier have none, so one is derived from the key.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.windows import (
    CYCLE_MINUTES,
    Cycle,
    floor_to_cycle,
    in_cycle,
    instant,
    shift,
)
from tidewright.operators.builders import (
    bridge,
    lookup,
    passthrough,
    qualifier,
    snowflake,
)
from tidewright.operators.change import (
    append,
    delete_by_key,
    insert_rows,
    newest_per_key,
    update_where,
    upsert,
)
from tidewright.operators.quality import (
    ERROR,
    WARNING,
    Check,
    check_counts,
    check_samples,
    check_verdicts,
    childless_since,
    duplicate_keys,
    duplicate_uniques,
    null_keys,
    orphans,
    sample,
)
from tidewright.operators.removals import removed
from tidewright.operators.reports import (
    changed_tables,
    cycle_counts,
    schema_ddl,
    table_row_counts,
    zone_schema,
)
from tidewright.operators.signed import bridge_change, counted, signed, with_change
from tidewright.operators.sizing import broadcast_if_small
from tidewright.operators.timed import Timed, timed, timed_table
from tidewright.plans.checks import checks_from_files
from tidewright.plans.cycle import Warehouse
from tidewright.session import work_folder
from tidewright.sources.dependents import Affected, Dependents, Link
from tidewright.sources.extract import delta, parquet_source, snapshot
from tidewright.sources.numbers import Numbering
from tidewright.sources.references import References
from tidewright.sources.specs import TableSpec, TargetSpec
from tidewright.sources.zones import Zone, ZoneTable
from tidewright.streaming.counts import counts_table, cycle_counts_stream
from tidewright.streaming.newest import newest_stream
from tidewright.streaming.upserts import upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

HALF_YEAR = Cycle.of("2000-01-01", "2000-07-01")
MARCH = datetime(2000, 3, 1)


def _without_new(df: DataFrame, ts: str, upto: datetime = HALF_YEAR.upto) -> DataFrame:
    """An earlier state: every row but those that are new from March on within a window."""
    return df.where((F.col(ts) < instant(MARCH)) | (F.col(ts) >= instant(upto)))
EPOCH = datetime(1995, 1, 1)
QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("query_")] = fn
    return fn


def _days_after_epoch(days: Column) -> Column:
    return instant(EPOCH) + F.make_dt_interval(days.cast("int"))


def _customers(source) -> DataFrame:
    return source("customer").withColumn("c_ts", _days_after_epoch(F.col("c_custkey") % 2400))


# Scans, snapshots, deltas and reports


@_query
def snapshot_full(spark: SparkSession, folder: str) -> DataFrame:
    return snapshot(parquet_source(spark, folder)("orders"))


@_query
def delta_extract(spark: SparkSession, folder: str) -> DataFrame:
    return delta(parquet_source(spark, folder)("orders"), "o_orderdate", HALF_YEAR)


@_query
def query_changed_tables(spark: SparkSession, folder: str) -> DataFrame:
    read = parquet_source(spark, folder)
    specs = [
        TableSpec("orders", ("o_orderkey",), "o_orderdate"),
        TableSpec("lineitem", ("l_orderkey", "l_linenumber"), "l_shipdate"),
        TableSpec("events", ("event_id",), "ts"),
    ]
    return changed_tables(
        {s.name: (delta(read(s.name), s.ts, HALF_YEAR), s.keys) for s in specs}
    )



@_query
def query_table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    read = parquet_source(spark, folder)
    return table_row_counts({name: read(name) for name in ("orders", "lineitem", "nation")})



@_query
def query_schema_ddl(spark: SparkSession, folder: str) -> DataFrame:
    parts = parquet_source(spark, folder)("part")
    catalog = parts.groupBy("p_brand", "p_type").agg(F.max("p_size").alias("p_size"))
    named = catalog.withColumn("table_name", F.concat(F.lit("r."), F.col("p_brand")))
    return schema_ddl(named, "table_name", "p_type", "p_size", "p_type")



@_query
def zone_schema_ddl(spark: SparkSession, folder: str) -> DataFrame:
    """Table definitions of a zone that three tables were copied to."""
    read, zone = parquet_source(spark, folder), Zone(spark, work_folder(spark, "raw"))
    for name in ("customer", "orders", "lineitem"):
        zone.table(name).replace(snapshot(read(name)))
    return zone_schema(zone, "raw")


@_query
def append_assigned(spark: SparkSession, folder: str) -> DataFrame:
    """Appending by position into other types: whole numbers to decimals, dates to times, longs to ints."""
    read = parquet_source(spark, folder)
    orders = read("orders").select(
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount"), F.col("o_orderdate").alias("at"),
        F.col("o_custkey").cast("int").alias("who"), F.col("o_orderstatus").alias("note"))
    lines = read("lineitem").select(
        F.col("l_orderkey").cast("bigint"), F.col("l_shipdate").cast("date"),
        F.col("l_suppkey").cast("bigint"), F.col("l_linenumber").cast("bigint"))
    return append(orders, lines)


@_query
def cycle_window(spark: SparkSession, folder: str) -> DataFrame:
    upto = floor_to_cycle("ts")
    return parquet_source(spark, folder)("events").select(
        "event_id",
        shift(upto, -timedelta(minutes=CYCLE_MINUTES)).alias("cycle_from"),
        upto.alias("cycle_upto"),
    )


@_query
def query_cycle_counts(spark: SparkSession, folder: str) -> DataFrame:
    return cycle_counts(parquet_source(spark, folder)("events"), "ts")



# Keyed change


@_query
def query_delete_by_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_source(spark, folder)("orders")
    return delete_by_key(orders, delta(orders, "o_orderdate", HALF_YEAR), ["o_orderkey"])



@_query
def append_positional(spark: SparkSession, folder: str) -> DataFrame:
    read = parquet_source(spark, folder)
    orders = read("orders").select("o_orderkey", "o_custkey")
    return append(orders, read("lineitem").select("l_orderkey", "l_partkey"))


@_query
def upsert_single_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_source(spark, folder)("orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate"
    )
    target = _without_new(orders, "o_orderdate")
    source = delta(orders, "o_orderdate", HALF_YEAR).withColumn("o_orderstatus", F.lit("X"))
    return upsert(target, source, ["o_orderkey"])


@_query
def upsert_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"]
    lines = parquet_source(spark, folder)("lineitem").select(*columns, "l_shipdate")
    target = _without_new(lines, "l_shipdate").select(*columns)
    source = delta(lines, "l_shipdate", HALF_YEAR).withColumn("l_returnflag", F.lit("X"))
    return upsert(target, source.select(*columns), ["l_orderkey", "l_linenumber"])


@_query
def upsert_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = parquet_source(spark, folder)("customer")

    def keyed(no_key_in: str, value: Column) -> DataFrame:
        key = F.when(F.col("c_mktsegment") != no_key_in, F.col("c_custkey")).alias("k")
        return customers.select(key, F.col("c_nationkey").alias("j"), value.alias("v"),
                                "c_acctbal")

    target = keyed("BUILDING", F.col("c_name")).drop("c_acctbal")
    source = keyed("MACHINERY", F.lit("new")).where(F.col("c_acctbal") < 0).drop("c_acctbal")
    return upsert(target, source, ["k", "j"])


@_query
def keyed_update(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_source(spark, folder)("orders").select("o_orderkey", "o_orderstatus")
    return update_where(orders, F.col("o_orderkey") == 4, {"o_orderstatus": "Z"})


@_query
def insert_with_defaults(spark: SparkSession, folder: str) -> DataFrame:
    customers = parquet_source(spark, folder)("customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    rows = [(97000001, "Quayside"), (97000002, "Millpond", 3)]
    return insert_rows(customers, rows, defaults={"c_mktsegment": "NONE"})


@_query
def newest_event_per_user(spark: SparkSession, folder: str) -> DataFrame:
    events = parquet_source(spark, folder)("events")
    return newest_per_key(events, ["user_id"], ["ts", "event_id"])


# Dimensions and facts

_NAMES = ["o_custkey", "o_orderpriority"]


def _order_qualifier(orders: DataFrame, cycle: Cycle | None = None, **options) -> DataFrame:
    return qualifier(orders, "o_orderkey", _NAMES, "o_orderdate", cycle, **options)


@_query
def dim_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    return passthrough(parquet_source(spark, folder)("orders"), "o_orderdate", HALF_YEAR)


@_query
def fact_passthrough_full(spark: SparkSession, folder: str) -> DataFrame:
    return passthrough(parquet_source(spark, folder)("lineitem"), "l_shipdate")


@_query
def dim_qualifier_full(spark: SparkSession, folder: str) -> DataFrame:
    return _order_qualifier(parquet_source(spark, folder)("orders"))


@_query
def dim_qualifier_delta(spark: SparkSession, folder: str) -> DataFrame:
    return _order_qualifier(parquet_source(spark, folder)("orders"), HALF_YEAR)


@_query
def dim_qualifier_groups(spark: SparkSession, folder: str) -> DataFrame:
    """A merge whose delta renumbers every touched name group: equal to a full build."""
    orders = parquet_source(spark, folder)("orders")
    dw = _order_qualifier(_without_new(orders, "o_orderdate"))
    return upsert(dw, _order_qualifier(orders, HALF_YEAR, current=dw), ["o_orderkey"])


@_query
def dim_qualifier_state(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers from the state of each name group: newcomers get those after the highest.

    Before the half year's changes, the orders of its first months have the lowest priority.
    """
    orders = parquet_source(spark, folder)("orders")
    early = in_cycle("o_orderdate", Cycle(HALF_YEAR.start, MARCH))
    before = _without_new(orders, "o_orderdate").withColumn(
        "o_orderpriority", F.when(early, "5-LOW").otherwise(F.col("o_orderpriority")))
    numbers = Numbering(spark, work_folder(spark, "numbers"), "o_orderkey", _NAMES, "o_orderdate")
    numbers.start(_order_qualifier(before))
    numbers.apply(delta(orders, "o_orderdate", HALF_YEAR))
    return numbers.read()


def _lines_with_priority(spark: SparkSession, folder: str, cycle: Cycle | None) -> DataFrame:
    read = parquet_source(spark, folder)
    lines = timed(read("lineitem"), "l_shipdate", "l_ts",
                  ["l_orderkey", "l_linenumber", "l_partkey"])
    orders = read("orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return lookup(
        lines,
        timed(orders, "o_orderdate", "o_ts", ["l_orderkey", "o_orderpriority"]),
        ["l_orderkey"],
        ["l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority"],
        "last_update",
        cycle,
    )


@_query
def lookup_mixed_types(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup whose key is narrower in one table than in the other."""
    read = parquet_source(spark, folder)
    orders = read("orders").select(
        F.col("o_orderkey").cast("int").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return lookup(
        timed(read("lineitem"), "l_shipdate", "l_ts", ["l_orderkey", "l_linenumber", "l_partkey"]),
        timed(orders, "o_orderdate", "o_ts", ["l_orderkey", "o_orderpriority"]),
        ["l_orderkey"],
        ["l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority"],
        "last_update",
    )


@_query
def delete_mixed_types(spark: SparkSession, folder: str) -> DataFrame:
    """A delete by keys that are decimals in the list and whole numbers in the table."""
    orders = parquet_source(spark, folder)("orders")
    gone = delta(orders, "o_orderdate", HALF_YEAR).select(
        F.col("o_orderkey").cast("decimal(12,0)").alias("o_orderkey"))
    return delete_by_key(orders, gone, ["o_orderkey"])


@_query
def dim_lookup_full(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_with_priority(spark, folder, None)


@_query
def dim_lookup_delta(spark: SparkSession, folder: str) -> DataFrame:
    return _lines_with_priority(spark, folder, HALF_YEAR)


def _orders_with_place(
    spark: SparkSession, folder: str, cycle: Cycle | None, both: bool = False
) -> DataFrame:
    read = parquet_source(spark, folder)
    customers = timed(_customers(read), "c_ts", "customer_ts",
                      ["c_custkey", "c_name", "c_nationkey"])
    nations = Timed(
        read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey",
            _days_after_epoch(F.col("n_nationkey") * 90).alias("nation_ts"),
        ),
        ("nation_ts",),
    )
    regions = Timed(
        read("region").select(
            F.col("r_regionkey").alias("n_regionkey"), "r_name",
            _days_after_epoch(F.col("r_regionkey") * 450).alias("region_ts"),
        ),
        ("region_ts",),
    )
    orders = read("orders").withColumnRenamed("o_custkey", "c_custkey")
    return snowflake(
        timed(orders, "o_orderdate", "order_ts", ["o_orderkey", "c_custkey"]),
        [(customers, ["c_custkey"]), (nations, ["c_nationkey"]), (regions, ["n_regionkey"])],
        ["o_orderkey", "c_custkey", "c_name", "n_name", "r_name"],
        "last_update",
        cycle,
        both,
    )


@_query
def dim_snowflake_full(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_with_place(spark, folder, None)


@_query
def dim_snowflake_delta_and(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_with_place(spark, folder, HALF_YEAR, both=True)


@_query
def dim_snowflake_delta_or(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_with_place(spark, folder, HALF_YEAR)


@_query
def dim_snowflake_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same delta from staged tables, with an index from customers and nations to orders.

    The half year's orders are merged into the staged ones and into the index first.
    """
    read, zone = parquet_source(spark, folder), Zone(spark, work_folder(spark, "staged"))
    orders = read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"),
                                   F.col("o_orderdate").alias("ts"))
    tables = {
        "orders": _without_new(orders, "ts"),
        "customer": _customers(read).select("c_custkey", "c_name", "c_nationkey", F.col("c_ts").alias("ts")),
        "nation": read("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey",
            _days_after_epoch(F.col("n_nationkey") * 90).alias("ts")),
        "region": read("region").select(
            F.col("r_regionkey").alias("n_regionkey"), "r_name",
            _days_after_epoch(F.col("r_regionkey") * 450).alias("ts")),
    }
    for name, table in tables.items():
        zone.table(name, [table.columns[0]], "ts").replace(table)
    index = Dependents(spark, work_folder(spark, "index"), [
        Link("orders", "o_orderkey", "c_custkey"), Link("customer", "c_custkey", "c_nationkey"),
        Link("nation", "c_nationkey", "n_regionkey")])
    index.start({x.table: zone.read(x.table) for x in index.links})
    fresh = delta(orders, "ts", HALF_YEAR)
    index.apply("orders", fresh)
    zone.table("orders", ["o_orderkey"], "ts").upsert(fresh)

    affected = Affected(zone, index, "region", "ts", HALF_YEAR)
    rows, *lookups = [timed_table(affected, name, "ts", f"{name}_ts") for name in tables]
    return snowflake(
        rows,
        [(table, [key]) for table, key in zip(
            lookups, ["c_custkey", "c_nationkey", "n_regionkey"], strict=True)],
        ["o_orderkey", "c_custkey", "c_name", "n_name", "r_name"],
        "last_update",
        HALF_YEAR,
    )


def _film_fact(spark: SparkSession, folder: str, cycle: Cycle | None) -> DataFrame:
    read = parquet_source(spark, folder)
    lines = read("lineitem")

    def links(other: str, name: str, ts: str) -> Timed:
        keys = [F.col("l_orderkey").alias("film_id"), F.col(other).alias(name)]
        grouped = lines.groupBy(*keys).agg(F.max("l_shipdate").alias(ts))
        return Timed(grouped, (ts,), probe=lines.select(*keys))

    orders = read("orders").withColumnRenamed("o_orderkey", "film_id")
    suppliers = read("supplier").select(
        F.col("s_suppkey").alias("category_id"),
        _days_after_epoch(F.col("s_suppkey") % 100 * 24).alias("category_ts"),
    )
    return bridge(
        links("l_partkey", "actor_id", "film_actor_ts"),
        timed(orders, "o_orderdate", "film_ts", ["film_id"]),
        links("l_suppkey", "category_id", "film_category_ts"),
        Timed(suppliers, ("category_ts",)),
        "film_id",
        "category_id",
        ["film_id", "actor_id", "category_id"],
        "last_update",
        cycle,
    )


@_query
def fact_bridge_full(spark: SparkSession, folder: str) -> DataFrame:
    return _film_fact(spark, folder, None)


@_query
def fact_bridge_delta(spark: SparkSession, folder: str) -> DataFrame:
    return _film_fact(spark, folder, HALF_YEAR)


def _lines_without(lines: DataFrame, flag: str, start: str, upto: str) -> DataFrame:
    """Lines but those of a return flag that were shipped in a window."""
    gone = (F.col("l_returnflag") == flag) & in_cycle("l_shipdate", Cycle.of(start, upto))
    return lines.where(~gone)


@_query
def fact_bridge_signed(spark: SparkSession, folder: str) -> DataFrame:
    """The bridge after lines were added and others withdrawn, from the signed changes of its links.

    Before, lines flagged N of spring 2000 were not there yet; after, those flagged A or R of 1994's
    first half are gone.
    """
    lines = parquet_source(spark, folder)("lineitem")
    after = _lines_without(_lines_without(lines, "A", "1994-01-01", "1994-07-01"),
                           "R", "1994-01-01", "1994-07-01")
    before = _lines_without(lines, "N", "2000-03-01", "2000-06-01")
    spring, fall = Cycle.of("2000-03-01", "2000-06-01"), Cycle.of("1994-01-01", "1994-07-01")
    added = lines.where((F.col("l_returnflag") == "N") & in_cycle("l_shipdate", spring))
    withdrawn = lines.where(F.col("l_returnflag").isin("A", "R") & in_cycle("l_shipdate", fall))

    def links(df: DataFrame, other: str, name: str) -> DataFrame:
        return df.select(F.col("l_orderkey").alias("film_id"), F.col(other).alias(name))

    def side(other: str, name: str) -> tuple[DataFrame, DataFrame]:
        columns = ["film_id", name]
        return (counted(links(after, other, name), columns),
                signed(links(added, other, name), links(withdrawn, other, name), columns))

    pair = ["film_id", "actor_id", "category_id"]
    change = bridge_change(*side("l_partkey", "actor_id"), *side("l_suppkey", "category_id"), "film_id", pair)
    old_first = counted(links(before, "l_partkey", "actor_id"), ["film_id", "actor_id"], "film_id")
    old_second = counted(links(before, "l_suppkey", "category_id"), ["film_id", "category_id"], "film_id")
    facts = old_first.join(old_second.withColumnRenamed("sign", "times"), "film_id").select(
        *pair, (F.col("sign") * F.col("times")).alias("n"))
    return with_change(facts, change, pair, on="film_id")


@_query
def removed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the copy that the source no longer has: urgent ones of four months."""
    orders = parquet_source(spark, folder)("orders")
    return removed(_without_urgent(orders), orders, ["o_orderkey"])


def _without_urgent(orders: DataFrame) -> DataFrame:
    gone = (F.col("o_orderpriority") == "1-URGENT") & in_cycle(
        "o_orderdate", Cycle.of("1998-03-01", "1998-07-01"))
    return orders.where(~gone)


@_query
def removals_published(spark: SparkSession, folder: str) -> DataFrame:
    """A published table after a merge and after rows that left the source were removed from it."""
    orders = parquet_source(spark, folder)("orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    table = ZoneTable(spark, work_folder(spark, "zone"), ["o_orderkey"], "o_orderdate")
    table.replace(_without_new(orders, "o_orderdate"))
    table.upsert(delta(orders, "o_orderdate", HALF_YEAR))
    table.remove(removed(_without_urgent(orders), table.read(), ["o_orderkey"]))
    return table.read()


# Constraints and checks


@_query
def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(parquet_source(spark, folder)("lineitem"), ["l_orderkey", "l_linenumber"])


def _part_names(spark: SparkSession, folder: str) -> DataFrame:
    q = F.when(F.col("p_size") > 10, F.col("p_brand")).alias("q")
    return parquet_source(spark, folder)("part").select("p_partkey", "p_name", q)


@_query
def pk_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return null_keys(_part_names(spark, folder), ["p_partkey", "q"])


@_query
def unique_violations(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_uniques(_part_names(spark, folder), ["p_name", "q"])


def _recent_order_customers(read) -> DataFrame:
    recent = delta(read("orders"), "o_orderdate", HALF_YEAR)
    return recent.select(F.col("o_custkey").alias("c_custkey"))


@_query
def check_orphan_rows(spark: SparkSession, folder: str) -> DataFrame:
    read = parquet_source(spark, folder)
    return orphans(read("customer"), _recent_order_customers(read), ["c_custkey"])


def _stale(spark: SparkSession, folder: str, days: int) -> DataFrame:
    read = parquet_source(spark, folder)
    return childless_since(
        _customers(read), _recent_order_customers(read), ["c_custkey"], "c_ts",
        timedelta(days=days), datetime(1997, 1, 1),
    )


@_query
def check_stale_empty_1d(spark: SparkSession, folder: str) -> DataFrame:
    return _stale(spark, folder, 1)


@_query
def check_stale_empty_3d(spark: SparkSession, folder: str) -> DataFrame:
    return _stale(spark, folder, 3)


@_query
def check_summary(spark: SparkSession, folder: str) -> DataFrame:
    read = parquet_source(spark, folder)
    orders = read("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return check_counts(
        [
            Check("orphan", WARNING, lambda: check_orphan_rows(spark, folder)),
            Check("line_without_order", ERROR,
                  lambda: orphans(read("lineitem"), orders, ["l_orderkey"])),
        ]
    )


@_query
def check_maintained_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without an order, by counts that a change to the orders kept up to date.

    First the orders of spring 2000 are counted; then those of May come and those of March go.
    """
    read = parquet_source(spark, folder)
    customers = read("customer")
    orders = read("orders").withColumnRenamed("o_custkey", "c_custkey")

    def placed(start: str, upto: str) -> DataFrame:
        return delta(orders, "o_orderdate", Cycle.of(start, upto))

    checks = References(spark, work_folder(spark, "references"), "c_custkey")
    checks.start(customers, placed("2000-03-01", "2000-05-01"))
    none = customers.where(F.lit(False))
    checks.apply(1, none, none, placed("2000-05-01", "2000-06-01"), placed("2000-03-01", "2000-04-01"))
    return customers.join(
        broadcast_if_small(checks.childless()), ["c_custkey"], "left_semi").select(*customers.columns)


def _order_checks(spark: SparkSession, folder: str) -> list[Check]:
    files = Path(__file__).with_name("order_checks").as_uri()
    tables = ("customer", "orders", "lineitem")
    return checks_from_files(spark, files, parquet_source(spark, folder), tables)


@_query
def check_run(spark: SparkSession, folder: str) -> DataFrame:
    return check_verdicts(_order_checks(spark, folder))


@_query
def check_run_samples(spark: SparkSession, folder: str) -> DataFrame:
    return check_samples(_order_checks(spark, folder))


@_query
def check_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample(check_orphan_rows(spark, folder), ["c_custkey"])


# Cycles


@_query
def cycle_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    orders = parquet_source(spark, folder)("orders")
    dw = _order_qualifier(_without_new(orders, "o_orderdate"))
    return upsert(dw, _order_qualifier(orders, HALF_YEAR), ["o_orderkey"])


@_query
def zone_merged(spark: SparkSession, folder: str) -> DataFrame:
    """A published table after two merges, read back from its segments."""
    orders = parquet_source(spark, folder)("orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate"
    )

    def changed(status: str, start: str, upto: str) -> DataFrame:
        rows = delta(orders, "o_orderdate", Cycle.of(start, upto))
        return rows.withColumn("o_orderstatus", F.lit(status))

    table = ZoneTable(spark, work_folder(spark, "zone"), ["o_orderkey"])
    table.replace(_without_new(orders, "o_orderdate", datetime(2000, 9, 1)))
    table.upsert(changed("X", "2000-01-01", "2000-07-01"))
    table.upsert(changed("Y", "2000-05-01", "2000-09-01"))
    return table.read()


ORDERS = TableSpec("orders", ("o_orderkey",), "o_orderdate")
CUSTOMERS = TableSpec("customer", ("c_custkey",), "c_ts")


def _order_dim(read, cycle: Cycle | None = None) -> DataFrame:
    return lookup(
        timed_table(read, "orders", "o_orderdate", "order_ts",
                    ["o_orderkey", "o_orderstatus", "c_custkey"], renamed=("o_custkey", "c_custkey")),
        timed_table(read, "customer", "c_ts", "customer_ts", ["c_custkey", "c_name"]),
        ["c_custkey"],
        ["o_orderkey", "o_orderstatus", "c_custkey", "c_name"],
        "last_update",
        cycle,
    )


@_query
def cycle_published(spark: SparkSession, folder: str) -> DataFrame:
    """A full load, then one cycle through all zones; the dimension as published.

    Before the cycle the source shows rows of the half year in an older version, or not yet.
    """
    read = parquet_source(spark, folder)
    after = {
        "orders": read("orders"),
        "customer": _customers(read),
    }

    def earlier(df: DataFrame, ts: str, column: str, days: int) -> DataFrame:
        changing = in_cycle(ts, HALF_YEAR)
        old = shift(ts, -timedelta(days=days))
        kept = df.withColumn("__new", changing).withColumn(
            column, F.when(F.col("__new"), F.lit("old")).otherwise(F.col(column))
        ).withColumn(ts, F.when(F.col("__new"), old).otherwise(F.col(ts)))
        return kept.where(~F.col("__new") | (F.col(ts) < instant(HALF_YEAR.start))).drop("__new")

    before = {
        "orders": earlier(after["orders"], "o_orderdate", "o_orderstatus", 60),
        "customer": earlier(after["customer"], "c_ts", "c_name", 200),
    }
    state = dict(before)
    warehouse = Warehouse(
        spark,
        work_folder(spark, "cycle"),
        lambda name: state[name],
        sources=[ORDERS, CUSTOMERS],
        targets=[TargetSpec("order_dim", ("o_orderkey",))],
        builders={"order_dim": _order_dim},
    )
    warehouse.full_load(HALF_YEAR.start)
    state.update(after)
    warehouse.run_cycle(HALF_YEAR)
    return warehouse.dw.read("order_dim")


@_query
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Events merged by user, first from a batch load, then from a stream."""
    events = parquet_source(spark, folder)("events")
    work = work_folder(spark, "stream")
    table = ZoneTable(spark, f"{work}/newest_event", ["user_id"])
    first = events.where(F.col("ts") < instant(datetime(2024, 1, 15)))
    table.replace(newest_per_key(first, ["user_id"], ["ts", "event_id"]))
    # A glob of the table's own path takes a file as well as a directory of files.
    arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events.parque[t]")
    run = upsert_stream(arriving, table, ["ts", "event_id"], f"{work}/checkpoint", "newest_event")
    run.awaitTermination()
    return table.read()


@_query
def stream_upsert_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge, with the newest version of each user held as the stream's state."""
    events = parquet_source(spark, folder)("events")
    work = work_folder(spark, "stream")
    table = ZoneTable(spark, f"{work}/newest_event", ["user_id"])
    first = events.where(F.col("ts") < instant(datetime(2024, 1, 15)))
    table.replace(newest_per_key(first, ["user_id"], ["ts", "event_id"]))
    arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events.parque[t]")
    run = newest_stream(arriving, table, ["ts", "event_id"], f"{work}/checkpoint", "newest_event")
    run.awaitTermination()
    return table.read()


@_query
def stream_cycle_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events of each cycle, counted as they arrive."""
    events = parquet_source(spark, folder)("events")
    work = work_folder(spark, "stream")
    table = counts_table(spark, f"{work}/cycle_counts")
    arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events.parque[t]")
    run = cycle_counts_stream(arriving, "ts", table, f"{work}/checkpoint", "cycle_counts")
    run.awaitTermination()
    return table.read()
