"""Command line: run it with `spark-submit` or `python -m tidewright`.

    full-load                 copy every source table and build the warehouse
    extract-load [FROM UPTO]  the first half of a cycle; by default the last closed ten minutes
    transform [FROM UPTO]     the second half; by default for the cycle extracted last
    cycle [FROM UPTO]         both halves
    catch-up                  everything since the last completed cycle, as one
    remove-gone               remove what the source no longer has, by comparing keys
    checks                    run the checks; the exit code is 1 if one found an error
    status                    row counts of every zone
    schema                    statements that create the tables of the raw zone
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidewright.functions.windows import Cycle, last_closed_cycle
from tidewright.operators.reports import zone_schema
from tidewright.plans.cycle import DELTA_SCOPE, GROUP_SCOPE, STATE_SCOPE, Warehouse
from tidewright.sources.extract import Source, catalog_source, jdbc_source, parquet_source

COMMANDS = ("full-load", "extract-load", "transform", "cycle", "catch-up", "remove-gone", "checks",
            "status", "schema")


def _option(text: str) -> tuple[str, str]:
    name, given, value = text.partition("=")
    if not name or not given:
        raise argparse.ArgumentTypeError(f"not NAME=VALUE: {text}")
    return name, value


def _split(text: str) -> tuple[str, tuple[str, str, str, int]]:
    table, value = _option(text)
    try:
        column, low, high, parts = value.split(",")
        return table, (column, low, high, int(parts))
    except ValueError as problem:
        raise argparse.ArgumentTypeError(f"not TABLE=COLUMN,LOW,HIGH,PARTS: {text}") from problem


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        "tidewright", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("bounds", nargs="*", metavar="FROM UPTO")
    parser.add_argument("--root", required=True, help="folder of the zones, shared by executors")
    where = parser.add_mutually_exclusive_group()
    where.add_argument("--source-folder", help="folder of <table>.parquet")
    where.add_argument("--source-database", help="catalog database")
    where.add_argument("--source-jdbc", help="JDBC address; the driver comes with the session")
    parser.add_argument("--jdbc-schema", default="public")
    parser.add_argument("--jdbc-option", action="append", default=[], type=_option,
                        metavar="NAME=VALUE", help="such as driver, user or fetchsize; repeatable")
    parser.add_argument("--jdbc-split", action="append", default=[], type=_split,
                        metavar="TABLE=COLUMN,LOW,HIGH,PARTS",
                        help="reads a table in so many parts; repeatable")
    parser.add_argument("--checks-folder", help="folder of warnings/*.sql and errors/*.sql")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="default: now")
    parser.add_argument("--lookback-minutes", type=int, default=0)
    parser.add_argument("--qualifier-scope", choices=(DELTA_SCOPE, GROUP_SCOPE, STATE_SCOPE),
                        default=DELTA_SCOPE)
    parser.add_argument("--lookup-index", action="store_true",
                        help="find the stores that changed lookups touch by an index")
    parser.add_argument("--parallel", type=int, default=4)
    found = parser.parse_args(argv)
    if len(found.bounds) not in (0, 2):
        parser.error("give both bounds of the cycle, or none")
    if found.bounds and found.command not in ("extract-load", "transform", "cycle"):
        parser.error(f"{found.command} takes no cycle")
    return found


def _source(spark: SparkSession, args: argparse.Namespace) -> Source:
    if args.source_folder:
        return parquet_source(spark, args.source_folder)
    if args.source_database:
        return catalog_source(spark, args.source_database)
    if args.source_jdbc:
        return jdbc_source(spark, args.source_jdbc, dict(args.jdbc_option),
                           dict(args.jdbc_split), args.jdbc_schema)

    def missing(name: str):
        raise ValueError("name a source: --source-folder, --source-database or --source-jdbc")

    return missing


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName("tidewright").getOrCreate()
    house = Warehouse(
        spark,
        args.root,
        _source(spark, args),
        qualifier_scope=args.qualifier_scope,
        lookup_index=args.lookup_index,
        lookback=timedelta(minutes=args.lookback_minutes),
        parallel=args.parallel,
    )
    as_of = args.as_of or datetime.now()
    given = Cycle.of(*args.bounds) if args.bounds else None
    closed = given or last_closed_cycle(as_of, house.minutes)

    if args.command == "full-load":
        house.full_load(as_of)
    elif args.command == "extract-load":
        house.extract_load(closed).show(truncate=False)
    elif args.command == "transform":
        house.transform(given)
    elif args.command == "cycle":
        house.run_cycle(closed).show(truncate=False)
    elif args.command == "remove-gone":
        house.remove_gone(as_of).show(truncate=False)
    elif args.command == "catch-up":
        print(house.catch_up(as_of) or "nothing to catch up")
    elif args.command == "checks":
        report = house.run_checks(as_of, folder=args.checks_folder)
        report.summary.show(truncate=False)
        report.samples.show(truncate=False)
        return report.exit_code
    elif args.command == "schema":
        for line in zone_schema(house.raw, "raw").orderBy("table_name").collect():
            print(line["ddl"])
    else:
        for zone in (house.raw, house.staging, house.deltas, house.dw):
            if zone.tables():
                print(zone.path)
                house.status(zone).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
