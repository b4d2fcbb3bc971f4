"""The six warehouse tables, built from the source copies in full or for one cycle."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tidewright.functions.windows import Cycle
from tidewright.operators.builders import (
    bridge,
    lookup,
    passthrough,
    qualifier,
    snowflake,
)
from tidewright.operators.timed import table_in_cycle, timed_table
from tidewright.sources.dependents import Link
from tidewright.sources.extract import Source

Builder = Callable[[Source, Cycle | None], DataFrame]
TS = "last_update"
ACTOR_NAMES = ("first_name", "last_name")
# What a store refers to, over any number of links.
STORE_CHAIN = (
    Link("store", "store_id", "address_id"),
    Link("address", "address_id", "city_id"),
    Link("city", "city_id", "country_id"),
)


def category_dim(source: Source, cycle: Cycle | None = None) -> DataFrame:
    return passthrough(table_in_cycle(source, "category", cycle), TS, cycle)


def actor_dim(
    source: Source, cycle: Cycle | None = None, current: DataFrame | None = None
) -> DataFrame:
    """Actors; those who share a name are told apart by a number.

    Without `current`, a cycle numbers only the actors it changed.
    """
    # Given the dimension, members of a touched group may have changed long ago.
    actors = source("actor") if current is not None else table_in_cycle(source, "actor", cycle)
    return qualifier(
        actors, "actor_id", ACTOR_NAMES, TS, cycle, current
    )


def film_dim(source: Source, cycle: Cycle | None = None) -> DataFrame:
    return lookup(
        timed_table(source, "film", TS, "film_ts"),
        timed_table(source, "language", TS, "language_ts", ["language_id", "language"],
                    renamed=("name", "language")),
        ["language_id"],
        ["film_id", "title", "description", "release_year", "language", "rental_duration",
         "rental_rate", "length", "replacement_cost", "rating"],
        TS,
        cycle,
    )


def store_dim(source: Source, cycle: Cycle | None = None, both: bool = False) -> DataFrame:
    """Stores with their address flattened; `both` selects the narrower delta form."""
    store = timed_table(
        source, "store", TS, "store_ts", ["store_id", "manager_staff_id", "address_id"])
    city = timed_table(source, "city", TS, "city_ts", ["city_id", "city", "country_id"])
    country = timed_table(source, "country", TS, "country_ts", ["country_id", "country"])
    address = timed_table(
        source, "address", TS, "address_ts",
        ["address_id", "address", "address2", "district", "postal_code", "phone", "city_id"],
    )
    return snowflake(
        store,
        [(address, ["address_id"]), (city, ["city_id"]), (country, ["country_id"])],
        ["store_id", "manager_staff_id", "address_id", "address", "address2", "district", "city",
         "postal_code", "phone", "country"],
        TS,
        cycle,
        both,
    )


def film_fact(source: Source, cycle: Cycle | None = None) -> DataFrame:
    """One row per film, actor and category."""
    return bridge(
        timed_table(source, "film_actor", TS, "film_actor_ts", ["film_id", "actor_id"]),
        timed_table(source, "film", TS, "film_ts", ["film_id"]),
        timed_table(source, "film_category", TS, "film_category_ts", ["film_id", "category_id"]),
        timed_table(source, "category", TS, "category_ts", ["category_id"]),
        "film_id",
        "category_id",
        ["film_id", "actor_id", "category_id"],
        TS,
        cycle,
    )


def inventory_fact(source: Source, cycle: Cycle | None = None) -> DataFrame:
    return passthrough(table_in_cycle(source, "inventory", cycle), TS, cycle)


BUILDERS: Mapping[str, Builder] = {
    "actor_dim": actor_dim,
    "category_dim": category_dim,
    "film_dim": film_dim,
    "film_fact": film_fact,
    "inventory_fact": inventory_fact,
    "store_dim": store_dim,
}
