"""The source tables and warehouse tables, with their keys and change times."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """A source table: merge key and the column its deltas are taken by."""

    name: str
    keys: tuple[str, ...]
    ts: str = "last_update"


@dataclass(frozen=True)
class TargetSpec:
    """A warehouse table: primary key and unique keys, both checked before a publish.

    `follows` names source tables, each with columns of its key that this table has under the same
    names: rows go when the source's row with these values goes.
    """

    name: str
    keys: tuple[str, ...]
    uniques: tuple[tuple[str, ...], ...] = ()
    follows: tuple[tuple[str, tuple[str, ...]], ...] = ()


# The source tables with merge key and change time.
SOURCES = (
    TableSpec("actor", ("actor_id",)),
    TableSpec("address", ("address_id",)),
    TableSpec("category", ("category_id",)),
    TableSpec("city", ("city_id",)),
    TableSpec("country", ("country_id",)),
    TableSpec("customer", ("customer_id",)),
    TableSpec("film", ("film_id",)),
    TableSpec("film_actor", ("actor_id", "film_id")),
    TableSpec("film_category", ("film_id", "category_id")),
    TableSpec("inventory", ("inventory_id",)),
    TableSpec("language", ("language_id",)),
    TableSpec("payment", ("payment_id",), ts="payment_date"),
    TableSpec("rental", ("rental_id",)),
    TableSpec("staff", ("staff_id",)),
    TableSpec("store", ("store_id",)),
)

# The warehouse tables with primary and unique keys.
TARGETS = (
    TargetSpec("actor_dim", ("actor_id",), (("first_name", "last_name", "qualifier"),),
               (("actor", ("actor_id",)),)),
    TargetSpec("category_dim", ("category_id",), (("name",),), (("category", ("category_id",)),)),
    TargetSpec("film_dim", ("film_id",), (("title",),), (("film", ("film_id",)),)),
    TargetSpec("film_fact", ("film_id", "actor_id", "category_id"), (),
               (("film_actor", ("actor_id", "film_id")), ("film_category", ("film_id", "category_id")),
                ("film", ("film_id",)), ("category", ("category_id",)))),
    TargetSpec("inventory_fact", ("inventory_id",), (), (("inventory", ("inventory_id",)),)),
    TargetSpec("store_dim", ("store_id",), (), (("store", ("store_id",)),)),
)
