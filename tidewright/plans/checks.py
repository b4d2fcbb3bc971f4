"""The checks a cycle ends with."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from tidewright.operators.quality import ERROR, WARNING, Check, childless_since, orphans
from tidewright.sources.extract import Source
from tidewright.sources.files import Folder


def warehouse_checks(dw: Source, as_of: datetime) -> list[Check]:
    """Film facts without a film warn; stores without inventory for a day or more are errors."""

    def empty_for(days: int) -> Check:
        name = f"stores_empty_for_{days}_day{'s' if days > 1 else ''}"
        return Check(
            name,
            ERROR,
            lambda: childless_since(
                dw("store_dim"), dw("inventory_fact"), ["store_id"], "last_update",
                timedelta(days=days), as_of,
            ),
            ("store_id",),
        )

    return [
        Check(
            "film_facts_without_film",
            WARNING,
            lambda: orphans(dw("film_fact"), dw("film_dim"), ["film_id"]),
            ("film_id", "actor_id", "category_id"),
        ),
        empty_for(1),
        empty_for(3),
    ]


FOLDERS = {WARNING: "warnings", ERROR: "errors"}


def checks_from_files(
    spark: SparkSession,
    folder: str,
    read: Source,
    tables: Sequence[str],
    as_of: datetime | None = None,
) -> list[Check]:
    """A check per file `warnings/*.sql` and `errors/*.sql`, named after it.

    A file holds one SELECT that should return nothing. It finds the given tables under their
    names (as temporary views of the session) and the time as `:as_of`. Only the driver reads
    the files. A file that does not run is a check that failed.
    """
    for name in tables:
        read(name).createOrReplaceTempView(name)

    def check(severity: str, files: Folder, name: str) -> Check:
        def run():
            text = files.read_text(name).strip().rstrip(";")
            return spark.sql(text, args={"as_of": as_of} if ":as_of" in text else None)

        return Check(name.removesuffix(".sql"), severity, run)

    found = []
    for severity, below in FOLDERS.items():
        files = Folder(spark, f"{folder}/{below}")
        found += [check(severity, files, n) for n in files.names() if n.endswith(".sql")]
    return found
