"""Readers for source tables, full snapshots and deltas."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.text import ddl_type
from tidewright.functions.windows import Cycle, in_cycle
from tidewright.sources.files import Folder

# A source hands out a table by its name.
Source = Callable[[str], DataFrame]


class ParquetSource:
    """Tables kept as `<folder>/<name>.parquet`."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

    def tables(self) -> list[str]:
        names = Folder(self._spark, self._folder).names()
        return [n.removesuffix(".parquet") for n in names if n.endswith(".parquet")]


class CatalogSource:
    """Tables registered in a catalog database."""

    def __init__(self, spark: SparkSession, database: str) -> None:
        self._spark, self._database = spark, database

    def __call__(self, name: str) -> DataFrame:
        return self._spark.table(f"{self._database}.{name}")

    def tables(self) -> list[str]:
        return base_tables(self._spark, self._database)


class JdbcSource:
    """Tables of a relational database.

    `split` names, per table, the column, lower bound, upper bound and number of partitions
    of a parallel read. Window filters and column lists are pushed to the database by Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        split: Mapping[str, tuple[str, str, str, int]] | None = None,
        schema: str = "public",
    ) -> None:
        self._spark, self._schema, self._split = spark, schema, dict(split or {})
        self._options = dict(url=url, preferTimestampNTZ="true", **properties)

    def _reader(self, table: str):
        return self._spark.read.format("jdbc").options(dbtable=table, **self._options)

    def __call__(self, name: str) -> DataFrame:
        reader = self._reader(f"{self._schema}.{name}")
        if name in self._split:
            column, low, high, parts = self._split[name]
            reader = reader.options(partitionColumn=column, lowerBound=low, upperBound=high,
                                    numPartitions=str(parts))
        return reader.load()

    def tables(self) -> list[str]:
        """Base tables as the database's information schema lists them, views left out."""
        listed = self._reader("information_schema.tables").load()
        names = {c.lower(): c for c in listed.columns}
        base = listed.where((F.col(names["table_schema"]) == self._schema)
                            & (F.col(names["table_type"]) == "BASE TABLE"))
        return sorted(r[0] for r in base.select(names["table_name"]).collect())


def parquet_source(spark: SparkSession, folder: str) -> Source:
    return ParquetSource(spark, folder)


def catalog_source(spark: SparkSession, database: str) -> Source:
    return CatalogSource(spark, database)


def jdbc_source(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str],
    split: Mapping[str, tuple[str, str, str, int]] | None = None,
    schema: str = "public",
) -> Source:
    return JdbcSource(spark, url, properties, split, schema)


def pinned(source: Source, names: Iterable[str]) -> Source:
    """The source's tables as they are now, for all steps that follow.

    A frame over files lists them when it is made, so files that come later are not read; the frames of
    all tables are made at once. A database has to offer its own snapshot.
    """
    frames = {name: source(name) for name in names}
    return frames.__getitem__


def base_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database, views left out."""
    found = spark.catalog.listTables(database)
    return sorted(t.name for t in found if t.tableType in ("MANAGED", "EXTERNAL"))


def snapshot(df: DataFrame) -> DataFrame:
    """All rows, in column order, with user-defined types as text."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.UserDefinedType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("string") for c in text}) if text else df


def delta(df: DataFrame, ts: str, cycle: Cycle) -> DataFrame:
    """Rows changed in the cycle; both bounds reach the scan."""
    return snapshot(df.where(in_cycle(ts, cycle)))


def catalog_frame(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table column, as a schema catalog lists them."""
    rows = [
        (name, i, f.name, ddl_type(f.dataType))
        for name, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal_position int, column_name string, data_type string"
    )

