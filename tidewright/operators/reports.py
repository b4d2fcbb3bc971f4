"""Row counts, changed tables and table definitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.text import report_name
from tidewright.functions.windows import CYCLE_MINUTES, floor_to_cycle
from tidewright.sources.extract import catalog_frame
from tidewright.sources.zones import Zone


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One sorted line per table: its padded name and its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(report_name(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts).orderBy("table_name")


def changed_tables(deltas: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The tables whose delta has any row, with their merge key and the number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("merge_key"), "n"
        )
        for name, (df, keys) in deltas.items()
    ]
    return reduce(DataFrame.union, counts).where(F.col("n") > 0)


def schema_ddl(catalog: DataFrame, table: str, column: str, dtype: str, order: str) -> DataFrame:
    """Table definitions from a catalog frame with one row per table column.

    A group holds the columns of one table, so its size is that of a schema.
    """
    texts = catalog.select(
        table,
        F.concat_ws(" ", F.col(column), F.col(dtype).cast("string")).alias("__text"),
        F.col(order).alias("__order"),
    )
    listed = F.expr("listagg(__text, ',') WITHIN GROUP (ORDER BY __order)")
    return texts.groupBy(table).agg(listed.alias("__list")).select(
        table,
        F.concat(
            F.lit("CREATE TABLE "), F.col(table).cast("string"), F.lit("("), F.col("__list"),
            F.lit(");"),
        ).alias("ddl"),
    )


def zone_schema(zone: Zone, name: str) -> DataFrame:
    """The definition of every table of a zone, from the published schemas."""
    tables = {f"{name}.{t}": zone.read(t) for t in zone.tables()}
    catalog = catalog_frame(zone.spark, tables)
    return schema_ddl(catalog, "table_name", "column_name", "data_type", "ordinal_position")


def cycle_counts(df: DataFrame, ts: str, minutes: int = CYCLE_MINUTES) -> DataFrame:
    """Rows that each cycle over `df` picks up, by the cycle's end."""
    end = floor_to_cycle(ts, minutes) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return df.groupBy(end.alias("cycle_upto")).agg(F.count(F.lit(1)).alias("n"))
