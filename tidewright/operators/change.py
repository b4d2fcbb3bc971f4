"""Keyed change: append, delete, upsert, update, insert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.sizing import BROADCAST_BYTES, are_small
from tidewright.operators.skew import any_null, hot_keys, spread_join

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
_INEXACT = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _assignable(source: T.DataType, target: T.DataType) -> bool:
    """Whether a value of one type is put into a column of another without being asked to.

    Numbers go into numbers, but not inexact into exact ones; a date goes into a time; anything goes
    into text. Text is never read as something else.
    """
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return isinstance(source, (*_EXACT, *_INEXACT, *_TIMES, T.BooleanType, T.StringType))
    if isinstance(target, _EXACT):
        # A fraction would be cut, not rounded, by a cast to a whole number.
        cut = isinstance(source, T.DecimalType) and source.scale > 0
        return isinstance(source, _EXACT) and not (cut and not isinstance(target, T.DecimalType))
    if isinstance(target, _INEXACT):
        return isinstance(source, (*_EXACT, *_INEXACT)) and not (
            isinstance(source, T.DoubleType) and isinstance(target, T.FloatType))
    return isinstance(target, (T.TimestampNTZType, T.TimestampType)) and isinstance(source, T.DateType)


def _assigned(name: str, source: T.DataType, target: T.DataType) -> Column:
    """The value in the column's type; one out of its range is an error, whatever the session says."""
    column = F.col(f"`{name}`")
    if source == target or not isinstance(target, _EXACT):
        return column.cast(target)
    value = column.try_cast(target)
    refused = F.raise_error(F.concat(F.lit(f"{name}: {target.simpleString()} cannot hold "), column.cast("string")))
    return F.when(column.isNotNull() & value.isNull(), refused.cast(target)).otherwise(value)


def aligned(source: DataFrame, schema: T.StructType) -> DataFrame:
    """`source` with its columns taken by position as the columns of `schema`, and put into their types."""
    if len(source.columns) != len(schema.fields):
        raise ValueError(f"{len(source.columns)} columns for {len(schema.fields)}")
    wrong = [
        f"{s.name} {s.dataType.simpleString()} -> {t.name} {t.dataType.simpleString()}"
        for s, t in zip(source.schema.fields, schema.fields, strict=True)
        if not _assignable(s.dataType, t.dataType)
    ]
    if wrong:
        raise TypeError("columns do not fit by position: " + "; ".join(wrong))
    renamed = source.toDF(*[f.name for f in schema.fields])
    if renamed.schema == schema:
        return renamed
    return renamed.select(*[
        _assigned(t.name, s.dataType, t.dataType).alias(t.name)
        for s, t in zip(source.schema.fields, schema.fields, strict=True)
    ])


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """All rows of both, `source` by column position."""
    return target.union(aligned(source, target.schema))


def delete_by_key(
    target: DataFrame,
    keys_of: DataFrame,
    keys: Sequence[str],
    small: bool | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of `target` whose key is not among the keys of `keys_of`.

    A row with a NULL in its key equals no key and stays. A key set that fits a broadcast is
    sent to the target, which then keeps its place; a larger one is made distinct and joined
    by key, with the target's hot and NULL keys spread. `small` states the size check's
    result where the caller already knows the row count.
    """
    keys = list(keys)
    gone = keys_of.select(*keys).dropna()
    if are_small(gone, limit=limit) if small is None else small:
        return target.join(F.broadcast(gone), keys, "left_anti").select(*target.columns)
    hot = hot_keys(target.select(*keys).dropna(), keys)
    kept = spread_join(target, gone.distinct(), keys, "left_anti", hot_left=hot)
    return kept.select(*target.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    small: bool | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Deletes the source's keys from the target, then appends every source row.

    All copies of a key that occurs twice in `source` arrive: this is not a one-to-one merge.
    """
    source = aligned(source, target.schema)
    return append(delete_by_key(target, source, keys, small, limit), source)


def update_where(target: DataFrame, matches: Column, values: Mapping[str, Any]) -> DataFrame:
    """Sets the given columns on the matching rows; a condition that is NULL does not match."""
    unknown = set(values) - set(target.columns)
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}")
    types = {f.name: f.dataType for f in target.schema.fields}
    return target.withColumns(
        {
            c: F.when(matches, (v if isinstance(v, Column) else F.lit(v)).cast(types[c]))
            .otherwise(F.col(f"`{c}`"))
            for c, v in values.items()
        }
    )


def insert_rows(
    target: DataFrame,
    rows: Sequence[Sequence[Any]],
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Adds literal rows that may name fewer values than there are columns.

    Values fill the columns from the left; the rest takes its default, or NULL.
    """
    spark = target.sparkSession
    defaults = dict(defaults or {})
    fields = target.schema.fields
    added = target
    for width in sorted({len(r) for r in rows}):
        if width > len(fields):
            raise ValueError(f"{width} values for {len(fields)} columns")
        given = T.StructType([T.StructField(f.name, f.dataType) for f in fields[:width]])
        literal = spark.createDataFrame([tuple(r) for r in rows if len(r) == width], given)
        rest = {f.name: F.lit(defaults.get(f.name)).cast(f.dataType) for f in fields[width:]}
        added = added.unionByName(literal.withColumns(rest) if rest else literal)
    return added


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by `order`; rows with a NULL in the key all stay.

    An aggregate with map-side combine, so a key that fills a third of the batch reaches its
    reducer as one row per task.
    """
    keys = list(keys)
    keyed = df.dropna(subset=keys)
    unkeyed = df.where(any_null(keys))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    last = F.max_by(row, F.struct(*[F.col(f"`{c}`") for c in order]))
    kept = keyed.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]) \
        .agg(last.alias("__row")).select("__row.*")
    return kept.unionByName(unkeyed)

