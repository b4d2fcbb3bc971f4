"""Numbers of members that share a name, kept as a state that each change is merged into.

Every member has a number for as long as it keeps its name. It shows as the member's qualifier while
others share the name, and as NULL while none does. For every name there is the number of its members,
the sum of their keys, and the highest number given out. So a change finds free numbers without a look
at the members of a name; and where one member is left (or was alone until now), the sum is its key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators.quality import require_keys
from tidewright.operators.sizing import broadcast_if_small
from tidewright.operators.skew import hot_groups, hot_keys, number_in_groups, spread_join
from tidewright.session import checkpointed
from tidewright.sources.zones import Zone

QUALIFIER = "qualifier"
_NAME, _NUMBER = "__name", "__number"
_STREAM = "changes"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _one_name(names: Sequence[str]) -> Column:
    """The names as one text that tells all values and NULLs apart, as NULLs of a key equal nothing."""
    def part(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.concat(*[part(n) for n in names])


def _key_sum(value: Column) -> Column:
    return F.sum(value.cast("decimal(20,0)")).cast("decimal(38,0)")


class Numbering:
    """The members of a dimension, keyed by a whole number, and the state of their names.

    A change is planned in full, then published table by table. What was planned and not published in
    full, as the driver was lost, is published before the next change. Rows whose qualifier or columns
    changed wait in `pending` until they are `settled`, so a refused merge loses none. A NULL or
    repeated key is refused.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str, names: Sequence[str], ts: str,
        min_rows: int | None = None,
    ) -> None:
        zone = Zone(spark, path)
        self.key, self.names, self.ts = key, list(names), ts
        self._min_rows = min_rows
        self._members = zone.table("members", [key])
        self._groups = zone.table("groups", [_NAME])
        self._pending = zone.table("pending", [key])
        self._planned = zone.table("plan/members", [key])
        self._planned_groups = zone.table("plan/groups", [_NAME])
        self._planned_gone = zone.table("plan/gone", [key])

    @property
    def _columns(self) -> list[str]:
        return [self.key, *self.names, QUALIFIER, self.ts]

    def started(self) -> bool:
        return self._pending.exists()

    def start(self, dimension: DataFrame) -> None:
        """Takes over a dimension built in full: its qualifiers stay, a member without one has 1."""
        if not isinstance(dimension.schema[self.key].dataType, _WHOLE):
            raise ValueError(f"{self.key} is no whole number")
        number = F.coalesce(F.col(QUALIFIER), F.lit(1)).cast("bigint")
        rows = dimension.select(*self._columns).withColumn(QUALIFIER, F.col(QUALIFIER).cast("bigint"))
        self._members.replace(
            rows.withColumn(_NAME, _one_name(self.names)).withColumn(_NUMBER, number),
            lambda df: require_keys(df, [self.key], [[_NAME, _NUMBER]], "members"),
        )
        members = self._members.read()
        self._groups.replace(members.groupBy(_NAME).agg(
            F.count(F.lit(1)).alias("members"), _key_sum(F.col(self.key)).alias("keys"),
            F.max(_NUMBER).alias("highest")))
        self._planned.replace(members.limit(0))
        self._planned_groups.replace(self._groups.read().limit(0))
        self._planned_gone.replace(members.select(self.key).limit(0))
        self._pending.replace(members.select(*self._columns).limit(0))

    def _last(self, table) -> int:
        return table.current().batches.get(_STREAM, 0)

    def apply(self, changed: DataFrame, gone: DataFrame | None = None) -> None:
        """Takes in new and changed members, and keys that went. Again, it has no further effect.

        A key in both is a changed one. Newcomers of a name get the numbers after its highest, by key.
        Reads the files that may hold keys or names of the change.
        """
        self._publish()
        new = checkpointed(
            changed.select(self.key, *self.names, self.ts).withColumn(_NAME, _one_name(self.names)))
        require_keys(new, [self.key], name="changed members")
        keys = new.select(self.key)
        lost = keys.limit(0) if gone is None else checkpointed(
            gone.select(F.col(self.key).cast(keys.schema[0].dataType)).dropna().distinct()
            .join(broadcast_if_small(keys), [self.key], "left_anti"))
        touched = keys.union(lost)
        old = checkpointed(self._members.matching(touched).select(
            self.key, F.col(_NAME).alias("__was"), F.col(_NUMBER).alias("__had")))

        told = checkpointed(new.join(old, [self.key], "left").withColumn(
            "__joins", ~F.col("__was").eqNullSafe(F.col(_NAME))))
        leaving = old.join(new.select(self.key, _NAME), [self.key], "left").where(
            ~F.col("__was").eqNullSafe(F.col(_NAME)))
        after = checkpointed(self._after(told, leaving))
        rows = self._numbered(told, after).unionByName(self._alone(after, touched))

        number = self._last(self._groups) + 1
        self._planned_groups.replace(after.select(_NAME, "members", "keys", "highest"))
        self._planned_gone.replace(lost)
        self._planned.replace(rows)
        # From here on the plan is whole.
        self._planned.upsert(self._planned.read().limit(0), batch=(_STREAM, number))
        self._publish()

    def _after(self, told: DataFrame, leaving: DataFrame) -> DataFrame:
        """Per touched name its state before and after the change, from signed rows."""
        one, key = F.lit(1).cast("bigint"), F.col(self.key).cast("decimal(20,0)")
        joins = F.when(F.col("__joins"), one).otherwise(0)
        signed = told.select(_NAME, joins.alias("n"), (joins * key).alias("k"), joins.alias("joined")).union(
            leaving.select("__was", -one, -key, one - 1))
        change = signed.groupBy(_NAME).agg(
            F.sum("n").alias("__n"), _key_sum(F.col("k")).alias("__k"), F.sum("joined").alias("__joined"))
        change = checkpointed(change)
        state = self._groups.matching(change).select(
            _NAME, F.col("members").alias("__m0"), F.col("keys").alias("__k0"), F.col("highest").alias("__h0"))
        zero = F.lit(0)
        members = F.coalesce("__m0", zero) + F.col("__n")
        keys = (F.coalesce("__k0", zero) + F.col("__k")).cast("decimal(38,0)")
        highest = F.when(members == 0, zero).otherwise(F.coalesce("__h0", zero) + F.col("__joined"))
        return change.join(state, [_NAME], "left").select(
            _NAME, members.cast("bigint").alias("members"), keys.alias("keys"),
            highest.cast("bigint").alias("highest"), "__m0", "__k0", "__h0")

    def _numbered(self, told: DataFrame, after: DataFrame) -> DataFrame:
        """The changed members with number and qualifier."""
        joining = told.where("__joins")
        hot = hot_groups(joining, [_NAME], self.key, self._min_rows)
        placed = number_in_groups(joining, [_NAME], self.key, "__place", "__total", hot).drop("__total")
        rows = placed.unionByName(told.where("not __joins").withColumn("__place", F.lit(None).cast("bigint")))
        found = spread_join(rows, after.select(_NAME, "members", "__h0"), [_NAME],
                            hot_left=hot_keys(told, [_NAME], self._min_rows))
        number = F.when(F.col("__joins"), F.coalesce("__h0", F.lit(0)) + F.col("__place")).otherwise(
            F.col("__had"))
        return self._shown(found.withColumn(_NUMBER, number))

    def _alone(self, after: DataFrame, touched: DataFrame) -> DataFrame:
        """Members out of the change that were alone or now are: their qualifier shows or goes."""
        was = (F.col("__m0") == 1) & (F.col("members") > 1)
        now = (F.col("__m0") > 1) & (F.col("members") == 1)
        key = F.when(was, F.col("__k0")).otherwise(F.col("keys"))
        lone = checkpointed(
            after.where(was | now)
            .select(key.cast(touched.schema[0].dataType).alias(self.key), "members")
            .join(broadcast_if_small(touched), [self.key], "left_anti"))
        rows = self._members.matching(lone).drop(QUALIFIER)
        return self._shown(rows.join(lone, [self.key]))

    def _shown(self, rows: DataFrame) -> DataFrame:
        qualifier = F.when(F.col("members") > 1, F.col(_NUMBER)).cast("bigint")
        return rows.withColumn(QUALIFIER, qualifier).select(*self._columns, _NAME, _NUMBER)

    def _publish(self) -> None:
        """Publishes a whole plan that is not yet taken over. The groups come last and close it."""
        number = self._last(self._planned)
        if number <= self._last(self._groups):
            return
        batch = (_STREAM, number)
        rows, gone = self._planned.read(), self._planned_gone.read()
        self._members.upsert(rows, batch=batch)
        self._members.remove(gone)
        self._pending.upsert(rows.select(*self._columns), batch=batch)
        self._pending.remove(gone)
        groups = self._planned_groups.read()
        self._groups.upsert(groups, batch=batch)
        # A name without members that stays, as this was cut short, counts as none.
        self._groups.remove(groups.where("members = 0"))

    def read(self) -> DataFrame:
        """The dimension: key, names, qualifier and change time."""
        return self._members.read().select(*self._columns)

    def pending(self) -> DataFrame:
        """The rows of the dimension that changed since the last time all were settled."""
        self._publish()
        return self._pending.read()

    def settled(self) -> None:
        """Tells that what was pending has been merged elsewhere."""
        self._pending.replace(self._pending.read().limit(0))
