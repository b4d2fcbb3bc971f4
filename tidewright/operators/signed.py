"""Changes as signed rows, and the bridge's change from the changes of its links.

A link that was added counts +1, one that was removed -1. The pairs of two sets of links are
bilinear in them: with A and B as they are now, the pairs change by dA x B + A x dB - dA x dB. So a
withdrawn link takes its fact rows along, and pairs of unchanged links are never formed. A fact row
stands as long as its pair's count is above zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.sieve import sieve
from tidewright.operators.sizing import BROADCAST_BYTES, are_small
from tidewright.operators.skew import any_null, check_comparable, hot_keys, hot_pairs, spread_join
from tidewright.session import checkpointed

SIGN, COUNT = "sign", "n"
# Signed pairs that one task sums up, at about 300 bytes of memory each.
PAIRS_PER_SUM = 1 << 18
# Links that one task counts and joins where they are laid out by their entity.
LINKS_PER_TASK = 1 << 18


def signed(added: DataFrame, removed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The net change of each link: how many more (or fewer) rows have it; unchanged ones are left out."""
    both = added.select(*columns, F.lit(1).cast("bigint").alias(SIGN)).unionByName(
        removed.select(*columns, F.lit(-1).cast("bigint").alias(SIGN)))
    return both.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0)


def counted(links: DataFrame, columns: Sequence[str], on: str | None = None) -> DataFrame:
    """Each link with the number of rows that have it, as its sign.

    With `on` the links move once, to where their entity's are, and a join by the entity moves them no
    further. They are counted where they fall if an entity alone would be a burden for one task.
    """
    if on is not None:
        rows = links.count()
        hot = hot_keys(links.select(on), [on], LINKS_PER_TASK, rows)
        if all(n <= LINKS_PER_TASK for n in hot.rows.values()):
            # By a given number of tasks, as adaptive execution packs them by compressed bytes.
            links = links.repartition(max(1, -(-rows // LINKS_PER_TASK)), on)
    return links.groupBy(*columns).agg(F.count(F.lit(1)).alias(SIGN))


def _pairs(left: DataFrame, right: DataFrame, on: str, out: Sequence[str], times: int) -> DataFrame:
    """The product of two signed sets of links under their common entity."""
    right = right.withColumnRenamed(SIGN, "__other")
    hot_left, hot_right = hot_keys(left.select(on), [on]), hot_keys(right.select(on), [on])
    paired_left, paired_right = hot_pairs(left.select(on), right.select(on), [on])
    met = spread_join(left, right, [on], "inner", hot_left | paired_left, hot_right | paired_right)
    return met.select(*out, (F.col(SIGN) * F.col("__other") * F.lit(times)).alias(SIGN))


def _only_near(links: DataFrame, changes: DataFrame, on: str, limit: int) -> DataFrame:
    """Links of the entities that changed on the other side, computed once and kept.

    Where these fit no broadcast, a few links of other entities come along, which meet no change.
    """
    touched = changes.select(on).dropna().distinct()
    if are_small(touched, limit=limit):
        near = links.join(F.broadcast(touched), [on], "left_semi")
    else:
        near = links.dropna(subset=[on]).where(sieve(touched).passes(links))
    return checkpointed(near)


def _net(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sum of the signs of each pair, without those that stay; computed once and kept.

    Adaptive execution packs tasks by compressed bytes, of which such narrow rows take few. So above
    the rows that one task sums up the pairs are counted first and dealt out over tasks by number.
    """
    tasks = -(-pairs.count() // PAIRS_PER_SUM)
    if tasks > 1:
        pairs = pairs.repartition(tasks, *columns)
    # Kept, as joins with the sums would otherwise lay their other side out over that many tasks too.
    return checkpointed(pairs.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) != 0))


def bridge_change(
    first: DataFrame,
    first_change: DataFrame,
    second: DataFrame,
    second_change: DataFrame,
    on: str,
    columns: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The net change of the count of every pair: `columns` and `sign`, without those that stay.

    `first` and `second` are the links as they are now, one row each (`counted`); the changes come
    from `signed`. Links of entities without a change on the other side are dropped at the scan.
    """
    first_change, second_change = checkpointed(first_change), checkpointed(second_change)
    first_near = _only_near(first, second_change, on, limit)
    second_near = _only_near(second, first_change, on, limit)
    parts = _pairs(first_change, second_near, on, columns, 1).unionByName(
        _pairs(first_near, second_change, on, columns, 1)).unionByName(
        _pairs(first_change, second_change, on, columns, -1))
    return _net(parts, columns)


def with_change(facts: DataFrame, change: DataFrame, columns: Sequence[str], limit: int = BROADCAST_BYTES,
                on: str | None = None) -> DataFrame:
    """Facts (`columns` and the pair's count `n`) after a change: new pairs come, spent ones go.

    Facts without a change stay where they are. Those of other entities (`on`; else other pairs) than the
    changed ones are told apart by a sieve and meet the change in no join. A count below zero would
    mean that facts and changes do not belong together, and is an error.
    """
    columns = list(columns)
    keys = change.select(*columns)
    facts = facts.select(*columns, F.col(COUNT).cast("bigint").alias(COUNT))
    change = change.select(*columns, F.col(SIGN).cast("bigint").alias(COUNT))
    far = None
    if _comparable(facts, keys, columns):
        passes = sieve(keys.select(*([on] if on else columns)).distinct()).passes(facts)
        far, facts = facts.where(~passes), facts.where(passes)
    if are_small(keys, limit=limit):
        touched = facts.join(F.broadcast(keys), columns, "left_semi")
        rest = facts.join(F.broadcast(keys), columns, "left_anti")
        after = touched.unionByName(change).groupBy(*columns).agg(F.sum(COUNT).alias(COUNT))
        after = rest.unionByName(after.withColumn(COUNT, _sound(F.col(COUNT))).where(F.col(COUNT) > 0))
    else:
        after = _summed(facts, change, columns)
    return after if far is None else far.unionByName(after)


def _comparable(left: DataFrame, right: DataFrame, on: Sequence[str]) -> bool:
    try:
        check_comparable(left, right, on)
    except ValueError:
        return False
    return True


def _sound(count: Column) -> Column:
    error = F.raise_error(F.lit("a pair was removed more often than it was there"))
    return F.when(count < 0, error.cast("bigint")).otherwise(count)


def _summed(facts: DataFrame, change: DataFrame, columns: list[str]) -> DataFrame:
    """Facts after a change whose pairs fit no broadcast. Both move once, to where their pair is.

    Facts with a NULL stay as they are, as a join would leave them.
    """
    cell = [*columns, "__apart"]
    rows = facts.withColumns({"__apart": any_null(columns), "__new": F.lit(0)}).unionByName(
        change.withColumns({"__apart": F.lit(False), "__new": F.lit(1)}))
    tasks = max(-(-change.count() // PAIRS_PER_SUM), int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pair = Window.partitionBy(*cell)
    summed = rows.repartition(tasks, *cell).withColumns({
        "__met": F.max("__new").over(pair) == 1,
        "__sum": F.sum(COUNT).over(pair),
        "__nth": F.row_number().over(pair.orderBy("__new")),
    }).where(~F.col("__met") | (F.col("__nth") == 1))
    after = F.when(F.col("__met"), _sound(F.col("__sum"))).otherwise(F.col(COUNT))
    return summed.withColumn(COUNT, after).where(~F.col("__met") | (F.col(COUNT) > 0)).select(*columns, COUNT)


def spent(change: DataFrame, facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs whose count a change takes to zero: the fact rows to remove."""
    falling = change.where((F.col(SIGN) < 0) & ~any_null(list(columns)))
    met = facts.join(F.broadcast(falling) if are_small(falling) else falling, list(columns))
    return met.where(F.col(COUNT) + F.col(SIGN) <= 0).select(*columns)
