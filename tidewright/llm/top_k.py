"""Exact top-k by inner product, with the three phases of a uniform threshold.

Each vector is cut into a few runs of components. A node holds one run of one block of vectors and
scores it by itself; a total is the sum over the runs. Phase one gathers each node's local list of
its highest partial scores. The totals of what is on those lists give a score that the k-th result
reaches at least; shared evenly among the runs it is the cutoff that every node gets. Phase two
collects all entries that reach it. Whatever no node collects has a total below the cutoffs' sum, so
phase three resolves the missing partial scores of the collected entries and is done. Partial
scores may be negative: they are counted from the least one of their run.

The nodes of a block lie in one task, and query blocks stream past them. So vectors are moved once
per phase, missing partial scores are looked up where the entry was collected, and a block returns
k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.shared import stored

SCALE = 1024
RUNS = 2
# Vectors of a block: a share of the table within these bounds, and at most so many numbers.
LEAST_ROWS, MOST_ROWS, SHARE, BLOCK_CELLS = 4096, 65536, 32, 1 << 23
# Queries of a query block, and scores worked on at a time.
QUERY_ROWS, SCORE_CELLS = 512, 1 << 21
# Entries per result that a node's local list holds; longer lists give a higher cutoff.
LIST_FACTOR = 2


def usable(rows: DataFrame) -> DataFrame:
    """row, vec_id and v: the vector with each component as floor(SCALE * component).

    Left out are rows with a NULL vec_id, a NULL vector, or a NULL or non-finite component. `row`
    tells apart rows with one vec_id; the frame has to be stored before it is used twice. A
    component beyond 2^53 / SCALE has no exact whole number here and is refused by an error.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return kept.select(F.monotonically_increasing_id().alias("row"),
                       F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _blocks(vectors: DataFrame, count: int, name: str) -> DataFrame:
    """(name, rows): the vectors dealt into blocks, one row each."""
    block = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    return vectors.groupBy(block.alias(name)).agg(
        F.collect_list(F.struct("row", "vec_id", "v")).alias("rows"))


def _streams(vectors: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """(block, part, rows, cuts): each block of vectors (part -1), followed by all query blocks."""
    cuts = F.lit(None).cast("array<array<long>>").alias("cuts")
    own = vectors.select("block", F.lit(-1).alias("part"), "rows", cuts)
    # Each query block goes to each vector block: the stated query set against all rows.
    sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "part",
                          "rows", "cuts" if "cuts" in queries.columns else cuts)
    return own.union(sent).repartition(blocks, "block").sortWithinPartitions("block", "part")


def _matrix(rows: pa.Scalar, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, vec_ids and components; vectors shorter than `width` count as ended by zeros."""
    parts = rows.values
    lists = parts.field("v")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(lists.offsets.to_numpy())
    cells = np.zeros((len(parts), width), flat.dtype)
    cells[np.arange(width)[None, :] < sizes[:, None]] = flat
    return (parts.field("row").to_numpy(zero_copy_only=False),
            parts.field("vec_id").to_numpy(zero_copy_only=False), cells)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact partial scores: by doubles where they hold every sum, else by whole numbers."""
    most = np.abs(queries).max(initial=0) * float(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most < 2.0**52:
        return (queries.astype(float) @ vectors.astype(float).T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def _met(batches: Iterator[pa.RecordBatch], width: int, runs: int):
    """For some queries at a time and the vectors of a block: rows, ids, partial scores per run, cuts."""
    edges = [width * r // runs for r in range(runs + 1)]
    block = None
    for batch in batches:
        for i in range(batch.num_rows):
            rows, ids, cells = _matrix(batch.column("rows")[i], width)
            if batch.column("part")[i].as_py() < 0:
                block = rows, ids, cells
                continue
            cuts = batch.column("cuts")[i].as_py()
            cuts = np.array(cuts, np.int64).reshape(len(rows), runs) if cuts is not None else None
            at_once = max(1, SCORE_CELLS // max(1, len(block[0])))
            for a in range(0, len(rows), at_once):
                b = min(a + at_once, len(rows))
                parts = [_scores(cells[a:b, x:y], block[2][:, x:y])
                         for x, y in zip(edges[:-1], edges[1:], strict=True)]
                yield rows[a:b], ids[a:b], block[0], block[1], parts, None if cuts is None else cuts[a:b]


_BEST = "query_row long, query_id long, row long, vec_id long, score long"
_LISTED = _BEST + ", least array<long>"


def _highest(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= floor)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _found(chosen: list, least: list | None) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c)) for c in zip(*chosen, strict=True)]
    names = ["query_row", "query_id", "row", "vec_id", "score"]
    if least is not None:
        columns.append(pa.array(least, pa.list_(pa.int64())))
        names.append("least")
    return pa.RecordBatch.from_arrays(columns, names)


def _local_lists(batches: Iterator[pa.RecordBatch], width: int, runs: int, k: int
                 ) -> Iterator[pa.RecordBatch]:
    """Phase one: per query and block the best totals on the nodes' lists, and the least partial scores."""
    size = k * LIST_FACTOR + 1
    for q_rows, q_ids, rows, ids, parts, _ in _met(batches, width, runs):
        least = np.stack([p.min(axis=1) for p in parts], axis=1)
        n = min(size, len(rows))
        listed = np.concatenate([np.argpartition(p, len(rows) - n, axis=1)[:, len(rows) - n :]
                                 for p in parts], axis=1)
        chosen, leasts = [], []
        for i in range(len(q_rows)):
            places = np.unique(listed[i])
            places = places[rows[places] != q_rows[i]]
            totals = sum(p[i, places] for p in parts)
            top = _highest(totals, ids[places], k)
            # A block without another row still tells its least scores.
            at = places[top] if len(top) else np.array([-1])
            m = len(at)
            chosen.append((np.full(m, q_rows[i]), np.full(m, q_ids[i]),
                           rows[at] if len(top) else at, ids[at] if len(top) else at,
                           totals[top] if len(top) else np.array([0])))
            leasts += [least[i].tolist()] * m
        yield _found(chosen, leasts)


def _collected(batches: Iterator[pa.RecordBatch], width: int, runs: int, k: int
               ) -> Iterator[pa.RecordBatch]:
    """Phases two and three: entries that reach a node's cutoff, with their missing scores resolved."""
    for q_rows, q_ids, rows, ids, parts, cuts in _met(batches, width, runs):
        reach = np.zeros(parts[0].shape, bool)
        for r, part in enumerate(parts):
            reach |= part >= cuts[:, r][:, None]
        chosen = []
        for i in range(len(q_rows)):
            places = np.flatnonzero(reach[i] & (rows != q_rows[i]))
            totals = sum(p[i, places] for p in parts)
            top = _highest(totals, ids[places], k)
            at = places[top]
            chosen.append((np.full(len(at), q_rows[i]), np.full(len(at), q_ids[i]), rows[at],
                           ids[at], totals[top]))
        yield _found(chosen, None)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(rows: DataFrame, is_query: Column, k: int = 10, runs: int = RUNS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query over all other vectors.

    Ties go to the smaller vec_id; a query gets all others if there are fewer than k. Rows are told
    apart by themselves, not by vec_id: of rows with one vec_id each is a candidate, of the others
    too, and each that is a query has k results. An empty table gives no rows. Extra columns are not
    looked at. Components are compared in order; a vector shorter than the widest counts as ended
    by zeros.
    """
    vectors = stored(usable(rows), "vectors")
    sizes = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
        F.count(F.when(is_query, 1)).alias("q"),
        F.max(F.array_max(F.transform("v", lambda c: F.abs(c)))).alias("most"),
    ).first()
    n, width, most = sizes["n"], max(1, sizes["width"] or 1), sizes["most"] or 0
    runs = min(runs, width)
    if most >= 1 << 53:
        raise ValueError("a component is too large for an exact whole number")
    if most < 1 << 31:
        vectors = vectors.withColumn("v", F.col("v").cast("array<int>"))
    fitting = max(1, min(max(LEAST_ROWS, n // SHARE), MOST_ROWS, BLOCK_CELLS // width))
    blocks = max(1, -(-n // fitting))
    parts = max(1, -(-sizes["q"] // min(QUERY_ROWS, max(1, BLOCK_CELLS // width))))
    tiles = _blocks(vectors, blocks, "block")
    asked = stored(_blocks(vectors.where(is_query), parts, "part"), "queries")

    lists = stored(_streams(tiles, asked, blocks).mapInArrow(
        lambda b: _local_lists(b, width, runs, k), _LISTED), "lists")
    reached = _ranked(lists.where("row >= 0"), k).groupBy("query_row").agg(
        F.min("score").alias("reached"), F.count(F.lit(1)).alias("n"))
    least = lists.groupBy("query_row").agg(
        *[F.min(F.col("least")[r]).alias(f"l{r}") for r in range(runs)])
    # With fewer than k totals nothing may be cut. A total below `reached` cannot be among the
    # k highest; one that reaches it has a run at its least plus an even share or more.
    spare = F.col("reached") - sum((F.col(f"l{r}") for r in range(1, runs)), F.col("l0"))
    share = F.when(F.col("n") < k, F.lit(0).cast("long")).otherwise(F.ceil(spare / F.lit(runs)))
    cutoffs = least.join(reached, "query_row").select(
        "query_row", F.array(*[F.col(f"l{r}") + share for r in range(runs)]).alias("cut"))
    # The cutoffs travel with their queries, in the same order.
    told = asked.select("part", F.posexplode("rows").alias("at", "q")).join(
        cutoffs, F.col("q.row") == F.col("query_row")).groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("at", "q", "cut"))).alias("t")).select(
        "part", F.col("t.q").alias("rows"), F.col("t.cut").alias("cuts"))
    best = _streams(tiles, told, blocks).mapInArrow(lambda b: _collected(b, width, runs, k), _BEST)
    return _ranked(best, k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
