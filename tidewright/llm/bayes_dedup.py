"""Near copies by MinHash bands, with sequential Bayesian verification.

Texts become sets of hashed 5-word shingles; texts with equal sets are one class, and classes that
share a band of their signatures are candidates. A candidate pair is compared one batch of signature
labels after the other. With a uniform prior, m matches among n labels leave a Beta posterior of
the similarity, and a pair goes as soon as the posterior chance of reaching the limit falls below
the chosen miss probability. What survives all batches is verified on the full sets.

Pairs are not written out within a group of copies. First every member of a bucket is compared with
one hub, the member that meets the most others, which gathers a group around its original in linear
work. Then only members whose components differ are compared with each other, block by block, and a
block returns the links that join components, not all links it finds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import comb
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.lsh_forest import DEPTH as ROWS
from tidewright.llm.lsh_forest import TREES as BANDS
from tidewright.llm.lsh_forest import components, forget_words, grams, signature
from tidewright.llm.shared import broadcast_if_small, lean, number_rows, stored
from tidewright.operators.skew import NONE_HOT, HotKeys, hot_keys, spread_join

# Linked are sets with 100 * intersection >= PERCENT * union.
PERCENT = 85
LABELS, LABEL_BYTES = BANDS * ROWS, 2
BATCH = 32
MISS = 1e-6
# Rows of one key that a task gets, and bytes of a block of a group.
PER_PART = 512
BLOCK_BYTES, MOST_MEMBERS = 8 << 20, 2048
ROWS_PER_BATCH = 256


def least_matches(compared: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """The fewest matches among so many labels with which a pair may still be linked.

    After m matches the similarity is Beta(1 + m, 1 + compared - m); the chance that it reaches the
    limit t is that of at most m successes in compared + 1 trials of chance t.
    """
    t, chance = percent / 100, 0.0
    for m in range(compared + 1):
        chance += comb(compared + 1, m) * t**m * (1 - t) ** (compared + 1 - m)
        if chance >= miss:
            return m
    return compared + 1


BOUNDS = [(n, least_matches(n)) for n in range(BATCH, LABELS + 1, BATCH)]


def survivors(left: np.ndarray, right: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]
              ) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (places on the left, places on the right) that no batch of labels rules out."""
    i, j = pairs
    matches = np.zeros(len(i), np.int32)
    for end, least in BOUNDS:
        at = slice(end - BATCH, end)
        matches += (left[i, at] == right[j, at]).sum(axis=1, dtype=np.int32)
        kept = matches >= least
        i, j, matches = i[kept], j[kept], matches[kept]
    return i, j


def overlap_is_enough(common: np.ndarray, size: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (size + sizes - common)


_SIGNED = "doc_id long, text_hash long, set_key binary, size long, sig binary"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_PER_BATCH):
            batch = whole.slice(at, ROWS_PER_BATCH)
            keys, sizes, sigs = [], [], []
            for text in pc.ascii_lower(batch.column("text")).to_pylist():
                found = grams(text)
                some = len(found) > 0
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if some else None)
                sizes.append(len(found))
                sigs.append(signature(found) if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "set_key", "size", "sig"])
    forget_words()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def _hot(rows: DataFrame, key: str) -> HotKeys:
    """Keys with more rows than a task should get; a share of the rows each, so their number is bounded."""
    found = hot_keys(rows.select(key), [key], min_rows=1)
    return HotKeys({k: n for k, n in found.rows.items() if n > PER_PART}, PER_PART) or NONE_HOT


def _told(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Joins facts, one row per key, to rows of which a few keys may hold most."""
    return spread_join(rows, facts, [key], how, _hot(rows, key))


def _dealt(rows: DataFrame, key: str, by: str) -> DataFrame:
    """Adds `part` and `parts`: the rows of a hot key are dealt out over several parts."""
    hot = _hot(rows, key)
    parts = hot.parts(rows, [key]) if hot else F.lit(1)
    return rows.withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int"))


def met_in_bands(classes: DataFrame) -> DataFrame:
    """(key, node, n): the classes of every bucket of two or more, with its size."""
    width = ROWS * LABEL_BYTES
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))))
    rows = classes.select("node", F.explode(bands).alias("key"))
    sizes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    # Buckets above a share of all rows, whose number that bounds, decide how rows are dealt.
    total = classes.count() * BANDS
    floor = max(PER_PART, total // 8192)
    hot = HotKeys({r["h"]: r["n"] for r in sizes.where(F.col("n") > floor).select(
        F.xxhash64("key").alias("h"), "n").collect()}, PER_PART)
    return stored(spread_join(rows, sizes, ["key"], "inner", hot), "met")


def stars(met: DataFrame) -> DataFrame:
    """(hub, node, thick): each class with the hubs of its buckets; thick ones held a third class.

    The hub of a bucket is the class whose buckets are largest altogether, which in a group of near
    copies is the text that most of them were made from.
    """
    weights = met.groupBy("node").agg(F.sum("n").alias("weight"))
    leads = F.max(F.struct("weight", (-F.col("node")).alias("first")))
    hubs = met.join(weights, "node").groupBy("key").agg((-leads["first"]).alias("hub"))
    found = _told(met, hubs, "key").where("node <> hub")
    return stored(found.groupBy("hub", "node").agg((F.max("n") > 2).alias("thick")), "stars")


def _led(members: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """Members by (hub, part), each part led by a row of its hub, with the columns of `facts`."""
    hubs = members.select("hub", "parts").distinct().withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    lead = hubs.join(facts.withColumnRenamed("node", "hub"), "hub").select(
        "hub", "part", F.lit(None).cast("long").alias("node"), *columns)
    rest = members.join(facts, "node").select("hub", "part", "node", *columns)
    return lead.union(rest).repartition("hub", "part").sortWithinPartitions(
        "hub", "part", F.col("node").asc_nulls_first())


_LINK = "hub long, node long"
_LINK_TYPE = pa.schema([("hub", pa.int64()), ("node", pa.int64())])


def _labels(sig: pa.BinaryArray) -> np.ndarray:
    return np.frombuffer(b"".join(sig.to_pylist()), "<u2").reshape(len(sig), LABELS)


def _sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node) of the members that the sequential comparison with their hub keeps."""
    hub_labels = np.zeros((1, LABELS), "<u2")
    for batch in batches:
        hubs, nodes = batch.column("hub").to_numpy(), batch.column("node")
        labels = _labels(batch.column("sig"))
        leads = np.asarray(nodes.is_null())
        # Each row is compared with the last lead before it, at first that of the batch before.
        known = np.concatenate((hub_labels, labels[leads]))
        of = np.cumsum(leads)
        rows = np.flatnonzero(~leads)
        i, _ = survivors(labels, known, (rows, of[rows]))
        hub_labels = known[-1:]
        yield pa.RecordBatch.from_arrays(
            [pa.array(hubs[i]), nodes.take(pa.array(i))], schema=_LINK_TYPE)


def _set(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hub, node) of the members whose full set is similar enough to that of their hub."""
    lead = np.empty(0, np.uint64)
    for batch in batches:
        links = []
        for hub, node, data in zip(*(batch.column(c).to_pylist() for c in ("hub", "node", "grams")),
                                   strict=True):
            own = _set(data)
            if node is None:
                lead = own
                continue
            common = len(np.intersect1d(lead, own, assume_unique=True))
            if overlap_is_enough(common, len(lead), len(own)):
                links.append({"hub": hub, "node": node})
        yield pa.RecordBatch.from_pylist(links, _LINK_TYPE)


def _gram_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_PER_BATCH):
            batch = whole.slice(at, ROWS_PER_BATCH)
            found = [grams(t).astype("<u8").tobytes()
                     for t in pc.ascii_lower(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(found, pa.binary())], ["node", "grams"])
    forget_words()


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, grams): the full sets of some classes, from the text that stands for each."""
    wanted = classes.join(nodes, "node").select(
        F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "node")
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))
    texts = _keyed(docs).join(broadcast_if_small(wanted), same).select("node", "text")
    found = texts.mapInArrow(lean(_gram_bytes), "node long, grams binary")
    # Rows repeated with their id and text give their class several times.
    return stored(found.groupBy("node").agg(F.first("grams").alias("grams")), "sets")


def _rooted(links: DataFrame) -> DataFrame:
    """(node, root) of all ends of links (hub, node).

    Hubs that share a member are joined first. They are few, and their graph has no node with a
    link to each member of a group; members then follow the least of their hubs.
    """
    ends = links.union(links.select("hub", F.col("hub").alias("node")).distinct())
    least = stored(ends.groupBy("node").agg(F.min("hub").alias("least")), "least-hubs")
    between = links.join(least, "node").where("hub <> least").select(
        F.col("hub").alias("a"), F.col("least").alias("b")).distinct()
    # A hub may be a member of another hub.
    over = least.join(links.select(F.col("hub").alias("node")).distinct(), "node").where(
        "node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    roots = components(between.union(over)).select(F.col("node").alias("least"), "root")
    return stored(_told(least, roots, "least", "left").select(
        "node", F.coalesce("root", "least").alias("root")), "roots")


def _cells(pairs: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """(hub, low, high, side, node, comp): members of blocks that have to be compared.

    Members that share a bucket share its hub. Those of a hub are ordered by component and cut
    into blocks; blocks that hold the largest component alone need not meet each other.
    """
    own = pairs.where("thick").select("hub", "node").join(roots, "node", "left").join(
        classes.select("node", "size"), "node").select(
        "hub", "node", F.coalesce("root", "node").alias("comp"), (F.col("size") * 8 + 1024).alias("load"))
    own = stored(own, "members")
    # A group whose members are all of one component is settled.
    open_groups = own.groupBy("hub").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("n"),
        F.sum("load").alias("load")).where("c0 <> c1").select(
        "hub", F.greatest(F.ceil(F.col("load") / BLOCK_BYTES), F.ceil(F.col("n") / MOST_MEMBERS)).alias("cuts"),
        F.col("n").alias("members"))
    left = _told(own.select("hub", "node", "comp"), open_groups, "hub")
    placed = number_rows(left, [F.col("comp"), F.col("node")], "at", group="hub")
    placed = stored(placed.withColumn(
        "block", F.call_function("div", F.col("at") * F.col("cuts"), F.col("members"))).select(
        "hub", "node", "comp", "block"), "placed")
    blocks = placed.groupBy("hub", "block").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    pure = blocks.where("c0 = c1").groupBy("hub", "c0").agg(F.count(F.lit(1)).alias("n"))
    main = pure.groupBy("hub").agg(F.max(F.struct("n", F.col("c0").alias("comp"))).alias("m")).select(
        "hub", F.col("m.comp").alias("main"))
    marked = stored(blocks.join(main, "hub", "left").select(
        "hub", "block", F.coalesce((F.col("c0") == F.col("c1")) & (F.col("c0") == F.col("main")),
                                   F.lit(False)).alias("settled")), "marked")
    rest = marked.where("not settled").select("hub", F.col("block").alias("one"))
    cells = rest.join(marked, "hub").where("settled or block >= one").select(
        "hub", "one", F.col("block").alias("two"))
    sides = F.when(F.col("one") == F.col("two"), F.array(F.struct(F.lit(0).alias("side"), F.col("one").alias("block")))) \
        .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("one").alias("block")),
                           F.struct(F.lit(1).alias("side"), F.col("two").alias("block"))))
    named = cells.select("hub", "one", "two", F.explode(sides).alias("s")).select(
        "hub", "one", "two", "s.side", "s.block")
    return placed.join(named, ["hub", "block"]).select("hub", "one", "two", "side", "node", "comp")


class _Forest:
    """Which nodes of a cell are linked by now."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, n: int) -> int:
        passed = []
        while n in self.above:
            passed.append(n)
            n = self.above[n]
        self.above.update(dict.fromkeys(passed, n))
        return n

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def _joined(left: list[dict], right: list[dict], alone: bool) -> Iterator[tuple[int, int]]:
    """Links that join components of two blocks (or, alone, of one block with itself)."""
    labels = [np.frombuffer(b"".join(r["sig"] for r in rows), "<u2").reshape(len(rows), LABELS)
              for rows in (left, right)]
    comps = [np.array([r["comp"] for r in rows]) for rows in (left, right)]
    sets = [_set(r["grams"]) for r in right]
    sizes = np.array([len(s) for s in sets])
    words, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    forest = _Forest()
    first = labels[1][:, :BATCH]
    for at in range(0, len(left), 32):
        # The first batch for all pairs, the others for those that are left.
        near = (labels[0][at : at + 32, None, :BATCH] == first[None]).sum(axis=2) >= BOUNDS[0][1]
        near &= comps[0][at : at + 32, None] != comps[1][None, :]
        i, j = np.nonzero(near)
        i += at
        if alone:
            i, j = i[i < j], j[i < j]
        i, j = survivors(labels[0], labels[1], (i, j))
        for place in np.unique(i).tolist():
            mine, comp = left[place], int(comps[0][place])
            wanted = j[i == place]
            wanted = np.array([k for k in wanted.tolist() if forest.top(int(comps[1][k])) != forest.top(comp)], int)
            if not len(wanted):
                continue
            own = _set(mine["grams"])
            # Marks the words both have, then counts them for all sets of the block at once.
            spot = np.minimum(np.searchsorted(words, own), len(words) - 1)
            mark = np.zeros(len(words), np.int32)
            mark[spot[words[spot] == own]] = 1
            common = np.add.reduceat(mark[numbers], starts)[wanted]
            for k in wanted[overlap_is_enough(common, len(own), sizes[wanted])].tolist():
                if forest.join(comp, int(comps[1][k])):
                    yield comp, int(comps[1][k])


_EDGE_TYPE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for at in range(0, b.num_rows, 64) for r in b.slice(at, 64).to_pylist())
    for (_, one, two), cell in groupby(rows, key=itemgetter("hub", "one", "two")):
        sides: tuple[list, list] = ([], [])
        for r in cell:
            sides[r["side"]].append(r)
        left, right = sides[0], sides[0] if one == two else sides[1]
        links = [{"a": a, "b": b} for a, b in _joined(left, right, one == two)]
        if links:
            yield pa.RecordBatch.from_pylist(links, _EDGE_TYPE)


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Linked are rows whose sets reach the similarity of 0.85; `component_id` is the least doc_id that
    links lead to (NULL counts as none), and `kept` says whether it is the row's own. A text with
    fewer than five words is one shingle. A NULL or empty text has no shingles and no links: its
    component is its own doc_id. A row without doc_id is kept if its component has no id either.
    Rows with equal texts are linked, repeated rows too, and so rows that share the least doc_id are
    all kept. Other columns are not looked at; an empty table gives no rows.

    A pair at the limit itself is missed with a chance of about 3 in 10 million by the bands and of
    MISS or so by each batch; links found are exact.
    """
    signed = stored(_keyed(docs).mapInArrow(lean(_signed), _SIGNED), "signed")
    classes = stored(signed.where("set_key is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash", "size", "sig")).alias("r"), F.min("doc_id").alias("least"),
    ).select("set_key", F.monotonically_increasing_id().alias("node"), "r.*", "least"), "classes")

    pairs = stored(_dealt(stars(met_in_bands(classes)), "hub", "node"), "pairs")
    labelled = classes.select("node", "sig")
    sifted = stored(_led(pairs, labelled, ["sig"]).mapInArrow(_sifted, _LINK), "sifted")
    wanted = sifted.select("node").union(sifted.select(F.col("hub").alias("node"))).distinct()
    sets = _sets(docs, classes, wanted)
    near = _dealt(sifted, "hub", "node")
    links = stored(_led(near, sets, ["grams"]).mapInArrow(_verified, _LINK), "links")
    roots = _rooted(links)

    cells = stored(_cells(pairs, roots, classes), "cells")
    wanted = cells.select("node").distinct()
    more = _sets(docs, classes, wanted.join(sets.select("node"), "node", "left_anti"))
    known = sets.union(more)
    laid = cells.join(labelled, "node").join(known, "node").repartition("hub", "one", "two")
    edges = stored(laid.sortWithinPartitions("hub", "one", "two", "side", "node").mapInArrow(
        lean(_compared), "a long, b long"), "edges")
    over = components(edges).select(F.col("node").alias("comp"), "root")

    # Each class with its component, those without links by themselves.
    in_comp = classes.select("set_key", "node", "least").join(roots, "node", "left").select(
        "set_key", "least", F.coalesce("root", "node").alias("comp"))
    final = stored(_told(in_comp, over, "comp", "left").select(
        "set_key", "least", F.coalesce("root", "comp").alias("top")), "components")
    ids = final.groupBy("top").agg(F.min("least").alias("component_id"))
    facts = _told(final, ids, "top").select("set_key", "component_id")
    rows = _told(signed.select("doc_id", "size", "set_key"), facts, "set_key", "left")
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", F.col("size").alias("n_shingles"), own.alias("component_id"),
        F.col("doc_id").eqNullSafe(own).alias("kept"))
