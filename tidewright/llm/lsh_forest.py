"""Near copies by the Jaccard similarity of word n-grams, with a MinHash LSH forest.

Texts become sets of hashed n-grams; texts with equal sets are one class, and a class has one
signature. Each tree of the forest orders the classes by a run of their signature, as a prefix
trie. Classes that share a prefix of the current depth in any tree are candidates. Candidates are
verified exactly, and the similarities found tell the recall of each depth; prefixes are
shortened to the longest depth that reaches the target, and the join is done again there.

Candidates are not written out as pairs: classes that meet in tries form clusters, a cluster is cut
into blocks, and each pair of blocks is one task that compares its members as a matrix product and
returns counts per class. So every link counts, whatever the size of a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.shared import broadcast_if_small, lean, own_names, stored
from tidewright.llm.words import words_of

GRAM = 5
SIMILARITY = 0.8
TREES, DEPTH = 48, 8
# Depths tried, and the share of links that the depth in use has to find.
SHORTEST = 4
RECALL = 0.99999
LABEL_BYTES = 2
# A block of a cluster holds so many bytes of text, each text counted with so many more.
BLOCK_BYTES, TEXT_BYTES = 8 << 20, 32 << 10
CACHED_WORDS = 150_000
ROWS_PER_BATCH = 256

_draw = np.random.default_rng(2024)
_MULTIPLY = _draw.integers(1, 1 << 32, TREES * DEPTH, np.uint32) | np.uint32(1)
_ADD = _draw.integers(0, 1 << 32, TREES * DEPTH, np.uint32)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_HASHES = _WordHashes()


def forget_words() -> None:
    """Frees the hashes of words, which an idle worker would keep otherwise."""
    _HASHES.clear()


def grams(text: str | None, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of words; a shorter text is one gram."""
    words = words_of(text or "")
    if not words:
        return np.empty(0, np.uint64)
    # A cache that is cleared midway still gives every word its hash.
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    last = len(words) - n + 1
    found = hashes[:last].copy()
    for step in range(1, n):
        found *= np.uint64(0x9E3779B97F4A7C15)
        found += hashes[step : step + last]
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return np.unique(found)


def signature(found: np.ndarray) -> bytes:
    """One 16-bit label per tree and level, from the least value of a random linear map each."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_MULTIPLY), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        part = _MULTIPLY[:, None] * low[None, at : at + 512]
        part += _ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("<u2").tobytes()


_SIGNED = "doc_id long, text_hash long, set_key binary, bytes long, sig binary"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS_PER_BATCH):
            batch = whole.slice(at, ROWS_PER_BATCH)
            keys, sizes, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                found = grams(text)
                some = len(found) > 0
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if some else None)
                sizes.append(len(text or ""))
                sigs.append(signature(found) if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())],
                ["doc_id", "text_hash", "set_key", "bytes", "sig"],
            )
    # An idle worker would keep its memory otherwise.
    _HASHES.clear()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def linked_depth(classes: DataFrame, depth: int) -> DataFrame:
    """Edges (a, b) from each class to the first of those that share a prefix with it in a tree."""
    step = DEPTH * LABEL_BYTES
    prefix = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.xxhash64(t, F.substring(F.col("sig"), t * step + 1, F.lit(depth * LABEL_BYTES))))
    rows = classes.select("node", F.explode(prefix).alias("prefix"))
    # The trie in order: the first node of a prefix is known while its rows pass by.
    in_trie = Window.partitionBy("prefix").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    edges = rows.select(F.col("node").alias("a"), F.first("node").over(in_trie).alias("b"))
    return edges.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that edges lead to, for every node with an edge.

    Nodes are hung under their least neighbours, first all larger ones and then all smaller ones,
    until each hangs under one root. Rounds grow with the logarithm of the number of nodes.
    """
    found = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        found = stored(small, "edges")
        roots = found.select(F.col("b").alias("a")).distinct()
        if found.join(roots, "a", "left_semi").isEmpty() and found.groupBy("a").count().where("count > 1").isEmpty():
            break
    return found.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of each left set with each right set (or with each left one)."""
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[which] > 1
    owner, which = owner[shared], which[shared]
    numbers = np.cumsum(counts > 1) - 1
    which = numbers[which]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    total = np.zeros((len(left), len(right) if right else len(left)), np.int64)
    width = 4096
    for first in range(0, int(which[-1]) + 1 if len(which) else 0, width):
        a, b = np.searchsorted(which, [first, first + width])
        cells = np.zeros((len(sets), width), np.float32)
        cells[owner[a:b], which[a:b] - first] = 1
        x = cells[: len(left)]
        # Counts of one slice are at most `width`, which a float32 holds exactly.
        total += (x @ (cells[len(left) :] if right else x).T).astype(np.int64)
    return total


def recall_at(similarity: np.ndarray, depth: int) -> np.ndarray:
    return 1 - (1 - similarity**depth) ** TREES


_VERIFIED = "node long, links long, copies long, parent long, seen array<double>"


def _verified(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Per class of a cell: its links and their copies, the least class it is linked to by a chain
    within the cell, and for each depth the links that depth is expected to stand for."""
    limit = Fraction(str(similarity))
    rows = (r for b in batches for at in range(0, b.num_rows, 64) for r in b.slice(at, 64).to_pylist())
    for (_, low, high), group in groupby(rows, key=itemgetter("root", "low", "high")):
        sides: tuple[dict, dict] = ({}, {})
        for r in group:
            side = sides[r["block"] != low]
            if r["node"] not in side:
                side[r["node"]] = (grams(r["text"]), r["n"])
        left = sorted(sides[0])
        right = sorted(sides[1]) if low != high else left
        if not left or not right:
            continue
        a = [sides[0][n][0] for n in left]
        b = [sides[1][n][0] for n in right] if low != high else None
        common = _overlaps(a, b)
        sizes_a = np.array([len(s) for s in a])
        sizes_b = np.array([len(s) for s in b]) if b else sizes_a
        union = sizes_a[:, None] + sizes_b[None, :] - common
        linked = common * limit.denominator >= union * limit.numerator
        if b is None:
            np.fill_diagonal(linked, False)
        close = np.where(linked, common / union, 1.0)
        stands = [np.where(linked, 1 / recall_at(close, d), 0.0) for d in range(SHORTEST, DEPTH + 1)]
        parents = _chains(left, right, linked)
        counts_a = np.array([sides[0][n][1] for n in left])
        counts_b = np.array([sides[1][n][1] for n in right]) if b else counts_a
        made = _cell_rows(left, linked, counts_b, parents, [s.sum(axis=1) for s in stands])
        if b is not None:
            made += _cell_rows(right, linked.T, counts_a, parents, [s.sum(axis=0) for s in stands])
        if made:
            yield pa.RecordBatch.from_pylist(made, pa.schema([
                ("node", pa.int64()), ("links", pa.int64()), ("copies", pa.int64()),
                ("parent", pa.int64()), ("seen", pa.list_(pa.float64()))]))
    _HASHES.clear()


def _cell_rows(nodes: list[int], linked: np.ndarray, copies: np.ndarray, parents: dict,
               stands: list[np.ndarray]) -> list[dict]:
    links = linked.sum(axis=1)
    return [
        {"node": nodes[i], "links": int(links[i]), "copies": int(copies[linked[i]].sum()),
         "parent": parents[nodes[i]], "seen": [float(s[i]) for s in stands]}
        for i in np.flatnonzero(links)
    ]


def _chains(left: list[int], right: list[int], linked: np.ndarray) -> dict[int, int]:
    parents = {n: n for n in (*left, *right)}

    def top(n: int) -> int:
        while parents[n] != n:
            parents[n] = n = parents[parents[n]]
        return n

    for i, n in enumerate(left):
        for j in np.flatnonzero(linked[i]):
            x, y = top(n), top(right[j])
            parents[max(x, y)] = min(x, y)
    return {n: top(n) for n in parents}


def _block(load: Column) -> Column:
    return F.floor((load - 1) / BLOCK_BYTES).cast("long")


def _verify(docs: DataFrame, classes: DataFrame, clusters: DataFrame, similarity: float) -> DataFrame:
    narrow = classes.select("node", "doc_id", "text_hash", "bytes", "n")
    members = clusters.join(narrow, "node").withColumn("part", F.shiftright("node", 33))
    members = members.withColumn("load", F.col("bytes") + TEXT_BYTES)
    # Blocks are cut by bytes, so neither many nor very long texts make one large. The running
    # sum of a cluster is put together from its parts, so no task orders a whole cluster.
    whole = Window.partitionBy("root")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = members.groupBy("root", "part").agg(F.sum("load").alias("load")).select(
        "root", "part", F.coalesce(F.sum("load").over(earlier), F.lit(0)).alias("before"),
        _block(F.sum("load").over(whole)).alias("last"))
    ordered = Window.partitionBy("root", "part").orderBy("node").rowsBetween(
        Window.unboundedPreceding, 0)
    placed = stored(members.withColumn("load", F.sum("load").over(ordered)).join(
        parts, ["root", "part"]).withColumn("block", _block(F.col("before") + F.col("load"))), "blocks")
    texts = _keyed(docs).join(
        broadcast_if_small(placed.select(
            F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), "node", "root", "n", "block", "last")),
        F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    cells = texts.select("root", "node", "n", "block", "text", other.alias("other")).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "n", "text")
    ready = cells.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    return stored(ready.mapInArrow(lean(lambda b: _verified(b, similarity)), _VERIFIED), "links")


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, text_hash, class_id, n_links and n_classes.

    `n_links` is the number of other rows whose n-gram sets are at least so similar (equal sets
    included), `n_classes` the number of different sets among them, `class_id` the least doc_id
    that links lead to (NULL counts as none). A text without a word (or NULL) has no links and is
    a class of its own: its class_id is its doc_id.
    """
    signed = stored(_keyed(docs).mapInArrow(lean(_signed), _SIGNED), "signed")
    worded = signed.where("set_key is not null")
    classes = stored(worded.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash", "bytes", "sig")).alias("r"), F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("least"),
    ).select("set_key", F.monotonically_increasing_id().alias("node"), "r.*", "n", "least"), "classes")

    depth = DEPTH
    while True:
        clusters = components(linked_depth(classes, depth))
        verified = _verify(docs, classes, clusters, similarity)
        sums = verified.agg(
            F.sum("links").alias("links"),
            *[F.sum(F.col("seen")[i]).alias(f"d{SHORTEST + i}") for i in range(DEPTH - SHORTEST + 1)],
        ).first()
        # The longest prefixes that would find the share asked for of links as similar as these.
        enough = [d for d in range(SHORTEST, depth + 1)
                  if not sums["links"] or sums["links"] >= recall * sums[f"d{d}"]]
        wanted = max(enough, default=SHORTEST)
        if wanted >= depth:
            break
        depth = wanted

    linked = verified.groupBy("node").agg(
        F.sum("links").alias("links"), F.sum("copies").alias("copies"))
    groups = components(verified.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    of_group = groups.join(classes.select("node", "least"), "node").groupBy("root").agg(
        F.min("least").alias("class_id"))
    told = classes.select("set_key", "node", "n", "least").join(linked, "node", "left").join(
        groups.join(of_group, "root").select("node", "class_id"), "node", "left")
    facts = told.select(
        F.col("set_key").alias("__key"), F.coalesce("class_id", "least").alias("class_id"),
        (F.coalesce("copies", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("links", F.lit(0)).alias("n_classes"))
    return signed.select("doc_id", "text_hash", "set_key").join(
        facts, F.col("set_key") == F.col("__key"), "left").select(
        "doc_id", "text_hash",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_classes", F.lit(0)).alias("n_classes"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows without near copies: of each class the row with the least doc_id (and text hash).

    Rows that are not NULL-safe equal in doc_id and text stay apart; of rows equal in both one stays.
    Texts without a word all stay.
    """
    told = stored(near_copies(docs, similarity).where("n_links > 0"), "copies")
    first = told.groupBy("class_id").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")).select(
        F.col("r.doc_id").alias("__d"), F.col("r.text_hash").alias("__t"))
    same = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__t"))
    gone = told.join(first, same, "left_anti").select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    # The operator's own columns bear names that no column of the input has.
    row_id, row_text = own_names(docs, "row_id", "row_text")
    hashed = docs.withColumns({row_id: F.col("doc_id").cast("long"), row_text: F.xxhash64("text")})
    match = F.col(row_id).eqNullSafe(F.col("__d")) & (F.col(row_text) == F.col("__t"))
    kept = hashed.join(broadcast_if_small(gone), match, "left_anti")
    again = told.groupBy("doc_id", "text_hash").count().where("count > 1").select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"))
    if not again.isEmpty():
        # Rows that are not among the repeats found, such as texts without a word, stay as they are.
        again = broadcast_if_small(again)
        once = kept.join(again, match, "left_semi").dropDuplicates([row_id, row_text])
        kept = kept.join(again, match, "left_anti").unionByName(once)
    return kept.drop(row_id, row_text)
