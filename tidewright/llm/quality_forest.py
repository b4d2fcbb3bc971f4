"""Quality rules with an isolation forest over their statistics.

Rules count things in each whole text, and their ratios are the forest's features. Trees are grown
on good labelled rows by random splits: a feature, drawn by how well it alone tells good and bad
labelled rows apart, and a cut anywhere in the box of all labelled rows, not only where the good
ones lie. So a text that a few splits set apart from all good rows has short paths in most trees,
whether one ratio is extreme or several are unusual together. The mean path length decides; the score
at which a text is rejected comes from labelled rows that took no part in growing the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import lean
from tidewright.llm.words import words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
SYMBOLS = b"#*$%&|<>"

# Labelled rows the forest and its threshold are made from, at any input size.
LABELLED_ROWS = 20_000
TREES = 200
ROWS_PER_TREE = 256
# Share of good labelled rows a threshold may reject.
MAX_GOOD_REJECTED = 0.0005
# What a feature weighs at least in the draw of splits, beside the share of bad rows it tells apart.
LEAST_WEIGHT = 0.03

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = [
    "symbols_per_word", "bars_per_word", "repeated_share", "duplicate_line_share",
    "upper_share", "exclamations_per_word", "sameness", "digit_share",
]
ROWS_PER_BATCH = 2_000


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words in windows of so many words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    found = ids[:n]
    for step in range(1, window):
        if step > 1:
            found = np.unique(found, return_inverse=True)[1]
        found = found * len(numbers) + ids[step : step + n]
    _, which, counts = np.unique(found, return_inverse=True, return_counts=True)
    twice = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for step in range(window):
        covered[step : step + n] |= twice
    return int(covered.sum())


_SPACES = " \t\n\x0b\x0c\r"


def statistics(text: str) -> list[float]:
    """The counts of `COUNTS` and the ratios of `RATIOS`; all zero for a text with no word."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * (len(COUNTS) + len(RATIOS))
    chars = sum(map(len, words))
    seen = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    symbols = int(seen[list(SYMBOLS)].sum())
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    duplicate = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    bars = int(seen[ord("|")])
    return [
        n, chars, symbols, duplicate, repeated,
        (symbols - bars) / n,
        bars / n,
        repeated / n,
        duplicate / len(lines),
        upper / max(1, upper + lower),
        int(seen[ord("!")]) / n,
        # Long texts repeat words by nature, so the power of the length that distinct words are.
        1 - math.log(len(set(words))) / math.log(n) if n > 1 else 0.0,
        int(seen[48:58].sum()) / chars,
    ]


def _table(texts: list[str | None]) -> np.ndarray:
    width = len(COUNTS) + len(RATIOS)
    return np.array([statistics(t or "") for t in texts], float).reshape(len(texts), width)


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe,
                    np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 at a leaf), cut, left child (right is next), path length."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    norm: float
    threshold: float = 1.0

    def scores(self, ratios: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the paths the higher."""
        total = np.zeros(len(ratios))
        rows = np.arange(len(ratios))
        for feature, cut, child, path in zip(
            self.feature, self.cut, self.child, self.path, strict=True
        ):
            at = np.zeros(len(ratios), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = ratios[rows, np.maximum(f, 0)] >= cut[at]
                at = np.where(inner, child[at] + right, at)
            total += path[at]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def weights(ratios: np.ndarray, good: np.ndarray, max_good_rejected: float = MAX_GOOD_REJECTED
            ) -> np.ndarray:
    """How much each feature counts in the draw of splits.

    The share of bad rows above all good ones but the share that may be rejected, and a little more,
    so that no feature is left out.
    """
    good_rows, bad_rows = np.sort(ratios[good], axis=0), ratios[~good]
    top = good_rows[len(good_rows) - 1 - int(len(good_rows) * max_good_rejected)]
    beyond = (bad_rows > top).mean(axis=0) if len(bad_rows) else np.zeros(ratios.shape[1])
    return beyond + LEAST_WEIGHT


def grow(ratios: np.ndarray, good: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE,
         seed: int = 11) -> Forest:
    """A forest of random splits around the good rows, within the box of all rows.

    Each tree takes its own `rows` good rows and is no deeper than their log2. A side of a split
    may hold none of them: what lies there is told apart at that depth.
    """
    draw = np.random.default_rng(seed)
    inside, weight = ratios[good], weights(ratios, good)
    rows = min(rows, len(inside))
    depth_limit = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    grown = []
    for _ in range(trees):
        sample = inside[draw.choice(len(inside), rows, replace=False)]
        feature, cut, child, path = [-1], [0.0], [0], [0.0]
        todo = [(0, sample, 0, ratios.min(axis=0), ratios.max(axis=0))]
        while todo:
            node, part, depth, low, high = todo.pop()
            usable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(part) < 2 or not len(usable):
                path[node] = depth + float(_expected_path(len(part)))
                continue
            share = weight[usable]
            f = int(draw.choice(usable, p=share / share.sum()))
            at = draw.uniform(low[f], high[f])
            feature[node], cut[node], child[node] = f, at, len(feature)
            goes = part[:, f] >= at
            below, above = high.copy(), low.copy()
            below[f] = above[f] = at
            for side, bounds in ((part[~goes], (low, below)), (part[goes], (above, high))):
                todo.append((len(feature), side, depth + 1, *bounds))
                feature.append(-1), cut.append(0.0), child.append(0), path.append(0.0)
        grown.append((feature, cut, child, path))
    widest = max(len(g[0]) for g in grown)

    def padded(i: int, kind: type) -> np.ndarray:
        return np.array([g[i] + [g[i][-1]] * (widest - len(g[i])) for g in grown], kind)

    norm = max(float(_expected_path(rows)), 1.0)
    return Forest(padded(0, int), padded(1, float), padded(2, int), padded(3, float), norm)


def calibrated(scores: np.ndarray, good: np.ndarray,
               max_good_rejected: float = MAX_GOOD_REJECTED) -> float:
    """The lowest score that rejects at most this share of the good rows (and none if no row is bad)."""
    if good.all() or not len(scores):
        return 1.0
    if not good.any():
        return 0.0
    ranked = np.sort(scores[good])[::-1]
    floor = ranked[int(len(ranked) * max_good_rejected)]
    above = scores[scores > floor]
    # Halfway to the next score seen, so that no good row sits on the threshold.
    return float((floor + above.min()) / 2) if len(above) else 1.0


def labelled_statistics(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS):
    """Statistics, labels and halves of at most `limit` labelled rows, taken by a hash of their doc_id.

    The half comes from a hash of the statistics, so texts of the same statistics share one.
    Rows with a NULL doc_id or quality are left out, and a doc_id with both labels counts as bad.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most `limit` rows of two numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _table(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality").cast(pa.int32()), pa.array(list(found))], ["quality", "found"]
            )

    rows = texts.mapInArrow(lean(measure), "quality int, found array<double>")
    # Several rows may share a doc_id; a limit on them as well keeps the driver's share bounded.
    hashed = rows.withColumn("half", F.pmod(F.shiftright(F.xxhash64("found"), 20), F.lit(2)))
    kept = hashed.orderBy(F.xxhash64("found"), "quality").limit(limit).toArrow()
    width = len(COUNTS) + len(RATIOS)
    found = np.array(kept.column("found").to_pylist(), float).reshape(kept.num_rows, width)
    return found, kept.column("quality").to_numpy() > 0, kept.column("half").to_numpy() > 0


def both_kinds(good: np.ndarray) -> bool:
    return bool(good.any() and not good.all())


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> Forest | None:
    """A forest with its threshold, from labelled rows that pass the base rules; None without a good one.

    One half of the rows grows the trees, the other calibrates. A half without good or without bad
    rows gives way to all rows, as few labels leave no choice.
    """
    found, good, half = labelled_statistics(docs, labels, limit)
    passed = ~base_failed(found)
    ratios, good, half = found[passed][:, len(COUNTS) :], good[passed], half[passed]
    if not good.any():
        return None
    every = np.ones(len(good), bool)
    grows = ~half if both_kinds(good[~half]) else every
    tells = half if both_kinds(good[half]) else every
    forest = grow(ratios[grows], good[grows])
    return replace(forest, threshold=calibrated(forest.scores(ratios[tells]), good[tells]))


def judge(texts: list[str | None], forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics, scores (0 without a forest) and verdicts (True: keep) of texts."""
    found = _table(texts)
    ratios = found[:, len(COUNTS) :]
    scores = forest.scores(ratios) if forest is not None and len(texts) else np.zeros(len(texts))
    anomalous = scores > (forest.threshold if forest is not None else 1.0)
    return found, scores, ~base_failed(found) & ~anomalous


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_BATCH):
            yield batch.slice(at, ROWS_PER_BATCH)


def verdicts(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """Per row: doc_id, the five counts, base_failed, score and kept. A NULL text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            found, scores, kept = judge(batch.column("text").to_pylist(), forest)
            counts = [pa.array(found[:, i].astype(np.int64)) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array(base_failed(found)),
                 pa.array(scores), pa.array(kept)],
                ["doc_id", *COUNTS, "base_failed", "score", "kept"],
            )

    longs = ", ".join(f"{c} long" for c in COUNTS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        lean(run), f"doc_id long, {longs}, base_failed boolean, score double, kept boolean"
    )


def keep_good(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows whose text passes the base rules and the forest, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(judge(text.to_pylist(), forest)[2]))

    return docs.mapInArrow(lean(run), docs.schema)
