"""Periodic runs of words, found in a grammar of each text.

A run is a stretch of consecutive words with a smallest period q, at least three periods and 24
words long, that no neighbouring word extends. Words become numbers, Re-Pair replaces the most
frequent pair of neighbours by a new symbol again and again, and what is left is read as a balanced
tree. A run crosses the boundary between the two parts of the least node that holds it, and lies in
that node whole. So the runs that cross a boundary are looked for once per symbol, however often
the symbol occurs, and then translated to all its places in the derivation; intervals of one period
that overlap by a period are merged to the maximal one.

Texts are independent, so nothing is shuffled and a task holds a few texts at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import lean
from tidewright.llm.words import slices, words_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
# Grams of so many words: of those within a run, each occurs twice there at least, and of the
# places at which a run equals itself a period on, so many in a row begin or end at a boundary.
GRAM = 8
ROUNDS = 16

Interval = tuple[int, int, int]
Prepare = Callable[[int | None, list[str]], list[str]]


def gram_hashes(numbers: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the grams that begin at each word; equal grams have equal hashes."""
    n = len(numbers) - GRAM + 1
    found = numbers[:n].astype(np.uint64)
    for step in range(1, GRAM):
        found = found * np.uint64(0x9E3779B97F4A7C15) + numbers[step : step + n].astype(np.uint64)
        found ^= found >> np.uint64(31)
    return found


def stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    """Stretches outside which no run can lie: in them, every gram occurs twice.

    Looking again at what is left a few times leaves out passages that merely come back.
    """
    todo, found = [(0, len(numbers), 0)], []
    while todo:
        a, b, rounds = todo.pop()
        if b - a < LEAST_WORDS:
            continue
        keys = gram_hashes(numbers[a:b])
        order = np.argsort(keys, kind="stable")
        equal = np.diff(keys[order]) == 0
        if not equal.any():
            continue
        twice = np.zeros(len(keys), bool)
        twice[order[:-1][equal]] = twice[order[1:][equal]] = True
        if twice.all() or rounds == ROUNDS:
            found.append((a, b))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], twice, [False]))))
        todo += [(a + x, a + y + GRAM - 1, rounds + 1)
                 for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
    return sorted(found)


def repaired(numbers: np.ndarray) -> tuple[int, list[tuple[int, int]], np.ndarray]:
    """Re-Pair: the first new symbol, the pair each new symbol stands for, and the sequence left.

    Each round takes pairs with the highest count. Of pairs with that count, those without a
    common word or symbol do not touch each other, so they are replaced in one go.
    """
    left, rules = numbers.astype(np.int64), []
    first = int(left.max()) + 1
    while len(left) > 1:
        width = first + len(rules)
        keys = left[:-1] * width + left[1:]
        counted = np.ones(len(keys), bool)
        # Of a word repeated several times, every other pair counts.
        same = np.flatnonzero(left[:-1] == left[1:])
        if len(same):
            begins = np.concatenate(([True], np.diff(same) != 1))
            start = same[begins][np.cumsum(begins) - 1]
            counted[same[(same - start) % 2 == 1]] = False
        places = np.flatnonzero(counted)
        values, at, counts = np.unique(keys[places], return_index=True, return_counts=True)
        most = counts.max()
        if most < 2:
            break
        tied = np.flatnonzero(counts == most)
        used: set[int] = set()
        chosen: dict[int, int] = {}
        for key in values[tied[np.argsort(at[tied], kind="stable")]].tolist():
            pair = divmod(key, width)
            if used.isdisjoint(pair):
                used.update(pair)
                chosen[key] = first + len(rules)
                rules.append(pair)
        wanted = np.array(sorted(chosen))
        hit = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        taken = np.flatnonzero(counted & (wanted[hit] == keys))
        left[taken] = np.array([chosen[k] for k in wanted.tolist()])[hit[taken]]
        left = np.delete(left, taken + 1)
    return first, rules, left


def _primitive(block: np.ndarray) -> bool:
    """Whether a block is not itself a repetition of a shorter one."""
    n = left = len(block)
    divisor = 2
    while left > 1:
        if divisor * divisor > left:
            divisor = left
        if left % divisor:
            divisor += 1
            continue
        while left % divisor == 0:
            left //= divisor
        if np.array_equal(block[n // divisor :], block[: n - n // divisor]):
            return False
    return True


def _stretch(equal: np.ndarray, at: int) -> tuple[int, int] | None:
    """The bounds of the true values around a place."""
    if not 0 <= at < len(equal) or not equal[at]:
        return None
    unequal = np.flatnonzero(~equal)
    i = int(np.searchsorted(unequal, at))
    return (int(unequal[i - 1]) + 1 if i else 0), (int(unequal[i]) if i < len(unequal) else len(equal))


def crossing(numbers: np.ndarray, grams: np.ndarray, a: int, m: int, b: int) -> list[Interval]:
    """(start, end, period) of the runs of numbers[a:b] that cross the boundary before place m.

    A run of period q equals itself q words on, at m - q or at m - 1, and there for a gram on
    one side at least. So only the distances of equal grams are tried, the smallest first.
    """
    longest = (b - a) // LEAST_PERIODS

    def distances(fixed: int, step: int, room: int) -> np.ndarray:
        """Distances at which the gram at `fixed` is found again, leftwards or rightwards."""
        most = min(longest, room)
        if most < 1 or fixed < a or fixed + GRAM > b:
            return np.empty(0, np.int64)
        if step < 0:
            return most - np.flatnonzero(grams[fixed - most : fixed] == grams[fixed])
        return 1 + np.flatnonzero(grams[fixed + 1 : fixed + 1 + most] == grams[fixed])

    before = np.union1d(distances(m, -1, m - a), distances(m - GRAM + 1, -1, m - GRAM + 1 - a))
    after = np.union1d(distances(m - 1, 1, b - GRAM - m + 1), distances(m - GRAM, 1, b - m))
    found: list[Interval] = []
    while len(before) or len(after):
        q = int(min(before[:1].tolist() + after[:1].tolist()))
        equal = numbers[a : b - q] == numbers[a + q : b]
        places = []
        if len(before) and before[0] == q:
            before = before[1:]
            places.append(m - q - a)
        if len(after) and after[0] == q:
            after = after[1:]
            places.append(m - 1 - a)
        for bounds in {_stretch(equal, p) for p in places} - {None}:
            i, j = a + bounds[0], a + bounds[1] + q
            if not i < m < j or j - i < max(LEAST_WORDS, LEAST_PERIODS * q):
                continue
            if not _primitive(numbers[i : i + q]):
                continue
            found.append((i, j, q))
            # Multiples of the period whose stretch holds this run have no runs of their own.
            if j >= m + q:
                before = before[(before % q != 0) | (i > m - before)]
            if i <= m - q:
                after = after[(after % q != 0) | (j < m + after)]
    return found


def _in_grammar(numbers: np.ndarray) -> list[Interval]:
    """All intervals that the boundaries of the grammar's symbols and of its start give."""
    grams = gram_hashes(numbers)
    first, rules, start = repaired(numbers)
    sizes = np.ones(first + len(rules), np.int64)
    for i, (x, y) in enumerate(rules):
        sizes[first + i] = sizes[x] + sizes[y]
    ends = np.cumsum(sizes[start])
    begins = ends - sizes[start]
    intervals: list[Interval] = []

    # What is left of the text, as a balanced tree.
    todo = [(0, len(start))]
    while todo:
        x, y = todo.pop()
        if y - x < 2 or ends[y - 1] - begins[x] < LEAST_WORDS:
            continue
        middle = (x + y) // 2
        intervals += crossing(numbers, grams, int(begins[x]), int(begins[middle]), int(ends[y - 1]))
        todo += [(x, middle), (middle, y)]

    # One place of each symbol, then the runs across its boundary, once.
    place = np.full(first + len(rules), -1, np.int64)
    place[start[::-1]] = begins[::-1]
    own: dict[int, list[Interval]] = {}
    for i in reversed(range(len(rules))):
        at, (x, y) = int(place[first + i]), rules[i]
        place[x], place[y] = at, at + sizes[x]
        if sizes[first + i] >= LEAST_WORDS:
            crossed = crossing(numbers, grams, at, at + int(sizes[x]), at + int(sizes[first + i]))
            if crossed:
                own[first + i] = [(s - at, e - at, q) for s, e, q in crossed]
    holds = np.zeros(first + len(rules), bool)
    for i, (x, y) in enumerate(rules):
        holds[first + i] = first + i in own or holds[x] or holds[y]

    # All places of the symbols that hold a run, from the start downwards.
    places: dict[int, list[np.ndarray]] = {}
    for symbol, at in zip(start.tolist(), begins.tolist(), strict=True):
        if holds[symbol]:
            places.setdefault(symbol, []).append(np.array([at]))
    for symbol in range(first + len(rules) - 1, first - 1, -1):
        if symbol not in places:
            continue
        at = np.concatenate(places.pop(symbol))
        x, y = rules[symbol - first]
        if holds[x]:
            places.setdefault(x, []).append(at)
        if holds[y]:
            places.setdefault(y, []).append(at + sizes[x])
        for s, e, q in own.get(symbol, ()):
            intervals += [(p + s, p + e, q) for p in at.tolist()]
    return intervals


def merged(intervals: list[Interval]) -> list[Interval]:
    """Maximal intervals: of one period, those that overlap by a period are one."""
    found: list[Interval] = []
    for q, start, end in sorted({(q, s, e) for s, e, q in intervals}):
        if found and found[-1][2] == q and start + q <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], end), q)
        else:
            found.append((start, end, q))
    return found


def runs_of(words: list[str]) -> list[Interval]:
    """(start, length, period) of every run, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    found = []
    # Hashes of words may only add stretches; within a stretch, words get numbers of their own.
    for a, b in stretches(np.fromiter(map(hash, words), np.int64, len(words))):
        known: dict[str, int] = {}
        numbers = np.array([known.setdefault(w, len(known)) for w in words[a:b]], np.int64)
        found += [(a + s, e - s, q) for s, e, q in merged(_in_grammar(numbers))]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[Interval]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, in a tenth of the texts made periodic from some place on, by a hash of the id.

    A fixed rule, which gives every table some runs; a text without an id stays as it is.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    # A period is never longer than what is left: it is at most a third of it, and one word.
    block = words[a : a + p]
    return words[:a] + (block * (-(-(n - a) // p)))[: n - a]


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def detected(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """doc_id, runs and collapsed of each row: all runs, and the text's words without repetition.

    `prepare` may change the words of a text before. A NULL or empty text has no words, no runs and
    an empty collapsed text; rows without an id, repeated rows and extra columns are no matter, and
    a text of any length is taken whole. An empty table gives no rows. Words of the collapsed text
    are joined by one space.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            runs, left = [], []
            for doc_id, text in zip(ids, texts, strict=True):
                words = words_of(text or "")
                words = prepare(doc_id, words) if prepare else words
                found = runs_of(words)
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                left.append(" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(runs, _RUN_TYPE), pa.array(left, pa.string())],
                ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(run), f"doc_id long, runs {_RUNS}, collapsed string")


def _beats(a: Column, b: Column) -> Column:
    """Whether a run has more periods than another, exactly; a tie goes to the earlier one."""
    return a["length"] * b["period"] > b["length"] * a["period"]


def digests(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """Per row the number of runs, the one with the most periods, and digests of runs and text."""
    found = detected(docs, prepare)
    # Runs are in order of start and period, so of equal ones the first stays.
    none = F.lit(None).cast(_RUNS[6:-1])
    best = F.aggregate("runs", none, lambda a, r: F.when(a.isNull() | _beats(r, a), r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
        r["period"].cast("string"), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), F.col("best.period")
    milli = F.call_function("div", length * 1000, period).alias("exponent_milli")
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"),
                       period.alias("period"), milli, "runs_sha256", "collapsed_sha256")
