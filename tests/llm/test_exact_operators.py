"""Whitening, near copies by Bayesian verification, and periodic runs, against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from tidewright.llm import bayes_dedup, periodic, whitening
from tidewright.llm.queries import QUERIES
from tidewright.llm.shared import ship_package

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, runs int, collapsed string, component_id string, size int, row int"
_draw = random.Random(8)


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2, 3) for i, t in texts], SCHEMA).repartition(3)


def words(n, kinds=400):
    return [f"w{_draw.randrange(kinds)}" for _ in range(n)]


# Periodic runs


def brute_runs(text):
    known, out = {}, []
    x = np.array([known.setdefault(w, len(known)) for w in text])
    for q in range(1, len(x) // 3 + 1):
        equal = x[:-q] == x[q:]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False]))))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            n, block = j - i + q, x[i : i + q]
            smaller = any(q % d == 0 and (block[d:] == block[:-d]).all() for d in range(1, q))
            if n >= max(24, 3 * q) and not smaller:
                out.append((i, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words():
    n, kinds = _draw.randrange(260), _draw.choice([1, 2, 3, 5, 40])
    text = [str(_draw.randrange(kinds)) for _ in range(n)]
    for _ in range(_draw.randrange(3)):
        if n > 30:
            a = _draw.randrange(n)
            p, e = _draw.randrange(1, 2 + (n - a) // 3), _draw.randrange(a, n + 1)
            text[a:e] = (text[a : a + p] * n)[: e - a]
            if e - a > 3 and _draw.random() < 0.3:
                text[_draw.randrange(a, e)] = "z"
    if _draw.random() < 0.3:
        block = ["a"] * _draw.randrange(1, 30) + ["b"] * _draw.randrange(3)
        text = block * _draw.randrange(1, 8) + text
    return text


def test_runs_equal_brute_force():
    for _ in range(1500):
        text = some_words()
        assert periodic.runs_of(text) == brute_runs(text), text


@pytest.mark.parametrize("text", [
    ["a"] * 30_000, [str(i % 4000) for i in range(20_000)], ("x " * 30 + "y ").split() * 60,
    ("a b c a b d " * 700).split(), "a b a a b a b a a b a a b".split() * 20,
])
def test_runs_of_long_texts(text):
    found = periodic.runs_of(text)
    if len(text) < 5000:
        assert found == brute_runs(text)
    else:
        assert found == [(0, len(text), len(set(text)))]


def test_grammar_gives_the_text_back():
    for _ in range(100):
        numbers = np.array([_draw.randrange(4) for _ in range(_draw.randrange(2, 200))])
        first, rules, left = periodic.repaired(numbers)

        def spelled(s, first=first, rules=rules):
            if s < first:
                return [s]
            return spelled(rules[s - first][0]) + spelled(rules[s - first][1])

        assert [x for s in left.tolist() for x in spelled(s)] == numbers.tolist()
        pairs = Counter(zip(left.tolist(), left.tolist()[1:], strict=False))
        assert all(n == 1 for (a, b), n in pairs.items() if a != b)


def test_runs_of_rows(spark):
    block = [f"b{i}" for i in range(9)]
    texts = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, " ".join(block * 3)), (5, "\n".join(block * 2)),
             (6, " ".join(["a"] * 23)), (7, "\t".join(["a"] * 24)), (7, " ".join(["a"] * 24)),
             (8, " ".join(words(30_000) + block * 5)), (None, " ".join(block * 4 + ["c"] * 40))]
    found = periodic.detected(documents(spark, texts)).collect()
    want = Counter()
    for i, t in texts:
        text = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = brute_runs(text) if len(text) < 5000 else [(30_000, 45, 9)]
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        want[i, tuple(runs), " ".join(w for k, w in enumerate(text) if k not in dropped)] += 1
    assert Counter((r.doc_id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in found) == want
    assert periodic.digests(documents(spark, texts[:1]).limit(0)).count() == 0


def test_query_of_runs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r) for r in QUERIES["op13_repair_runs"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    some = 0
    for i, t in docs:
        text = re.findall("[^\x20\x09-\x0d]+", t or "")
        n, h = len(text), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = [text[k] if k < a else text[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(text)
        some += len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        dropped = {k for s, m, q in runs for k in range(s + q, s + m)}
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = " ".join(w for k, w in enumerate(text) if k not in dropped)
        want = (i, len(runs), *(best or (None, None, None)),
                1000 * best[1] // best[2] if best else None,
                *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))
        assert found[i] == want
    assert some > 5


# Whitening

VECTORS = "vec_id long, embedding array<double>, vector int, n string"


def brute_whitening(rows, components=16):
    """Numbers, distinct numbers, exact sums and the covariance's eigenvalues and vectors."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = [[int(np.floor(64 * c)) + 1000000 for c in v] + [1000000] * (width - len(v)) for _, v in good]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    cov = np.array([[float(Fraction(sum((n * r[a] - sums[a]) * (n * r[b] - sums[b]) for r in fit), n**3))
                     for b in range(width)] for a in range(width)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(r, sums, strict=True)) for r in x]
    y = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums, strict=True)] for r in x])
    with np.errstate(divide="ignore", invalid="ignore"):
        whitened = y @ vectors[:, order] / np.sqrt(values[order])
    return [i for i, _ in good], n, deviations, whitened, values[order] / values.sum()


def assert_whitened(found, rows, least=0):
    ids, n, deviations, whitened, explained = brute_whitening(rows)
    k = max((r.component for r in found), default=0)
    assert k >= least and len(found) == len(ids) * k and {r.n for r in found} <= {n}
    assert max((r.identity_error for r in found), default=0) < 1e-6
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, []).append(r)
    signs = None
    for i, d, w in sorted(zip(ids, deviations, whitened.tolist(), strict=True), key=lambda r: str(r[0])):
        rows_of = [r for r in by_row[i] if int(r.deviation) == d]
        got = {r.component: r for r in rows_of}
        assert sorted(got) == list(range(1, k + 1))
        values = np.array([got[c].whitened for c in range(1, k + 1)])
        if signs is None:
            signs = np.sign(values * w[:k])
        assert np.allclose(values * signs, w[:k], atol=1e-7)
        assert np.allclose([got[c].explained for c in range(1, k + 1)], explained[:k], rtol=1e-6)


def test_whitening_equals_brute_force(spark):
    draw = np.random.default_rng(3)
    scale = np.array([9.0, 5.0, 2.0, 1.0, 0.5])
    rows = [(i, (draw.normal(size=5) * scale + 3).tolist()) for i in range(150)]
    # One vector holds a third of all rows.
    rows += [(1000 + i, rows[0][1]) for i in range(75)]
    rows += [(300, None), (301, [1.0, None, 1.0, 1.0, 1.0]), (302, [float("nan")] * 5),
             (303, [float("-inf")] * 5), (304, [0.5, -7.25]), (305, [])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(4)
    assert_whitened(whitening.whitened(table).collect(), rows, 5)


def test_whitening_of_wide_numbers(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.normal(size=3) * [1e9, 1e8, 1e7]).tolist()) for i in range(40)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)
    found = whitening.whitened(table).collect()
    assert_whitened(found, rows, 3)
    assert max(r.deviation for r in found) > 1 << 63


def test_whitening_of_few_vectors(spark):
    def of(rows):
        return whitening.whitened(spark.createDataFrame(rows, VECTORS)).collect()

    assert of([]) == [] and of([(1, None, 1, "x")]) == [] and of([(1, [], 1, "x"), (2, [], 1, "x")]) == []
    assert of([(1, [1.0, 2.0], 1, "x"), (2, [1.0, 2.0], 1, "x")]) == []
    # Two vectors differ in one direction, the same for a row without an id.
    found = of([(1, [1.0, 2.0], 1, "x"), (None, [1.0, 2.5], 1, "x")])
    assert [(r.component, r.n, round(abs(r.whitened), 9), r.explained) for r in found] == [(1, 2, 1.0, 1.0)] * 2


def test_bit_planes_give_exact_products():
    draw = np.random.default_rng(5)
    for kind, high in (("<u1", 256), ("<u2", 1 << 16), ("<u8", 1 << 61)):
        numbers = draw.integers(0, high, (131, 3), np.uint64).astype(kind)
        batch = pa.RecordBatch.from_pydict({"vector": pa.array([r.tobytes() for r in numbers], pa.binary())})
        (counts,) = whitening._scattered(iter([batch.slice(1), batch.slice(0, 1)]), 3, kind)
        found = Counter()
        for r in counts.to_pylist():
            found[r["i"], r["j"]] += r["n"] << r["worth"]
        exact = [[int(c) for c in r] for r in numbers]
        assert found == {**{(i, j): sum(r[i] * r[j] for r in exact) for i in range(3) for j in range(i, 3)},
                         **{(i, -1): sum(r[i] for r in exact) for i in range(3)}}


def test_query_of_whitening(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select(
        "vec_id", "embedding").collect()]
    found = QUERIES["op11_bit_sliced_whitening"](spark, FOLDER)
    assert dict(found.dtypes)["deviation"] == "bigint"
    assert_whitened(found.collect(), rows, 16)


# Near copies


def brute_components(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(lower))
        n = min(5, len(w))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    top = list(range(len(texts)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            k = len(s & sets[j])
            if k and 100 * k >= 85 * (len(s) + len(sets[j]) - k):
                top[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(texts):
        ids.setdefault(root(i), []).append(d)
    least = {r: min((d for d in found if d is not None), default=None) for r, found in ids.items()}
    return Counter((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(texts))


def near_copies_of(base, count, edits):
    for _ in range(count):
        text = list(base)
        for _ in range(_draw.randrange(edits + 1)):
            text[_draw.randrange(len(text))] = f"v{_draw.randrange(10**6)}"
        yield text


def test_linked_equals_brute_force(spark):
    base = words(300)
    texts = [" ".join(t) for t in near_copies_of(base, 60, 6)]
    texts += [" ".join(t) for t in near_copies_of(words(80), 20, 3)]
    texts += [None, "", " \n\t", "one", "ONE", "one two three four", "One two three Four", "one two three four five",
              " ".join(words(20_000)), "É" * 9, "é" * 9, " ".join(base).upper(), " ".join(base)]
    rows = list(enumerate(texts)) + [(5, texts[9]), (5, texts[9]), (None, texts[0]), (None, "alone here"),
                                     (None, None)]
    found = bayes_dedup.linked(documents(spark, rows))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(tuple(r) for r in found.collect()) == brute_components(rows)
    assert bayes_dedup.linked(documents(spark, rows).limit(0)).count() == 0
    assert bayes_dedup.linked(documents(spark, [(1, None), (2, "")])).count() == 2


def test_groups_without_a_hub_are_found_whole(spark, monkeypatch):
    """Chains whose members are linked to the next ones only, in one large group, in small blocks."""
    monkeypatch.setattr(bayes_dedup, "PER_PART", 8)
    monkeypatch.setattr(bayes_dedup, "MOST_MEMBERS", 16)
    base, texts = words(200, 10**6), []
    for _ in range(4):
        text = list(base)
        for at in range(0, 120, 4):
            text[at : at + 4] = words(4, 10**6)
            texts.append(" ".join(text))
    # A third of all rows are copies of one text, and shorter copies of the base lie further off.
    texts += [" ".join(base)] * 60 + [" ".join(t) for t in near_copies_of(base, 30, 10)]
    order = list(range(len(texts)))
    _draw.shuffle(order)
    rows = list(zip(order, texts, strict=True))
    found = bayes_dedup.linked(documents(spark, rows)).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows)


def test_posterior_bounds():
    draw = np.random.default_rng(6)
    # Of pairs at the limit itself, next to none goes; of less similar ones, most go early.
    for share, least, most in ((0.85, 0.9995, 1), (0.95, 1, 1), (0.5, 0, 0.001), (0.7, 0, 0.03)):
        left = draw.integers(0, 1 << 16, (4000, bayes_dedup.LABELS), np.uint16)
        right = np.where(draw.random(left.shape) < share, left, left ^ 1)
        every = np.arange(4000), np.arange(4000)
        kept = len(bayes_dedup.survivors(left, right, every)[0]) / 4000
        assert least <= kept <= most
    assert all(a[1] < b[1] and b[1] <= b[0] for a, b in zip(bayes_dedup.BOUNDS, bayes_dedup.BOUNDS[1:], strict=False))
