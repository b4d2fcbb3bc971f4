"""Each operator against a brute-force version, on rows with every awkward case."""

import glob
import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewright.llm import (
    feistel,
    lsh_forest,
    mixing,
    pii,
    quality_forest,
    roles,
    token_files,
    top_k,
    transducer,
    warc,
)
from tidewright.llm.queries import tokenizer_file
from tidewright.llm.shared import ship_package

# The columns of documents, and one named like the operators' own.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_links int"
_draw = random.Random(5)
_WORDS = ["stone", "river", "The", "Öl", "été", "it's", "x1", "don't.", "a", "moor,", "—"]


def words(n):
    return " ".join(_draw.choice(_WORDS) + str(_draw.randint(0, 9) or "") for _ in range(n))


LONG = words(20_000)
BASE = words(80).split()
TEXTS = [
    None, "", " \n\t", "one", words(4), LONG, "same text of five words", "same text of five words",
    " ".join(BASE), " ".join(BASE[:-1]), " ".join(BASE[:-1] + ["other"]), "mail a.b@c.de, +1 (617) 555-0101!",
    "card 4111 1111 1111 1111 and 4111111111111112 ip 10.0.0.255 10.0.0.256", "x@y.z" * 5,
    "ΣΑΣ <|endoftext|>İ. ǰJ̌ 한국 ²", "aaaa" * 200, "line\nline\nline\n" * 20, "### $$$ " * 60,
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["a", "b", None][i % 3], 0, "x", 1) for i, t in enumerate(TEXTS)]
    # A repeated row, and rows without an id.
    rows += [rows[6], (None, "no id here", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def test_token_files(spark, docs, empty, folder, library):
    token_files.write_tokens(docs, f"{folder}/t", tokenizer_file())
    found = token_files.with_checksums(token_files.read_tokens(spark, f"{folder}/t")).collect()
    start, want = 0, Counter()
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        if r.doc_id is not None and r.doc_id != 6:
            want[r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert Counter(tuple(r) for r in found if r.doc_id is not None and r.doc_id != 6) == want
    assert sorted(r.start for r in found)[0] == 0 and max(r.start + r.n_tokens for r in found) == start
    some = token_files.read_tokens(spark, f"{folder}/t", 3, 5).collect()
    assert {r.doc_id for r in some} == {3, 4, 5}
    assert "ids" not in token_files.read_metadata(spark, f"{folder}/t").columns
    token_files.write_tokens(empty, f"{folder}/e", tokenizer_file())
    assert token_files.read_tokens(spark, f"{folder}/e").count() == 0


def test_token_file_layout(spark, folder):
    many = spark.range(3000).selectExpr("id as doc_id", "concat('stone river ', id) as text").coalesce(1)
    token_files.write_tokens(many, f"{folder}/t", tokenizer_file())
    column = pq.ParquetDataset(f"{folder}/t").fragments[0].metadata.row_group(0).column
    parts = {column(i).path_in_schema: column(i) for i in range(5)}
    assert "DELTA_BINARY_PACKED" in parts["doc_id"].encodings and parts["doc_id"].has_column_index
    assert any("DICTIONARY" in e for e in parts["ids.list.element"].encodings)


def _statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")) if w else 0,
            len(lines) - len(set(lines)), len(covered))


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i != 17)) for i in (5, 8, 9, 10, 17)] + [(None, 1), (3, None)],
                                   "doc_id long, quality int")
    forest = quality_forest.fit(docs, labels)
    found = quality_forest.verdicts(docs, forest).collect()
    by_text = defaultdict(set)
    for r in found:
        by_text[r.doc_id].add(tuple(r)[1:6])
    for i, t in enumerate(TEXTS):
        assert by_text[i] == {_statistics(t)}, i
    kept = {r.doc_id for r in found if r.kept}
    assert {5, 8, 9, 10} <= kept and 17 not in kept and 0 not in kept
    whole = quality_forest.keep_good(docs, forest)
    assert whole.columns == docs.columns and {r.doc_id for r in whole.collect()} == kept
    assert quality_forest.fit(docs, labels.limit(0)) is None
    assert quality_forest.verdicts(empty, None).count() == 0


def _labelled_ratios(n, bad, seed=1):
    draw = np.random.default_rng(seed)
    rows = np.abs(draw.normal(size=(n, 8))) * 0.01
    good = np.arange(n) >= bad
    rows[:bad, 0] = draw.uniform(1, 3, bad)
    rows[: bad // 2, [0, 1]] = rows[: bad // 2, [1, 0]]
    return rows, good


def test_forest_isolates_what_is_rare():
    rows, good = _labelled_ratios(600, 30)
    scores = quality_forest.grow(rows, good).scores(rows)
    threshold = quality_forest.calibrated(scores, good)
    assert (scores > threshold).tolist() == (~good).tolist()


def test_scores_are_mean_path_lengths():
    rows, good = _labelled_ratios(300, 20)
    forest = quality_forest.grow(rows, good, trees=30, rows=64)
    for row, score in zip(rows, forest.scores(rows), strict=True):
        total = 0.0
        for feature, cut, child, path in zip(forest.feature, forest.cut, forest.child, forest.path, strict=True):
            at = 0
            while feature[at] >= 0:
                at = child[at] + int(row[feature[at]] >= cut[at])
            total += path[at]
        assert abs(score - 2 ** (-total / 30 / forest.norm)) < 1e-12
    # A leaf's path is its depth, and what a tree of its rows would add.
    one = quality_forest.grow(rows, good, trees=1, rows=64)
    depth = {0: 0}
    for node in range(len(one.feature[0])):
        if node in depth and one.feature[0][node] >= 0:
            depth[int(one.child[0][node])] = depth[int(one.child[0][node]) + 1] = depth[node] + 1
    leaves = [n for n in depth if one.feature[0][n] < 0]
    assert max(depth.values()) <= 6 and len(leaves) > 4
    assert all(depth[n] <= one.path[0][n] <= depth[n] + 2 * np.log(64) for n in leaves)


def test_the_forest_decides_not_the_ranges():
    rows, good = _labelled_ratios(4_000, 300)
    forest = quality_forest.grow(rows, good)
    threshold = quality_forest.calibrated(forest.scores(rows), good)
    top = rows[good].max(axis=0)
    several = np.zeros(8)
    several[:2] = top[:2] * 0.99
    beyond = np.zeros(8)
    beyond[5] = top[5] * 1.05
    inside, outside = forest.scores(np.array([several, beyond]))
    # Unusual in two ratios, but within the range of each: rejected. Barely beyond one: kept.
    assert inside > outside and outside <= threshold
    rare = rows.copy()
    rare[:150, :2] = top[:2] * 0.9
    forest = quality_forest.grow(rare, good)
    threshold = quality_forest.calibrated(forest.scores(rare), good)
    assert forest.scores(several[None])[0] > threshold >= forest.scores(beyond[None])[0]


def test_mislabelled_rows_leave_a_rule_on():
    rows, good = _labelled_ratios(4_300, 300, 2)
    rows[[900, 1900], 0] = 3.0, 2.5
    scores = quality_forest.grow(rows, good).scores(rows)
    rejected = scores > quality_forest.calibrated(scores, good)
    assert rejected[:300].mean() > 0.95 and set(np.flatnonzero(rejected[300:]) + 300) <= {900, 1900}


def test_quality_of_held_out_rows(spark):
    """Labelled rows that take no part in the fit: nearly all bad ones go, nearly all good ones stay."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    shown = labels.where("xxhash64(doc_id) % 2 = 0")
    found = quality_forest.verdicts(docs, quality_forest.fit(docs, shown)).join(
        labels.where("quality is not null and xxhash64(doc_id) % 2 <> 0"), "doc_id").where("not base_failed")
    bad, good = found.where("quality = 0"), found.where("quality = 1")
    assert bad.where("not kept").count() >= 0.9 * bad.count() > 0
    assert good.where("kept").count() >= 0.99 * good.count()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation(spark, n):
    walk = feistel.walk_length(spark, n, 3)
    rows = spark.range(n).select(feistel.place(F.col("id"), n, walk, 3).alias("p"))
    assert sorted(r.p for r in rows.collect()) == list(range(n))


def _plain_rounds(x, n, seed):
    """One application of the rounds, in plain Python."""
    a, b = feistel.sides(n)
    left, right = divmod(x, b)
    for i, key in enumerate(feistel.keyed(seed)):
        mixed = (right * feistel.MULTIPLIER + key) % feistel.PRIME
        left, right = right, (left + mixed * mixed % feistel.PRIME) % (b if i % 2 else a)
    return left * b + right


def test_walks_from_inside_end_for_all_small_tables():
    endless = set()
    for seed in (0, 3):
        for n in range(1001):
            a, b = feistel.sides(n)
            outside, steps = set(range(n, a * b)), 1
            while outside:
                still = {y for x in outside if (y := _plain_rounds(x, n, seed)) >= n}
                if len(still) == len(outside):
                    endless.add(n)
                    break
                outside, steps = still, steps + 1
            # The same rule on numbers from inside: after so many steps all are back inside.
            at = list(range(n))
            for step in range(steps):
                at = [x if step and x < n else _plain_rounds(x, n, seed) for x in at]
            assert sorted(at) == list(range(n)), n
    assert len(endless) > 10


@pytest.mark.parametrize(("n", "seed"), [(0, 0), (37, 0), (50, 0), (104, 0), (307, 0), (64, 5)])
def test_walk_length_ends_where_a_cycle_stays_outside(spark, n, seed):
    walk = feistel.walk_length(spark, n, seed)
    rows = spark.range(n).select(
        "id", feistel.permuted(F.col("id"), n, seed).alias("one"),
        feistel.place(F.col("id"), n, walk, seed).alias("p")).collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.one == _plain_rounds(r.id, n, seed) for r in rows)


def test_shards(docs, empty):
    order = [F.col("doc_id"), F.col("__text")]
    found = feistel.sharded(feistel.measured(docs), order, 4).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = feistel.sharded(feistel.measured(docs.repartition(7)), order, 4).collect()
    assert Counter(found) == Counter(again)
    assert feistel.sharded(feistel.measured(empty), order, 4).count() == 0


def test_periods_are_fair():
    weights = {"a": 5, "b": 3, "c": 1, "d": 2}
    slots, total = mixing.period(weights), sum(weights.values())
    done = Counter()
    for t, s in enumerate(slots, 1):
        i = done[s]
        assert i * total // weights[s] <= t - 1 < -(-(i + 1) * total // weights[s])
        done[s] += 1
        assert all(abs(done[x] - t * w / total) < 1 for x, w in weights.items())
    assert done == weights


def test_mixing(spark, docs, empty):
    rows = spark.range(500).selectExpr(
        "id as doc_id", "case when id < 300 then 'a' when id < 420 then 'b' when id < 480 then 'c' end as source")
    weights = {"a": 2, "b": 3, "c": 1}
    found = mixing.scheduled(rows, [F.col("doc_id")], weights, 2, block_rows=7).orderBy("position").collect()
    assert [r.position for r in found] == list(range(500)) and {r.doc_id for r in found} == set(range(500))
    for r in found:
        assert r.release <= r.slot < r.deadline
    sizes = {"a": 300, "b": 120, "c": 60, "other": 20}
    plan = mixing.phases({**weights, "other": 2}, {s: -(-n // 7) for s, n in sizes.items()})
    slot, done, order = 0, Counter(), []
    for p in plan:
        shares = p["weights"]
        slots = mixing.period(shares)
        for i in range(sum(p["ran"].values())):
            s = slots[i % len(slots)]
            order.append((s, done[s]))
            done[s] += 1
    seen = list(dict.fromkeys((r.mix_group, r.block) for r in found))
    assert seen == order and slot == 0
    whole = mixing.mixed(docs, {"a": 2}, 1)
    assert whole.columns == docs.columns and Counter(whole.collect()) == Counter(docs.collect())
    assert mixing.mixed(empty, {"a": 2}, 1).count() == 0
    with pytest.raises(ValueError):
        mixing.checked({"a": 0}, 1)


def test_mixing_schedules_every_source(spark):
    # x is not listed and holds a third of all rows; a source is called like the default.
    sizes = {"a": 150, "x": 200, "y": 100, "other": 90, None: 60}
    names = [s for s, n in sizes.items() for _ in range(n)]
    rows = spark.createDataFrame(list(enumerate(names)), "doc_id long, source string")
    group = {**{s: s for s in sizes}, None: "(other)"}
    for shared, weights in (False, [4, 2, 2, 2, 2]), (True, [8, 1, 1, 1, 1]):
        share = dict(zip(group.values(), weights, strict=True))
        assert mixing.weights_of(list(share), {"a": 4}, 2, shared) == share
        found = mixing.scheduled(rows, [F.col("doc_id")], {"a": 4}, 2, 7, shared).orderBy("position").collect()
        assert [r.position for r in found] == list(range(600)) and len({r.doc_id for r in found}) == 600
        assert all(r.mix_group == group[r.source] and r.release <= r.slot < r.deadline for r in found)
        blocks = list(dict.fromkeys((r.slot, r.mix_group, r.phase) for r in found))
        assert [s for s, _, _ in blocks] == list(range(len(blocks)))
        done, total = Counter(), sum(share.values())
        for t, g in enumerate((g for _, g, phase in blocks if phase == 0), 1):
            done[g] += 1
            assert all(abs(done[s] - t * w / total) < 1 for s, w in share.items())


def test_mixing_of_many_sources(spark):
    rows = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 1500) as source")
    found = mixing.scheduled(rows, [F.col("doc_id")], {"s0": 9}, 10, 2).orderBy("position").collect()
    assert [r.position for r in found] == list(range(6000)) and len({r.doc_id for r in found}) == 6000
    assert all(r.release <= r.slot < r.deadline for r in found) and len({r.mix_group for r in found}) == 1500


def _grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _links(rows):
    sets = [_grams(r.text) for r in rows]
    links, top = Counter(), list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            top[root(j)] = root(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i].doc_id)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i].doc_id, least[root(i)], links[i]) for i in range(len(rows)))


def test_near_copies(spark, docs, empty, monkeypatch):
    noisy = [" ".join(w if _draw.random() > 0.02 else "z" for w in BASE) for _ in range(40)]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(noisy)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(more)
    found = Counter((r.doc_id, r.class_id, r.n_links) for r in lsh_forest.near_copies(rows).collect())
    assert found == _links(rows.collect())
    # Small blocks: a group is compared cell by cell.
    monkeypatch.setattr(lsh_forest, "BLOCK_BYTES", 3 * lsh_forest.TEXT_BYTES)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in lsh_forest.near_copies(rows).collect()) == found
    kept = lsh_forest.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[6] == 1 and not ids[7] and ids[8] == 1 and not ids[9] and ids[None] == 2
    assert lsh_forest.near_copies(empty).count() == 0 and lsh_forest.one_of_each(empty).count() == 0


def test_repeats_without_a_word_stay(spark):
    # Rows equal in doc_id and text, once with words and once without.
    texts = [words(40), words(40), None, None, "  ", "  ", words(30)]
    rows = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = rows.union(rows.where("doc_id = 3"))
    found = Counter(r.text for r in lsh_forest.one_of_each(rows).collect())
    assert found == Counter({t: 1 for t in texts if t and t != "  "}) + Counter({None: 2, "  ": 2})


def test_columns_with_the_operators_names_stay(spark):
    text = words(40)
    rows = spark.createDataFrame([(i, text, 5, 6, 7) for i in range(3)],
                                 "doc_id int, text string, text_hash int, row_text int, row_id int")
    kept = lsh_forest.one_of_each(rows)
    assert kept.schema == rows.schema and [tuple(r) for r in kept.collect()] == [(0, text, 5, 6, 7)]


def test_components(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    found = {r.node: r.root for r in lsh_forest.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {}
    for a, b in edges * 60:
        low = min(top.get(a, a), top.get(b, b))
        top[a] = top[b] = low
    assert found == {n: t for n, t in top.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_bpe(docs, empty, library):
    rows = {(r.doc_id, r.text) for r in docs.collect()}
    want = Counter()
    for doc_id, text in ((r.doc_id, r.text) for r in docs.collect()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert rows and Counter(map(tuple, transducer.digests(docs, tokenizer_file()).collect())) == want
    for r in transducer.encoded(docs.where("doc_id = 14"), tokenizer_file()).collect():
        assert r.ids == library.encode(TEXTS[14], add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert transducer.digests(empty, tokenizer_file()).count() == 0


def test_bpe_of_random_texts(library):
    with open(tokenizer_file(), encoding="utf-8") as f:
        rules = transducer.Rules(f.read())
    coder = transducer.Encoder(rules, transducer.Lexicon.compiled({"the": rules.merged(["the"])[0]}))
    signs = list("abAB'sStTlL .,!<|>\n\t\x1c\x85\xa0é́̌ßİΣςjJ漢あ한ᄀ가😀12²_-") + ["<|endoftext|>", "'re", "the"]
    texts = ["".join(_draw.choice(signs) for _ in range(_draw.randint(0, 30))) for _ in range(3000)]
    texts.append("ab" * 3000)
    for text, ids in zip(texts, coder.ids(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_lexicon_is_minimal(tmp_path):
    given = {w + s: [i, len(s)] for i, w in enumerate(["walk", "talk", "stalk"]) for s in ["", "s", "ed", "ing"]}
    lexicon = transducer.Lexicon.compiled(given)
    (tmp_path / "lexicon").write_bytes(lexicon.to_bytes())
    mapped = transducer.Lexicon.mapped(str(tmp_path / "lexicon"))
    assert [mapped.ids_of(n) for n in mapped.look_up(list(given)).tolist()] == list(given.values())
    assert mapped.look_up(["", "wal", "walke", "walkss", "x"]).tolist() == [-1] * 5
    # One tail for all three stems: root, s, t, a, l, k, and the endings' i, n, e, and the end.
    assert mapped.states <= 12


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i}\r\nb", h, 1) for i, h in enumerate(
        [None, "", "<p>a</p>", "<p>a</p>", "WARC/1.1\r\nWARC-Type: response\r\n\r\nfake", "é" * 50_000, "<p>a</p>"])]
    return spark.createDataFrame([*rows, (None, None, "<p>a</p>", 1)],
                                 "page_id long, url string, html string, length int").repartition(2)


@pytest.mark.parametrize("compressed", [False, True])
def test_warc(spark, pages, folder, compressed):
    warc.write_archives(pages, f"{folder}/w", compressed=compressed)
    archives = warc.read_archives(spark, f"{folder}/w", compressed)
    assert warc.gaps(archives).count() == 0
    found = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
             for r in warc.records(archives).collect()}
    html = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    largest = {h: max(i for i, x in html if x == h and i is not None) for _, h in html}
    assert found == {(i, len(h), warc.sha1_base32(h), "response" if i == largest[h] else "revisit",
                      None if i == largest[h] else largest[h]) for i, h in html}
    warc.write_archives(pages.limit(0), f"{folder}/e", compressed=compressed)
    assert warc.read_archives(spark, f"{folder}/e", compressed).count() == 0


@pytest.mark.parametrize("compressed", [False, True])
def test_salvage(compressed):
    made = [warc.record(i, None, b"payload %d" % i * 50, warc.sha1_base32(b"payload %d" % i * 50), 450, None, False)
            + b"\r\n" for i in range(6)]
    members = [warc._member(m) for m in made] if compressed else made
    mark = warc.MEMBER if compressed else warc.VERSION
    damaged = bytearray(members[2])
    damaged[len(damaged) // 2] ^= 0x55
    data = b"junk" + members[0] + members[1][:-30] + bytes(damaged) + members[3] + members[4] + members[5][:40]
    pieces = data.split(mark)
    items = list(warc.Salvage(iter(pieces), mark, len(data)))
    pages = [int(x.headers["warc-record-id"][10:-1]) for x in items if isinstance(x, warc.Record)]
    assert pages == [0, 3, 4]
    gaps = [(x.offset, x.length) for x in items if isinstance(x, warc.Gap)]
    assert gaps[0] == (0, 4) and sum(n for _, n in gaps) + sum(len(members[i]) for i in pages) == len(data)


def test_archives_of_any_version_and_bounded_bytes(spark, folder, monkeypatch):
    rows = [(i, f"u{i}", f"WARC/1.1 and WARC/1.9\r\npage {i} " * 3) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 12_000)
    warc.write_archives(pages, f"{folder}/new")
    assert len(list(glob.glob(f"{folder}/new/part-*"))) >= 5
    found = warc.read_archives(spark, f"{folder}/new")
    assert warc.gaps(found).count() == 0 and {r.page_id for r in found.collect()} == set(range(60))
    # The same records as another writer's older version, one of an unknown version between them.
    whole = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{folder}/new/part-*")))
    parts = whole.split(b"WARC/1.1\r\nWARC-Type")
    told = [b"1.0", b"1.1", b"1.0", b"1.7"]
    os.makedirs(f"{folder}/old")
    with open(f"{folder}/old/a.warc", "wb") as f:
        f.write(b"".join(b"WARC/" + told[i % 4] + b"\r\nWARC-Type" + p for i, p in enumerate(parts[1:])))
    found = warc.read_archives(spark, f"{folder}/old")
    kept = {r.page_id for r in warc.records(found).collect()}
    assert len(kept) == 45 and {r.reason for r in warc.gaps(found).collect()} >= {"no version of a record"}


def test_top_k(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=5).astype(float).tolist(), 0) for i in range(300)]
    rows[7] = (7, rows[200][1], 0)
    rows += [(300, None, 0), (301, [1.0, None, 1.0, 1.0, 1.0], 0), (302, [float("nan")] * 5, 0),
             (303, [float("inf")] * 5, 0), (None, [1.0] * 5, 0), (304, [0.5], 0), (5, rows[5][1], 0),
             (5, [4.0] * 5, 0), (100, [-1.0, 2.0, 3.0, 0.0, 1.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumn(
        "row", F.lit(0))
    whole = []
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole.append((i, np.pad(np.floor(np.array(v) * 1024).astype(int), (0, 5 - len(v)))))

    def brute(k):
        want = Counter()
        for at, (q, w) in enumerate(whole):
            if q % 100 == 0:
                best = sorted((-int(w @ v), i) for j, (i, v) in enumerate(whole) if j != at)[:k]
                want.update((q, r, i, -s) for r, (s, i) in enumerate(best, 1))
        return want

    is_query = F.col("vec_id") % 100 == 0
    assert Counter(tuple(r) for r in top_k.nearest(table, is_query).collect()) == brute(10)
    for name, small in (("LEAST_ROWS", 16), ("QUERY_ROWS", 2), ("SCORE_CELLS", 32)):
        monkeypatch.setattr(top_k, name, small)
    monkeypatch.setattr(top_k, "SHARE", 10**6)
    for runs in (1, 2, 3):
        found = top_k.nearest(table, is_query, 3, runs).collect()
        assert Counter(tuple(r) for r in found) == brute(3)
    assert {r.rank for r in top_k.nearest(table, is_query, 500).where("query_id = 0").collect()} == set(
        range(1, len(whole)))
    assert top_k.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert top_k.nearest(table.where("vec_id in (0, 1)"), F.col("vec_id") == 0).count() == 1


def _cheapest(given, costs):
    """Least cost over all paths, tried one by one."""
    best = min(((c + roles.ending(s, costs)[0]) for c, s in _paths(given, costs)), default=0)
    return best


def _paths(given, costs):
    paths = [(0, roles.START)]
    for role in given:
        paths = [(c + m[0], m[1]) for c, s in paths for m in roles.moves(s, role, costs)]
    return paths


def test_roles(spark):
    names = ["user", "assistant", "system", "tool", None, " USER "]
    rows = [(c, t, _draw.choice(names), _draw.choice(["hi", None, "", "x\ny"]), "c") for c in range(30)
            for t in range(_draw.randint(1, 7))] + [(None, None, None, None, None), (1, 0, "user", "again", "c")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string")
    costs = roles.Costs()
    for chunk in (4096, 2):
        found = defaultdict(list)
        for r in roles.repair(table, costs, chunk).orderBy("conv_id", "seq").collect():
            found[r.conv_id].append(r)
        assert sum(map(len, found.values())) == len(rows)
        for turns in found.values():
            given = [roles.role_number(r.role) for r in turns]
            assert sum(r.cost for r in turns) == _cheapest(given, costs)
            text = "".join(r.piece for r in turns)
            shown = re.findall(r"<\|(system|user|assistant)\|>\n", text)
            assert text.count(roles.END) == len(shown) and shown[-1] == "assistant"
            body = shown[1:] if shown[0] == "system" else shown
            assert body == ["user", "assistant"] * (len(body) // 2)
    assert roles.repair(table.limit(0)).count() == 0


def _spans(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()][::-1]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_pii(spark, docs, empty):
    signs = list("ab.@+-() 0123456789😀é") + ["10.2.3.4", "a@b.c", "+1 (617) 555-0101", "4111 1111 1111 1111"]
    texts = ["".join(_draw.choice(signs) for _ in range(_draw.randint(0, 40))) for _ in range(400)]
    texts.append("a@b" + ".c" * 20_000)
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(more)
    model = pii.fit(rows)
    text_of = {r.doc_id: r.text for r in rows.collect() if r.doc_id is not None}
    for r in pii.report(rows, model).collect():
        if r.doc_id is None:
            continue
        base = _spans(text_of[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        assert r.n_email == base.count("email") and r.n_ip == base.count("ip:")
    clean = pii.redacted(docs, model)
    assert clean.columns == docs.columns
    shown = {r.doc_id: r.text for r in clean.collect() if r.doc_id is not None}
    assert shown[11] == "mail <EMAIL>, <PHONE>!" and shown[0] is None and shown[5] == LONG
    nothing = pii.fit(empty)
    assert pii.report(empty, nothing).count() == 0 and "1" not in nothing.verdicts()


def test_pii_without_base_pattern(spark):
    private = {
        "email": ["jo.doe (at) host (dot) com", "jo at host dot com", "jo[at]mail[dot]host[dot]org", "jo @ host.net"],
        "phone": ["(617) 555-0101", "617-555-0102", "617.555.0103 20", "06 12 34 56 78"],
        "card": ["4111.1111.1111.1111", "5500/0000/0000/0004 12/27"], "ip": ["10 . 20 . 30 . 40", "192. 168. 10. 25"],
    }
    harmless = [
        "token 681c0945612378e8b7", "order 617-555-0199", "order number 6175550199", "at 2024-01-17 10.22 all",
        "lists 1. 2. 3. 4 of", "card 4111.1111.1111.1112", "version 1 . 2 . 3 . 4", "look at the dot matrix",
        "found 10 . 20 . 300 . 4", "read more at example.com now", "order 123-4567890-1234567",
    ]
    texts = [f"la {i} {t} ri" for i in range(40) for t in harmless]
    texts += ["jo@host.com and +1 (617) 555-0101, 4111 1111 1111 1111, 10.2.3.4"] * 3
    kept = len(texts)
    planted = [(k, t) for k, ts in private.items() for t in ts]
    planted += [("phone", "6175550101"), ("email", "jo at host.com")]
    hints = {"6175550101": "call ", "jo at host.com": "write to "}
    texts += [f"so {hints.get(t, '')}{t} on" for _, t in planted]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.redacted(rows, pii.fit(rows)).collect()}
    assert [clean[i] for i in range(kept - 3)] == texts[: kept - 3]
    rest = {"617.555.0103 20": " 20", "5500/0000/0000/0004 12/27": " 12/27"}
    for i, (kind, t) in enumerate(planted, kept):
        assert clean[i] == f"so {hints.get(t, '')}<{kind.upper()}>{rest.get(t, '')} on"


def test_boosting_separates_cells():
    cells = [(c, 50, 0) if pii.classes_of(c)[6] else (c, 0, 50) for c in range(0, pii.CELLS, 37)]
    prior, trees = pii.boosted(cells)
    model = pii.Model(prior, trees, (0.5,) * 4)
    assert all((model.probability(c) > 0.5) == (g > 0) for c, g, _ in cells)
