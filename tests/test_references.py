import random
from collections import Counter

import pytest

from tidewright.sources.references import References
from tidewright.sources.zones import ZoneTable


def frame(spark, keys):
    return spark.createDataFrame([(k, "x") for k in keys], "k int, other string")


def keys_of(df):
    return sorted(r.k for r in df.collect())


def expected(parents, children):
    return (sorted(set(parents) - set(children) - {None}), sorted(set(children) - set(parents) - {None}))


@pytest.mark.parametrize("seed", range(2))
def test_counts_equal_a_full_check_after_random_changes(spark, folder, seed):
    rng = random.Random(seed)
    parents = [*range(12), None]
    children = [rng.choice([None, *range(15)]) for _ in range(25)]
    refs = References(spark, folder, "k")
    refs.start(frame(spark, parents), frame(spark, children))
    assert (keys_of(refs.childless()), keys_of(refs.orphaned())) == expected(parents, children)
    for number in range(1, 4):
        gone = [rng.sample(parents, 3), rng.sample(children, 8)]
        more = [[20 + number, 12 + number], [rng.randrange(24) for _ in range(4)]]
        for rows, out, new in zip((parents, children), gone, more, strict=True):
            for k in out:
                rows.remove(k)
            rows += new
        refs.apply(number, *[frame(spark, x) for x in (more[0], gone[0], more[1], gone[1])])
        assert (keys_of(refs.childless()), keys_of(refs.orphaned())) == expected(parents, children)
    counts = {r.k: (r.parents, r.children) for r in refs.counts().collect()}
    have, told = Counter(parents), Counter(children)
    assert {k: v for k, v in counts.items() if v != (0, 0)} == {
        k: (have[k], told[k]) for k in {*parents, *children} - {None}}


def test_a_change_applied_again_has_no_effect(spark, folder, monkeypatch):
    refs = References(spark, folder, "k")
    refs.start(frame(spark, [1, 2, 3]), frame(spark, [1, 1, 2]))
    none = frame(spark, [])
    change = (frame(spark, [4]), none, frame(spark, [3, 9]), frame(spark, [1, 2]))
    remove = ZoneTable.remove

    def broken(self, keys):
        raise OSError("lost")

    monkeypatch.setattr(ZoneTable, "remove", broken)
    with pytest.raises(OSError):
        refs.apply(1, *change)
    monkeypatch.setattr(ZoneTable, "remove", remove)
    for _ in range(2):
        refs.apply(1, *change)
        assert (keys_of(refs.childless()), keys_of(refs.orphaned())) == ([2, 4], [9])
    with pytest.raises(ValueError, match="after 1"):
        refs.apply(3, *change)
    with pytest.raises(Exception, match="more rows went"):
        refs.apply(2, none, none, none, frame(spark, [2]))


def test_a_check_reads_the_small_tables_only(spark, folder):
    refs = References(spark, folder, "k")
    refs.start(spark.range(5000).toDF("k"), spark.range(4990).toDF("k"))
    assert all("/childless/" in f for f in refs.childless().inputFiles())
    assert refs.childless().count() == 10 and refs.orphaned().count() == 0
