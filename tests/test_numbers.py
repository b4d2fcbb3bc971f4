import random

import pytest
from helpers import at

from tidewright.operators.builders import qualifier
from tidewright.sources.numbers import Numbering
from tidewright.sources.zones import ZoneTable

NAMES = ["first", "last"]
SCHEMA = "id int, first string, last string, ts timestamp_ntz"
THEN = at("2024-01-01")


def frame(spark, members):
    return spark.createDataFrame([(k, *name, THEN) for k, name in members.items()], SCHEMA)


def started(spark, folder, members, **options):
    numbers = Numbering(spark, folder, "id", NAMES, "ts", **options)
    numbers.start(qualifier(frame(spark, members), "id", NAMES, "ts"))
    return numbers


def shown(df):
    return {r.id: ((r.first, r.last), r.qualifier) for r in df.collect()}


class Model:
    """The same rules over plain dictionaries."""

    def __init__(self, members):
        self.names, self.numbers, self.highest = {}, {}, {}
        self.change(members, [])

    def change(self, members, gone):
        joining = {k: n for k, n in members.items() if self.names.get(k) != n}
        for k in [*joining, *gone]:
            self.names.pop(k, None)
        for k in sorted(joining):
            name = joining[k]
            self.highest[name] = self.numbers[k] = self.highest.get(name, 0) + 1
        self.names.update(joining)
        self.highest = {n: h for n, h in self.highest.items() if n in self.names.values()}

    def shown(self):
        names = list(self.names.values())
        return {k: (n, self.numbers[k] if names.count(n) > 1 else None) for k, n in self.names.items()}


@pytest.mark.parametrize(("seed", "min_rows"), [(0, None), (2, 1)])
def test_random_changes_follow_the_rules(spark, folder, seed, min_rows):
    rng = random.Random(seed)

    def name():
        return rng.choice([("A", "B"), ("A", None), (None, "A"), (None, None), ("1:", "A"), ("C", rng.choice("DEF"))])

    members = {k: name() for k in range(-3, 9)}
    model, numbers = Model(members), started(spark, folder, members, min_rows=min_rows)
    copy = shown(numbers.read())
    assert copy == model.shown()
    for _ in range(3):
        gone = rng.sample(sorted(model.names), 2) + [77]
        changed = {rng.randrange(-4, 16): name() for _ in range(5)}
        model.change(changed, [k for k in gone if k not in changed])
        numbers.apply(frame(spark, changed), frame(spark, dict.fromkeys(gone, ("x", "y"))))
        want = model.shown()
        assert shown(numbers.read()) == want
        # What is pending brings a copy up to date, and no two members of a name share a number.
        copy = {k: v for k, v in copy.items() if k not in gone} | shown(numbers.pending())
        assert copy == want
        told = [v for v in want.values() if v[1] is not None]
        assert len(told) == len(set(told))
        if rng.random() < 0.5:
            numbers.settled()
            assert numbers.pending().count() == 0


def test_members_with_growing_keys_equal_a_rebuild(spark, folder):
    rng = random.Random(5)
    members = {k: ("A", rng.choice("BCDE")) for k in range(8)}
    numbers = started(spark, folder, members)
    for first in (20, 30):
        more = {k: ("A", rng.choice("BCDEFG")) for k in range(first, first + 6)}
        members |= more
        numbers.apply(frame(spark, more))
    rebuilt = qualifier(frame(spark, members), "id", NAMES, "ts")
    assert shown(numbers.read()) == shown(rebuilt)


@pytest.mark.parametrize(("broken", "at_call"), [("upsert", 2), ("remove", 1), ("upsert", 4)])
def test_a_change_cut_short_is_finished_by_the_next(spark, folder, monkeypatch, broken, at_call):
    numbers = started(spark, folder, {1: ("A", "B"), 2: ("C", "D"), 3: ("C", "D")})
    work, calls = getattr(ZoneTable, broken), []

    def fails(self, *args, **kwargs):
        calls.append(self)
        if len(calls) == at_call:
            raise OSError("lost")
        return work(self, *args, **kwargs)

    monkeypatch.setattr(ZoneTable, broken, fails)
    change = frame(spark, {4: ("A", "B"), 2: ("E", "F")}), frame(spark, {9: ("x", "y")})
    with pytest.raises(OSError):
        numbers.apply(*change)
    monkeypatch.setattr(ZoneTable, broken, work)
    want = {1: (("A", "B"), 1), 4: (("A", "B"), 2), 2: (("E", "F"), None), 3: (("C", "D"), None)}
    for _ in range(2):
        numbers.apply(*change)
        assert shown(numbers.read()) == want == shown(numbers.pending())


def test_what_is_refused(spark, folder):
    numbers = started(spark, folder, {1: ("A", "B")})
    twice = frame(spark, {2: ("A", "B")}).union(frame(spark, {2: ("C", "D")}))
    with pytest.raises(Exception, match="changed members"):
        numbers.apply(twice)
    assert shown(numbers.read()) == {1: (("A", "B"), None)}
    same = qualifier(frame(spark, {1: ("A", "B")}), "id", NAMES, "ts")
    with pytest.raises(Exception, match="members"):
        Numbering(spark, f"{folder}/b", "id", NAMES, "ts").start(
            same.union(qualifier(frame(spark, {2: ("A", "B")}), "id", NAMES, "ts")))
    with pytest.raises(ValueError, match="whole number"):
        Numbering(spark, f"{folder}/c", "id", NAMES, "ts").start(
            same.withColumn("id", same["id"].cast("string")))


def test_empty_tables(spark, folder):
    numbers = started(spark, folder, {})
    numbers.apply(frame(spark, {}))
    assert numbers.started() and shown(numbers.read()) == {}
    numbers.apply(frame(spark, {1: (None, "B"), 5: (None, "B")}))
    assert shown(numbers.read()) == {1: ((None, "B"), 1), 5: ((None, "B"), 2)}
