"""Minimum-cost repair of chat roles, and rendering of the repaired turns.

Legal conversations are those an automaton accepts: at most one system turn, at the beginning,
then user and assistant turns in alternation, with an assistant turn last. Dynamic programming
over its states chooses, turn by turn, whether to keep a turn, merge it into the turn before,
relabel it, or insert an empty turn ahead of it, at the least total cost.

A conversation of any length is worked on in chunks of its turns. A chunk is a matrix of least
costs from each state to each state; the matrices of a conversation are combined in order, which
tells every chunk the states it begins and ends in, and each chunk then repairs its own turns.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import number_rows, stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
STATES = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# Turns of a chunk.
CHUNK_TURNS = 4096
FAR = 1 << 60

HEADER, END = "<|{}|>\n", "<|end|>\n"


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    insert: int = 3


def moves(state: int, role: int, costs: Costs) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """What can become of a turn with this role (0: none known) after `state`.

    Each move is (cost, new state, action, roles of the empty turns inserted ahead); of moves
    that cost the same the first one is taken.
    """
    found = []
    if role in NEXT[state]:
        found.append((0, role, "keep", ()))
    if state != START:
        changed = 0 if role == state else costs.relabel
        found.append((costs.merge + changed, state, "merge", ()))
    for after in NEXT[state]:
        if after != role:
            found.append((costs.relabel, after, "relabel", ()))
    for between in NEXT[state]:
        if role in NEXT[between]:
            found.append((costs.insert, role, "insert", (between,)))
    return found


def ending(state: int, costs: Costs) -> tuple[int, tuple[int, ...]]:
    """Cost and roles of the empty turns that close a conversation with an assistant turn."""
    missing = {ASSISTANT: (), USER: (ASSISTANT,)}.get(state, (USER, ASSISTANT))
    return costs.insert * len(missing), missing


def role_number(role: str | None) -> int:
    """Roles are told without regard to case and surrounding blanks; others count as unknown."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else 0


def least_costs(roles: list[int], costs: Costs) -> list[list[int]]:
    """For each state before the turns, the least cost of each state after them."""
    table = [[0 if a == b else FAR for b in STATES] for a in STATES]
    steps = {(s, r): moves(s, r, costs) for s in STATES for r in STATES}
    for role in roles:
        for first in STATES:
            new = [FAR] * 4
            for state in STATES:
                have = table[first][state]
                if have < FAR:
                    for cost, to, _, _ in steps[state, role]:
                        new[to] = min(new[to], have + cost)
            table[first] = new
    return table


def repaired(roles: list[int], first: int, last: int, costs: Costs):
    """The moves of a least-cost path from state `first` to state `last`, one per turn.

    Going back from the end, the lowest state before and then the first move wins a tie.
    """
    steps = {(s, r): moves(s, r, costs) for s in STATES for r in STATES}
    have = [0 if s == first else FAR for s in STATES]
    back = []
    for role in roles:
        new, via = [FAR] * 4, [None] * 4
        for state in STATES:
            if have[state] < FAR:
                for move in steps[state, role]:
                    if have[state] + move[0] < new[move[1]]:
                        new[move[1]], via[move[1]] = have[state] + move[0], (state, move)
        back.append(via)
        have = new
    path, state = [], last
    for via in reversed(back):
        state, move = via[state]
        path.append((state, move))
    return path[::-1]


def _sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]):
    """Consecutive rows with equal keys, over batches."""
    rows = (r for b in batches for r in b.to_pylist())
    return groupby(rows, key=itemgetter(*keys))


def repair(turns: DataFrame, costs: Costs | None = None, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """One row per turn in its repaired form, with the piece of the rendered text it contributes.

    Turns are ordered by turn number (NULL first), then role and text. Returned are conv_id, seq
    (the turn's place, from 0), turn, role, new_role, action (keep, merge, relabel, insert), inserted
    (roles of empty turns ahead, joined by a comma), cost, closing (roles of empty turns added at
    the end) and piece. The pieces of a conversation, joined by seq, are its rendered text, so a
    conversation of any size needs no single row. A NULL text is empty, a NULL conv_id is a
    conversation of its own.
    """
    costs = costs or Costs()
    rows = turns.select(
        F.struct(F.col("conv_id").cast("long").alias("id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        "role", F.coalesce("text", F.lit("")).alias("text"),
    )
    order = [F.col("turn"), F.col("role"), F.xxhash64("text")]
    placed = number_rows(rows, order, "seq", "conv", "turns").withColumn(
        "chunk", F.floor(F.col("seq") / chunk_turns).cast("long"))
    dealt = stored(placed.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "seq"), "turns")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for (conv, chunk), group in _sorted_groups(batches, ["id", "chunk"]):
            table = least_costs([role_number(r["role"]) for r in group], costs)
            made.append({"id": conv, "chunk": chunk, "cost": [c for row in table for c in row]})
            if len(made) == 1000:
                yield pa.RecordBatch.from_pylist(made, _TABLES)
                made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, _TABLES)

    # The frame is written again only as narrow rows; sorting by chunk keeps each chunk whole.
    narrow = dealt.select(F.col("conv.id").alias("id"), "chunk", "seq", "role")
    ordered = narrow.repartition("id", "chunk").sortWithinPartitions("id", "chunk", "seq")
    tables = ordered.mapInArrow(measure, "id long, chunk long, cost array<long>")
    # One row per chunk; a conversation's rows, one per `chunk_turns` turns, meet in one task.
    by_conv = tables.repartition("id").sortWithinPartitions("id", "chunk")
    ways = by_conv.mapInArrow(lambda b: _ways(b, costs), "id long, chunk long, first int, last int")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for (conv, chunk), group in _sorted_groups(batches, ["id", "chunk"]):
            group = list(group)
            path = repaired([role_number(r["role"]) for r in group], group[0]["first"], group[0]["last"], costs)
            for r, (state, move) in zip(group, path, strict=True):
                made.append(_rendered(conv, r, state, move, costs))
                if len(made) == 1000:
                    yield pa.RecordBatch.from_pylist(made, _OUT)
                    made = []
        if made:
            yield pa.RecordBatch.from_pylist(made, _OUT)

    wide = dealt.select(F.col("conv.id").alias("id"), "chunk", "seq", "turn", "role", "text", "turns")
    joined = wide.join(
        ways.select(F.col("id").alias("__id"), F.col("chunk").alias("__chunk"), "first", "last"),
        F.col("id").eqNullSafe(F.col("__id")) & (F.col("chunk") == F.col("__chunk")),
    ).drop("__id", "__chunk")
    ready = joined.repartition("id", "chunk").sortWithinPartitions("id", "chunk", "seq")
    return ready.mapInArrow(render, OUT)


OUT = ("conv_id long, seq long, turn long, role string, new_role string, action string,"
       " inserted string, cost long, closing string, piece string")
_TABLES = pa.schema([("id", pa.int64()), ("chunk", pa.int64()), ("cost", pa.list_(pa.int64()))])
_WAYS = pa.schema([("id", pa.int64()), ("chunk", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
_OUT = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("new_role", pa.string()), ("action", pa.string()), ("inserted", pa.string()), ("cost", pa.int64()),
    ("closing", pa.string()), ("piece", pa.string()),
])


def _ways(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    """The states each chunk begins and ends in on a least-cost path of its conversation."""
    for conv, group in _sorted_groups(batches, ["id"]):
        tables, before = [], [0, FAR, FAR, FAR]
        reached = [before]
        for row in group:
            table = [row["cost"][4 * s : 4 * s + 4] for s in STATES]
            tables.append((row["chunk"], table))
            before = [min(before[s] + table[s][t] for s in STATES) for t in STATES]
            reached.append(before)
        last = min(STATES, key=lambda s: before[s] + ending(s, costs)[0])
        made = []
        for i in range(len(tables) - 1, -1, -1):
            chunk, table = tables[i]
            first = min(STATES, key=lambda s: reached[i][s] + table[s][last])
            made.append({"id": conv, "chunk": chunk, "first": first, "last": last})
            last = first
        for at in range(0, len(made), 10_000):
            yield pa.RecordBatch.from_pylist(made[at : at + 10_000], _WAYS)


def _rendered(conv: int | None, r: dict, state: int, move: tuple, costs: Costs) -> dict:
    cost, to, action, ahead = move
    piece = ""
    if action == "merge":
        piece = "\n" + r["text"]
    else:
        if r["seq"]:
            piece = END
        piece += "".join(HEADER.format(ROLES[x]) + END for x in ahead)
        piece += HEADER.format(ROLES[to]) + r["text"]
    closing: tuple[int, ...] = ()
    if r["seq"] == r["turns"] - 1:
        more, closing = ending(to, costs)
        cost += more
        piece += END + "".join(HEADER.format(ROLES[x]) + END for x in closing)
    return {
        "conv_id": conv, "seq": r["seq"], "turn": r["turn"], "role": r["role"], "new_role": ROLES[to],
        "action": action, "inserted": ",".join(ROLES[x] for x in ahead), "cost": cost,
        "closing": ",".join(ROLES[x] for x in closing), "piece": piece,
    }
