"""Chat formatting: the cheapest repair of a sequence of roles, then its rendering."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import columns_of
from tidewire.operators.lookup import lookup
from tidewire.operators.ranking import numbered
from tidewire.session import settle

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# Which role may follow which: a system turn only at the start, then user and assistant in turn.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
BLOCK = 1024
_FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    """Costs of a repair. A turn of an unknown role, or of none, is relabelled at the cost of ``unknown``."""

    merge: int = 2
    relabel: int = 3
    insert: int = 4
    unknown: int = 1


@dataclass(frozen=True)
class Step:
    """One way to take a turn: from a state to a state, with the roles inserted before it."""

    before: int
    after: int
    cost: int
    action: str
    inserted: tuple[int, ...] = ()


def _bridges() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of empty turns after which a role may follow a state."""
    found: dict[tuple[int, int], tuple[int, ...]] = {}
    waiting: list[tuple[int, int, tuple[int, ...]]] = [(s, s, ()) for s in range(STATES)]
    for origin, state, run in waiting:
        for role in LEGAL[state]:
            if (origin, role) not in found:
                found[origin, role] = run
                waiting.append((origin, role, (*run, role)))
    return found


BRIDGES = _bridges()


def steps_of(role: str | None, costs: Costs) -> list[Step]:
    """All ways to take a turn, in the order in which ties are settled."""
    known = ROLES.index(role) + 1 if role in ROLES else None
    found = []
    for after in (SYSTEM, USER, ASSISTANT):
        relabel = 0 if after == known else costs.relabel if known else costs.unknown
        action = "keep" if after == known else "relabel"
        for before in range(STATES):
            run = BRIDGES.get((before, after))
            if run is not None:
                found.append(Step(before, after, relabel + costs.insert * len(run), action, run))
        # The turn joins the message before it, whose role it takes.
        found.append(Step(after, after, costs.merge + relabel, "merge"))
    order = {"keep": 0, "merge": 1, "relabel": 2}
    return sorted(found, key=lambda s: (order[s.action], len(s.inserted), s.before, s.after))


class Automaton:
    """Tables of the steps of each kind of turn. A conversation ends legally after an assistant turn."""

    def __init__(self, costs: Costs):
        self.steps = {role: steps_of(role, costs) for role in (*ROLES, None)}
        self.matrices = {}
        for role, steps in self.steps.items():
            m = np.full((STATES, STATES), _FAR, dtype=np.int64)
            for s in steps:
                m[s.before, s.after] = min(m[s.before, s.after], s.cost)
            self.matrices[role] = m
        closing = [_FAR] * STATES
        self.endings: list[tuple[int, ...]] = [()] * STATES
        for state in range(STATES):
            run = () if state in (ASSISTANT, START) else (*BRIDGES[state, ASSISTANT], ASSISTANT)
            self.endings[state], closing[state] = run, costs.insert * len(run)
        self.closing = np.array(closing, dtype=np.int64)

    def key(self, role: str | None) -> str | None:
        return role if role in ROLES else None

    def product(self, roles: list[str | None]) -> np.ndarray:
        """The least cost from each state to each state over some turns."""
        total = np.full((STATES, STATES), _FAR, dtype=np.int64)
        np.fill_diagonal(total, 0)
        for role in roles:
            total = times(total, self.matrices[self.key(role)])
        return total

    def forward(self, entry: np.ndarray, roles: list[str | None]) -> list[np.ndarray]:
        """The least cost to each state before the first turn and after each."""
        costs = [entry]
        for role in roles:
            costs.append((costs[-1][:, None] + self.matrices[self.key(role)]).min(axis=0))
        return costs

    def backward(self, costs: list[np.ndarray], roles: list[str | None], exit_state: int) -> tuple[int, list[Step]]:
        """The steps of the cheapest way into ``exit_state``, and the state it enters from.

        Among equally cheap steps the first in the order of ``steps_of`` is taken, whatever blocks the turns lie in.
        """
        state, taken = exit_state, []
        for k in range(len(roles) - 1, -1, -1):
            step = next(s for s in self.steps[self.key(roles[k])]
                        if s.after == state and costs[k][s.before] + s.cost == costs[k + 1][state])
            taken.append(step)
            state = step.before
        return state, taken[::-1]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of cost matrices: least sums."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _FAR)


def _follow(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The composition of two tables of states."""
    return then[first]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of equal keys, which arrive next to each other."""
    held: list[dict] = []
    last: tuple | None = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and key != last:
                yield held
                held = []
            last = key
            held.append(row)
    if held:
        yield held


def scan_blocks(blocks: DataFrame, n: int, value: str, combine: Callable[[np.ndarray, np.ndarray], np.ndarray],
                unit: np.ndarray, width: int, backward: bool = False) -> DataFrame:
    """For each block of a conversation the combination of all blocks before it (after it, if ``backward``).

    ``blocks`` has ``conv, block`` and an array ``value``. Blocks are taken in groups of ``width`` by their number, the
    groups are combined, and the combinations are scanned in the same way, until one group is left: so no task
    holds more than ``width`` blocks of a conversation, and the levels grow with the logarithm of ``n``,
    the largest block number.
    """
    shape = unit.shape
    order = [F.desc("block") if backward else F.asc("block")]

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("part", F.floor(F.col("block") / width).cast("long")).repartition("conv", "part").sortWithinPartitions(
            "conv", "part", *order)

    def put(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def reduce_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv", "part"]):
            total = unit
            for row in group:
                total = combine(total, np.array(row[value]).reshape(shape))
            yield put([(group[0]["conv"], group[0]["part"], total.ravel().tolist())], ["conv", "block", value])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv", "part"]):
            state = unit if group[0]["outer"] is None else np.array(group[0]["outer"]).reshape(shape)
            rows = []
            for row in group:
                rows.append((row["conv"], row["block"], state.ravel().tolist()))
                state = combine(state, np.array(row[value]).reshape(shape))
            yield put(rows, ["conv", "block", "outer"])

    if n < width:
        outer = blocks.withColumn("outer", F.lit(None).cast("array<long>"))
    else:
        parts = settle(dealt(blocks.select("conv", "block", value)).mapInArrow(
            reduce_part, f"conv string, block long, {value} array<long>"))
        above = scan_blocks(parts, n // width, value, combine, unit, width, backward).withColumnRenamed("block", "part")
        outer = blocks.withColumn("part", F.floor(F.col("block") / width).cast("long")).join(above, ["conv", "part"]).drop("part")
    return settle(dealt(outer.select("conv", "block", value, "outer")).mapInArrow(
        spread, "conv string, block long, outer array<long>"))


def _solve(blocks: DataFrame, automaton: Automaton, n: int, width: int) -> DataFrame:
    """For each block the least costs at its start, the state at its end, and the last position of its conversation."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv", "block"]):
            total = automaton.product([r["role"] for r in group])
            yield pa.RecordBatch.from_arrays(
                [pa.array([group[0]["conv"]]), pa.array([group[0]["block"]]),
                 pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], names=["conv", "block", "costs"])

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["conv", "block"]):
            roles = [r["role"] for r in group]
            costs = automaton.forward(np.array(group[0]["outer"][:STATES]), roles)
            states = [automaton.backward(costs, roles, s)[0] if costs[-1][s] < _FAR else s for s in range(STATES)]
            closed = costs[-1] + automaton.closing
            yield pa.RecordBatch.from_arrays(
                [pa.array([group[0]["conv"]]), pa.array([group[0]["block"]]), pa.array([states], pa.list_(pa.int64())),
                 pa.array([group[0]["outer"][:STATES]], pa.list_(pa.int64())), pa.array([int(closed.argmin())]),
                 pa.array([group[-1]["pos"]])], names=["conv", "block", "states", "entry", "final", "pos"])

    def together(df: DataFrame) -> DataFrame:
        return df.repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")

    costs = settle(together(blocks).mapInArrow(products, "conv string, block long, costs array<long>"))
    nothing = np.full((STATES, STATES), _FAR, dtype=np.int64)
    np.fill_diagonal(nothing, 0)
    # The first row of the product of all earlier blocks: the least costs from the start.
    before = scan_blocks(costs, n, "costs", times, nothing, width)
    states = settle(together(blocks.join(before, ["conv", "block"])).mapInArrow(
        tables, "conv string, block long, states array<long>, entry array<long>, final long, pos long"))
    ends = settle(states.groupBy("conv").agg(F.max_by("final", "pos").alias("final"), F.max("pos").alias("last_pos")))
    after = scan_blocks(states.select("conv", "block", "states"), n, "states", _follow, np.arange(STATES), width, backward=True)
    known = lookup(states.select("conv", "block", "entry").join(after, ["conv", "block"]), ends, "conv", "block")
    return known.select(
        "conv", "block", "entry", F.element_at("outer", (F.col("final") + 1).cast("int")).alias("exit"), "last_pos")


def _rendered(text: str | None, step: Step, ending: tuple[int, ...] | None) -> str:
    """The part of the rendering that a turn adds. Markers inside a text lose their shape."""
    body = (text or "").replace("<|", "< |")
    if step.action == "merge":
        out = "\n" + body
    else:
        empty = "".join(f"<|{ROLES[r - 1]}|>\n<|end|>\n" for r in step.inserted)
        out = f"{'' if step.before == START else '<|end|>' + chr(10)}{empty}<|{ROLES[step.after - 1]}|>\n{body}"
    if ending is not None:
        out += "<|end|>\n" + "".join(f"<|{ROLES[r - 1]}|>\n<|end|>\n" for r in ending)
    return out


def repair_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", costs: Costs = Costs(), block: int = BLOCK) -> DataFrame:
    """The cheapest legal form of each conversation, one row per turn.

    Returns ``conv_id, turn, position, role, new_role, action, inserted, cost, rendered``. A legal conversation has at
    most one system turn, at its start, then user and assistant in turn, and ends with an assistant. A turn is
    kept, relabelled, or merged into the message before it, and empty turns (``inserted``) may be put before it;
    ``Costs`` prices each. The least total is found by dynamic programming over the states of the automaton;
    of equally cheap ways the one is taken that, from the end on, prefers keep, merge, relabel, then fewer
    insertions. ``rendered`` is what the turn adds to the text of the conversation: joined by ``position`` the parts
    are the repaired conversation, whatever its length. Turns that close it are in the last part.

    Least costs over a stretch of turns form a small matrix, and matrices combine, so turns are dealt into
    blocks of ``block`` by their global position. Prefixes of costs and suffixes of states are scanned over the
    blocks in levels, and no task ever holds more than a block of turns, even of a conversation with a
    third of all rows.

    Turns are in the order of ``turn`` (null first), then role and text; repeated rows count each. Rows with a
    null ``conv_id`` are one conversation. An unknown or null role must be relabelled; a null text counts as
    empty. Other columns are ignored.
    """
    automaton = Automaton(costs)
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("")).alias("conv"),
        F.monotonically_increasing_id().alias("tie"))
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.xxhash64("text"), F.col("tie")]
    placed = settle(numbered(rows, order, name="pos").withColumn(
        "block", F.floor((F.col("pos") - 1) / block).cast("long")).drop("tie"))
    n = placed.agg(F.max("block")).first()[0] or 0
    solved = _solve(placed.select("conv", "block", "pos", "role"), automaton, n, block)
    solved = settle(solved)
    id_types = {c: rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # Groups may go on in the next batch: what is not finished waits there, a block at most.
            keys = list(zip(*columns_of(batch, "conv", "block")))
            if held:
                batch = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
                keys = list(zip(*columns_of(batch, "conv", "block")))
            done = next((k for k in range(len(keys) - 1, 0, -1) if keys[k] != keys[k - 1]), 0)
            if done:
                yield finish(batch.slice(0, done), keys[:done])
            held = [batch.slice(done)]
        if held:
            yield finish(held[0], list(zip(*columns_of(held[0], "conv", "block"))))

    def finish(batch: pa.RecordBatch, keys: list[tuple]) -> pa.RecordBatch:
        roles, texts, entries, exits, positions, lasts = columns_of(batch, "role", "text", "entry", "exit", "pos", "last_pos")
        steps: list[Step] = []
        start = 0
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                part = roles[start:end]
                steps += automaton.backward(automaton.forward(np.array(entries[start]), part), part, exits[start])[1]
                start = end
        endings = [automaton.endings[s.after] if p == last else None for s, p, last in zip(steps, positions, lasts)]
        closing = [0 if e is None else costs.insert * len(e) for e in endings]
        at = batch.schema.get_field_index
        return pa.RecordBatch.from_arrays(
            [batch.column(at("conv_id")), batch.column(at("turn")), batch.column(at("pos")), batch.column(at("role")),
             pa.array([ROLES[s.after - 1] for s in steps], pa.string()), pa.array([s.action for s in steps], pa.string()),
             pa.array([[ROLES[r - 1] for r in s.inserted] for s in steps], pa.list_(pa.string())),
             pa.array([s.cost + c for s, c in zip(steps, closing)], pa.int64()),
             pa.array([_rendered(t, s, e) for t, s, e in zip(texts, steps, endings)], pa.string())],
            names=["conv_id", "turn", "position", "role", "new_role", "action", "inserted", "cost", "rendered"])

    whole = placed.join(solved, ["conv", "block"]).repartition("conv", "block").sortWithinPartitions("conv", "block", "pos")
    return whole.mapInArrow(
        write, f"conv_id {id_types['conv_id']}, turn {id_types['turn']}, position long, role string, new_role string, "
               "action string, inserted array<string>, cost long, rendered string")
