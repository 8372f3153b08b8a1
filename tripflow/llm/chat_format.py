"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system message, then user and assistant
messages in turn, beginning with the user and ending with the assistant. The
automaton's state is the role of the open message (or START). A dynamic
program over it chooses, for each turn of the input in order, one of

* ``keep``: the turn begins the next message, in its own role;
* ``relabel``: it begins the next message, in another role;
* ``merge``: its text goes on in the open message, which has its role;
* ``merge_relabel``: it goes on in the open message, in spite of its role;

and before a message, or at the end, the insertion of empty messages that
the automaton asks for. The cheapest repair wins; the costs are parameters.

The program is a product of small matrices (one for each turn, states by
states, in the min-plus algebra), and such products may be taken in any
grouping. So a conversation need not lie in one task: turns are dealt by
range of (conversation, turn) into parts, and each part multiplies its
stretches. Of conversations that go on in another part, a matrix for each
stretch meets on the driver (two of ``states^2`` numbers a part at most),
which knows then what the rest costs after each stretch; a second pass tells
where the cheapest way leads from each state, and a last one fixes the
turns. A conversation with a third of all turns lies in a third of the parts.

Each input turn gives one row with its fragment of the rendered sequence;
the fragments of a conversation in order are its rendering
(``render_conversations`` joins them).

Defined results: roles are compared in lower case without outer white
space; unknown and null roles may become any role at the cost of a relabel;
a null text counts as empty; turns are ordered by turn (null first), then
role and a hash of the text, and repeated rows are separate turns; null conversation ids
form one conversation. Of equally cheap repairs the one wins that keeps,
then merges, then relabels, first turn first. Extra columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle
from tripflow.llm.worker import lean

SYSTEM, USER, ASSISTANT, START = range(4)
ROLES = ("system", "user", "assistant")
STATES = 4
# Fixed value: which role may follow which state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 40
# Bytes of text in a part.
PART_BYTES = 64 << 20


@dataclass(frozen=True)
class Costs:
    """What a repair costs; whole numbers."""

    merge: int = 2
    relabel: int = 3
    insert: int = 4


def insertions(state: int, role: int) -> tuple[int, ...] | None:
    """The fewest empty messages between ``state`` and a new message of ``role``; None: impossible."""
    paths: list[tuple[int, tuple[int, ...]]] = [(state, ())]
    for _ in range(3):
        for last, path in paths:
            if role in NEXT[last]:
                return path
        paths = [(r, (*path, r)) for last, path in paths for r in NEXT[last]]
    return None


def endings(state: int) -> tuple[int, ...]:
    """Empty messages that end a conversation after ``state``."""
    if state == ASSISTANT:
        return ()
    return (*(insertions(state, ASSISTANT) or ()), ASSISTANT)


def choices(role: int | None, costs: Costs) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(from state, to state, cost, action, insertions) of one turn, in order of preference."""
    out = []
    for state in range(STATES):
        for to in range(3):
            own = role == to
            gaps = insertions(state, to)
            if gaps is not None:
                cost = costs.insert * len(gaps) + (0 if own else costs.relabel)
                out.append((0 if own else 2, state, to, cost, "keep" if own else "relabel", gaps))
            if state == to:
                cost = costs.merge + (0 if own else costs.relabel)
                out.append((1 if own else 3, state, to, cost, "merge" if own else "merge_relabel", ()))
    return [x[1:] for x in sorted(out, key=lambda x: x[0])]


class Program:
    """Step matrices and best choices of each role."""

    def __init__(self, costs: Costs):
        self.step, self.best = [], []
        for role in (SYSTEM, USER, ASSISTANT, None):
            matrix = np.full((STATES, STATES), FAR, dtype=np.int64)
            best: dict[tuple[int, int], tuple[str, tuple[int, ...]]] = {}
            for state, to, cost, action, gaps in choices(role, costs):
                if cost < matrix[state, to]:
                    matrix[state, to] = cost
                    best[state, to] = (action, gaps)
            self.step.append(matrix)
            self.best.append(best)
        self.end = np.array([costs.insert * len(endings(s)) for s in range(STATES)], dtype=np.int64)
        self.end[START] = 0  # a conversation without turns stays empty
        self.order = {"keep": 0, "merge": 1, "relabel": 2, "merge_relabel": 3}

    def after(self, roles: list[int], end: np.ndarray) -> np.ndarray:
        """Cost of the rest from each state, before each turn and after the last."""
        out = np.empty((len(roles) + 1, STATES), dtype=np.int64)
        out[-1] = end
        for k in range(len(roles) - 1, -1, -1):
            out[k] = np.minimum((self.step[roles[k]] + out[k + 1][None, :]).min(axis=1), FAR)
        return out

    def product(self, roles: list[int]) -> np.ndarray:
        """The matrix of a stretch of turns."""
        out = np.where(np.eye(STATES, dtype=bool), 0, FAR)
        for r in roles:
            out = np.minimum((out[:, :, None] + self.step[r][None, :, :]).min(axis=1), FAR)
        return out

    def choose(self, roles: list[int], state: int, end: np.ndarray) -> list[tuple[int, str, tuple[int, ...]]]:
        """(role, action, insertions before) of each turn on the cheapest way."""
        rest = self.after(roles, end)
        out = []
        for k, r in enumerate(roles):
            costs = self.step[r][state] + rest[k + 1]
            least = costs.min()
            to = min(
                (s for s in range(3) if costs[s] == least), key=lambda s: (self.order[self.best[r][state, s][0]], s)
            )
            out.append((to, *self.best[r][state, to]))
            state = to
        return out


def _role(name: str | None) -> int:
    name = (name or "").strip().lower()
    return ROLES.index(name) if name in ROLES else 3


@lean
def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], bool, bool]]:
    """The turns of one conversation in one part, whether they begin the part, whether they end it.

    Rows are (part, conversation, role, ...), in order of part.
    """
    held: list[tuple] = []
    first = True
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][:2] != row[:2]:
                last = held[-1][0] != row[0]
                yield held, first, last
                held, first = [], last
            held.append(row)
    if held:
        yield held, first, True


def _matrices(costs: Costs):
    """The matrices of each part's first and last stretch."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program, found = Program(costs), []
        for stretch, first, last in _stretches(batches):
            if first or last:
                cells = program.product([_role(r[2]) for r in stretch]).ravel().tolist()
                found.append((stretch[0][0], stretch[0][1], first, last, len(stretch), cells))
        kinds = [pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64())]
        columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "conv", "first", "last", "n", "cells"]
        )

    return run


def _ways(costs: Costs, ends: dict):
    """Where the cheapest way through a stretch of ``ends`` leads from each state, and if it begins with a merge."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program, found = Program(costs), []
        for stretch, first, last in _stretches(batches):
            key = (stretch[0][0], first, last)
            if (first or last) and key in ends:
                roles = [_role(r[2]) for r in stretch]
                chosen = [program.choose(roles, s, np.array(ends[key])) for s in range(STATES)]
                merges = [c[0][1].startswith("merge") for c in chosen]
                found.append((*key, [c[-1][0] for c in chosen], merges))
        kinds = [pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.bool_())]
        columns = list(zip(*found, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "first", "last", "to", "merges"]
        )

    return run


def _chains(found: list) -> list[list]:
    """Stretches (rows of ``_matrices``) that make up one conversation, where there are several."""
    chains: list[list] = []
    before = None
    for row in sorted(found, key=lambda r: (r["part"], not r["first"])):
        if before is not None and before["last"] and row["first"] and before["conv"] == row["conv"]:
            if chains and chains[-1][-1] is before:
                chains[-1].append(row)
            else:
                chains.append([before, row])
        before = row
    return chains


def _message(role: int, text: str) -> str:
    return f"<|im_start|>{ROLES[role]}\n{text}<|im_end|>\n"


def _fix(costs: Costs, context: dict):
    """Rows of repaired turns.

    ``context`` has (state before, cost after, whether the next stretch goes
    on with a merge, number of turns before) of stretches whose conversation lies in several parts.
    """
    names = ["conv", "position", "role", "new_role", "action", "inserted", "fragment"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        program = Program(costs)
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for stretch, first, last in _stretches(batches):
            known = context.get((stretch[0][0], first, last)) if first or last else None
            state, end, goes_on, before = known or (START, program.end, None, 0)
            chosen = program.choose([_role(r[2]) for r in stretch], state, np.array(end))
            merges = [c[1].startswith("merge") for c in chosen]
            for k, (row, (to, action, gaps)) in enumerate(zip(stretch, chosen, strict=True)):
                next_merges = merges[k + 1] if k + 1 < len(chosen) else goes_on
                tail = endings(to) if next_merges is None else ()
                text = row[3] or ""
                fragment = "".join(_message(g, "") for g in gaps)
                fragment += f"\n{text}" if merges[k] else f"<|im_start|>{ROLES[to]}\n{text}"
                fragment += "" if next_merges else "<|im_end|>\n"
                fragment += "".join(_message(g, "") for g in tail)
                rows.append((row[1], before + k, row[2], ROLES[to], action, len(gaps) + len(tail), fragment))
            if len(rows) >= 5000:
                yield flush()
        yield flush()

    return run


def format_chats(
    turns: DataFrame,
    costs: Costs = Costs(),  # noqa: B008 - immutable
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    parts: int | None = None,
) -> DataFrame:
    """One row per turn: id, position, role, new_role, action, inserted, fragment.

    ``position`` counts a conversation's turns from 0; ``inserted`` counts
    the empty messages that the fragment holds.
    ``parts`` is the number of ranges that turns are dealt to, by default
    one for ``PART_BYTES`` of text and the session's shuffle partitions at
    least.
    """
    spark = turns.sparkSession
    kind = turns.schema[id_col].dataType.simpleString()
    rows = turns.select(
        F.col(id_col).cast("string").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    if parts is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // PART_BYTES + 1)
    order = ["conv", "turn", "role", "tie"]
    # written once, so that all passes see the same parts
    dealt = settle(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .select(F.shiftright("at", 33).cast("int").alias("part"), "conv", "role", "text", "at"),
        "chat-turns",
    )

    def in_order(*columns: str) -> DataFrame:
        chosen = dealt.select("part", "conv", "role", *columns, "at")
        return chosen.repartition(parts, "part").sortWithinPartitions("part", "at").drop("at")

    found = (
        in_order()
        .mapInArrow(
            _matrices(costs), "part int, conv string, first boolean, last boolean, n long, cells array<long>"
        )
        .collect()
    )
    chains = _chains(found)  # two stretches for each part at most
    key = lambda r: (r["part"], r["first"], r["last"])
    context: dict = {}
    if chains:
        program, ends = Program(costs), {}
        for chain in chains:
            end = program.end
            for row in reversed(chain):
                ends[key(row)] = end.tolist()
                matrix = np.array(row["cells"]).reshape(STATES, STATES)
                end = np.minimum((matrix + end[None, :]).min(axis=1), FAR)
        ways = {
            key(r): r
            for r in in_order().mapInArrow(
                _ways(costs, ends), "part int, first boolean, last boolean, to array<int>, merges array<boolean>"
            ).collect()
        }
        for chain in chains:
            state, before = START, 0
            for k, row in enumerate(chain):
                way = ways[key(row)]
                after = way["to"][state]
                goes_on = ways[key(chain[k + 1])]["merges"][after] if k + 1 < len(chain) else None
                context[key(row)] = (state, ends[key(row)], goes_on, before)
                state, before = after, before + row["n"]
    fixed = in_order("text").mapInArrow(
        _fix(costs, context),
        "conv string, position long, role string, new_role string, action string, inserted int, fragment string",
    )
    return fixed.select(
        F.col("conv").cast(kind).alias(id_col), "position", "role", "new_role", "action", "inserted", "fragment"
    )


def render_conversations(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Rows (id, rendered): each conversation as one text; for conversations that one row can hold."""
    return formatted.groupBy(id_col).agg(
        F.concat_ws(
            "", F.transform(F.array_sort(F.collect_list(F.struct("position", "fragment"))), lambda x: x["fragment"])
        ).alias("rendered")
    )
