"""Minimum-cost role repair of conversations, and rendering.

Legal conversations are an optional system turn, then user and assistant in
turn, and end on an assistant's. Reading turn after turn, the automaton may keep
a turn, relabel it, merge it into the turn before, or insert an empty turn; each
has a cost, and the cheapest way through is taken. Costs of reading a stretch of
turns, from each state to each, are a matrix; matrices combine by minimum and
sum. So a conversation of any length is split over range partitions: each
partition sums up its stretches, the few sums per partition are combined, and a
second pass over the same partitions traces the cheapest way between the states
found for their borders. No conversation is gathered.

Ties prefer keeping, then merging, relabelling, inserting, and the state that is
named first. Unknown and null roles have no keeping cost of 0: they are always
relabelled. A null text is empty. A null conversation id is a conversation of
its own. Turns with equal numbers are ordered by role and text; repeated rows
are turns of their own. A null turn number comes first. An empty table gives no
rows. Texts of any length stay whole; rendering is turn by turn, and the rows of
a turn are rendered as one message: its mark of the end is on its last row, and
where the format trims, white space goes at the message's ends only. What a
partition must know for that of its neighbours' rows is found with the borders.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.constants import WHITESPACE
from pairloom.functions.text import is_blank
from pairloom.operators.chat import CHATML, ChatFormat
from pairloom.session import checkpointed

#: The last turn that was laid down: none yet, or by this role.
STATES = ("start", "system", "user", "assistant")
_ROLES = STATES[1:]


@dataclass(frozen=True)
class Costs:
    relabel: float = 2.0
    merge: float = 1.0
    insert: float = 3.0


@dataclass(frozen=True)
class Step:
    """From a state, by one turn of the input, to a state: turns to insert, then what becomes of the turn."""

    begin: int
    end: int
    inserts: tuple[str, ...]
    action: str
    cost: float


def _legal(last: str, role: str) -> bool:
    return {"system": last == "start", "user": last in ("start", "system", "assistant"), "assistant": last == "user"}[role]


def steps(role: str | None, costs: Costs) -> list[Step]:
    """All ways to read a turn of this role, the cheapest of each pair of states, in the order of preference."""
    found: dict[tuple[int, int], Step] = {}
    for b, last in enumerate(STATES):
        for inserts in ((), ("user",), ("assistant",), ("user", "assistant")):
            state, legal = last, True
            for made in inserts:
                legal = legal and _legal(state, made)
                state = made
            if not legal:
                continue
            for e, new in enumerate(STATES):
                options = []
                if new != "start" and _legal(state, new):
                    options.append(("keep", 0.0) if new == role else ("relabel", costs.relabel))
                if not inserts and new == last != "start":
                    options.append(("merge", costs.merge + (0.0 if new == role else costs.relabel)))
                for action, cost in options:
                    step = Step(b, e, inserts, action, cost + costs.insert * len(inserts))
                    if (b, e) not in found or step.cost < found[b, e].cost:
                        found[b, e] = step
    return list(found.values())


def _close(costs: Costs) -> list[tuple[int, tuple[str, ...], float]]:
    """How a conversation that ends in each state is ended: on an assistant's turn."""
    return [
        (s, made, costs.insert * len(made))
        for s, made in enumerate((("user", "assistant"), ("user", "assistant"), ("assistant",), ()))
    ]


class _Tables:
    """For each role the cost matrix of one turn, and the step behind each entry."""

    def __init__(self, costs: Costs) -> None:
        self.costs, self.of = costs, {}

    def __getitem__(self, role: str | None) -> tuple[np.ndarray, dict[tuple[int, int], Step]]:
        role = role if role in _ROLES else None
        if role not in self.of:
            own = {(s.begin, s.end): s for s in steps(role, self.costs)}
            matrix = np.full((len(STATES), len(STATES)), np.inf)
            for at, s in own.items():
                matrix[at] = s.cost
            self.of[role] = matrix, own
        return self.of[role]


@dataclass(frozen=True)
class Stretch:
    """Of a stretch of turns, from each state to each: cost, and what the rows next to it must know of its rows.

    `more`: its first row is merged into the turn before. `opens`: any row begins a turn. `head` and `tail`: any
    text before its first beginning, or after its last one, is not blank.
    """

    cost: np.ndarray
    more: np.ndarray
    opens: np.ndarray
    head: np.ndarray
    tail: np.ndarray


def stretch(roles: list[str | None], blanks: list[bool], costs: Costs) -> Stretch:
    """The sums of the ways that `trace` takes, ties included."""
    tables, n = _Tables(costs), len(STATES)
    merges: dict[str | None, np.ndarray] = {}
    at, so_far = np.arange(n), None
    for role, blank in zip(roles, blanks):
        matrix, own = tables[role]
        if role not in merges:
            merges[role] = np.array([[(b, e) in own and own[b, e].action == "merge" for e in range(n)] for b in range(n)])
        merge = merges[role]
        if so_far is None:
            so_far = Stretch(matrix, merge, ~merge, merge & (not blank), np.full((n, n), not blank))
            continue
        total = so_far.cost[:, :, None] + matrix[None, :, :]
        came = total.argmin(axis=1)
        merged = merge[came, at]
        more, opens, head, tail = (np.take_along_axis(x, came, axis=1) for x in (so_far.more, so_far.opens, so_far.head, so_far.tail))
        so_far = Stretch(
            total.min(axis=1),
            more,
            opens | ~merged,
            head | (merged & ~opens & (not blank)),
            (tail & merged) | (not blank),
        )
    return so_far


@dataclass(frozen=True)
class Share:
    """A partition's part of a conversation: its states, whether it is the first and the last, and the rows around it.

    `continued`: the next row is merged into this part's last turn. `before` and `after`: the turn that crosses the
    border has text that is not blank there.
    """

    begin: int
    end: int
    first: bool = True
    last: bool = True
    continued: bool = False
    before: bool = False
    after: bool = False


def trace(roles: list[str | None], begin: int, end: int, costs: Costs) -> list[Step]:
    """The cheapest steps that read these turns from one state to another."""
    tables = _Tables(costs)
    reach = np.full(len(STATES), np.inf)
    reach[begin] = 0.0
    back = []
    for role in roles:
        total = reach[:, None] + tables[role][0]
        back.append(total.argmin(axis=0))
        reach = total.min(axis=0)
    out, state = [], end
    for role, came in zip(reversed(roles), reversed(back)):
        out.append(tables[role][1][int(came[state]), state])
        state = int(came[state])
    return out[::-1]


def repair_roles(turns: DataFrame, costs: Costs = Costs(), fmt: ChatFormat = CHATML, parts: int | None = None) -> DataFrame:
    """`conv_id, turn, step, place, role, action, text, rendered`: the repaired turns.

    `turn` is the input turn a row comes from or, for inserted turns, precedes;
    `step` numbers the rows of one input turn. `place` is `open` for a row that
    begins a turn and `more` for one merged into the turn before. Rows in the
    order of turn and step, `rendered` joined, are the conversation as
    `render_messages` renders it, the texts of a turn joined by line breaks.
    """
    parts = parts or int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number, name = turns.schema["turn"].dataType.simpleString(), turns.schema["conv_id"].dataType.simpleString()
    order = ("conv_id", "turn", "role", "text")
    ranged = checkpointed(
        turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of a partition's first and last conversation, the only ones that others may continue."""
        key, part, roles, blanks, out, kind = None, 0, [], [], [], None

        def summed() -> tuple:
            s = stretch(roles, blanks, costs)
            flags = [x.ravel().tolist() for x in (s.more, s.opens, s.head, s.tail)]
            return part, key, s.cost.ravel().tolist(), sum(flags, [])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, role, blank, part_ in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "blank", "part"))):
                if roles and conv != key:
                    if not out:
                        out.append(summed())
                    roles, blanks = [], []
                key, part = conv, part_
                roles.append(role)
                blanks.append(blank)
        if roles:
            out.append(summed())
            kinds = (pa.int32(), kind, pa.list_(pa.float64()), pa.list_(pa.bool_()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["part", "conv_id", "matrix", "flags"])

    # Two rows of 80 numbers per partition at most.
    blank = is_blank("text") if fmt.trim else F.lit(False)
    sums = (
        ranged.select("conv_id", "role", "part", blank.alias("blank"))
        .mapInArrow(borders, f"part int, conv_id {name}, matrix array<double>, flags array<boolean>")
        .collect()
    )
    chains: dict[object, list[tuple[int, Stretch]]] = {}
    for r in sorted(sums, key=lambda r: r["part"]):
        flags = np.array(r["flags"], dtype=bool).reshape(4, len(STATES), -1)
        own = Stretch(np.array(r["matrix"]).reshape(len(STATES), -1), *flags)
        chains.setdefault(r["conv_id"], []).append((r["part"], own))
    closing = np.array([c for *_, c in _close(costs)])
    fixed: dict[tuple[int, object], Share] = {}
    for conv, chain in chains.items():
        reach, back = np.array([0.0, np.inf, np.inf, np.inf]), []
        for _, own in chain:
            total = reach[:, None] + own.cost
            back.append(total.argmin(axis=0))
            reach = total.min(axis=0)
        state = int((reach + closing).argmin())
        ways = []
        for i in range(len(chain) - 1, -1, -1):
            ways.append((int(back[i][state]), state))
            state = int(back[i][state])
        ways.reverse()
        before, befores = False, []
        for (_, own), way in zip(chain, ways):
            befores.append(before)
            before = bool(own.tail[way] or (before and not own.opens[way]))
        continued = after = False
        for i in range(len(chain) - 1, -1, -1):
            (part, own), way = chain[i], ways[i]
            fixed[part, conv] = Share(*way, i == 0, i == len(chain) - 1, continued, befores[i], after)
            continued = bool(own.more[way])
            after = bool(own.head[way] or (after and not own.opens[way]))
    shared = turns.sparkSession.sparkContext.broadcast(fixed)

    names = ["conv_id", "turn", "step", "place", "role", "action", "text", "begins", "ends", "lead", "trail"]

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversation(key: object, part: int, held: list[tuple]) -> list[tuple]:
            roles = [h[1] for h in held]
            own = shared.value.get((part, key))
            if own is None:
                tables = _Tables(costs)
                reach = np.array([0.0, np.inf, np.inf, np.inf])
                for role in roles:
                    reach = (reach[:, None] + tables[role][0]).min(axis=0)
                own = Share(0, int((reach + closing).argmin()))
            rows = []
            for (turn, _, text), step in zip(held, trace(roles, own.begin, own.end, costs)):
                made = [(key, turn, i, "open", r, "insert", "") for i, r in enumerate(step.inserts)]
                role = STATES[step.end]
                place = "more" if step.action == "merge" else "open"
                rows += [*made, (key, turn, len(made), place, role, step.action, text)]
            if own.last:
                turn, at = rows[-1][1], rows[-1][2] + 1
                rows += [(key, turn, at + i, "open", r, "insert", "") for i, r in enumerate(_close(costs)[own.end][1])]
            return [(*row, *marks) for row, marks in zip(rows, around(rows, own))]

        def around(rows: list[tuple], own: Share) -> list[tuple[bool, bool, bool, bool]]:
            """Of each row whether it begins the conversation, ends a turn, and has its turn's first and last text."""
            opens = [r[3] == "open" for r in rows]
            said = [bool(r[6].strip(WHITESPACE)) for r in rows] if fmt.trim else [False] * len(rows)
            lead, trail, earlier, later = [], [], own.before, own.after
            for begins, any_ in zip(opens, said):
                earlier = earlier and not begins
                lead.append(not earlier)
                earlier = earlier or any_
            for begins, any_ in zip(reversed(opens), reversed(said)):
                trail.append(not later)
                later = (later or any_) and not begins
            ends = [*opens[1:], not own.continued]
            return [(own.first and i == 0, *m) for i, m in enumerate(zip(ends, lead, reversed(trail)))]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kind["conv_id"], kind["turn"], pa.int32(), *[pa.string()] * 4, *[pa.bool_()] * 4]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        key, part, held, out = None, 0, [], []
        for batch in batches:
            kind = {f.name: f.type for f in batch.schema}
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "part")]
            for conv, turn, role, text, part_ in zip(*columns):
                if held and conv != key:
                    out += conversation(key, part, held)
                    held = []
                    if len(out) >= 4096:
                        yield batch_of(out)
                        out = []
                key, part = conv, part_
                held.append((turn, role, text))
        if held:
            out += conversation(key, part, held)
        if out:
            yield batch_of(out)

    laid = ranged.mapInArrow(
        lay,
        f"conv_id {name}, turn {number}, step int, place string, role string, action string, text string, "
        "begins boolean, ends boolean, lead boolean, trail boolean",
    )
    opened = F.col("place") == "open"
    body = F.concat(F.when(opened, "").otherwise("\n"), F.col("text"))
    if fmt.trim:
        body = F.when(F.col("lead"), F.ltrim(body, F.lit(WHITESPACE))).otherwise(body)
        body = F.when(F.col("trail"), F.rtrim(body, F.lit(WHITESPACE))).otherwise(body)
    rendered = F.concat(
        F.when(F.col("begins"), fmt.bos).otherwise(""),
        F.when(opened, F.concat(F.lit(fmt.role_prefix), "role", F.lit(fmt.role_suffix))).otherwise(""),
        body,
        F.when(F.col("ends"), fmt.eot).otherwise(""),
    )
    return laid.select(*names[:7], rendered.alias("rendered"))
