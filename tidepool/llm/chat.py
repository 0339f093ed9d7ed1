"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, ending with the
assistant. Each given turn is kept, relabelled, or merged into the turn before, and empty turns may be put in
front of it; a dynamic program over the automaton's states finds the cheapest way for the whole conversation, which
is then rendered.

A turn acts on the states as a 4 x 4 table of costs, and such tables compose (least sum over the state between), so a
conversation need not lie in one task: turns are dealt out by range, each task composes its turns' tables, the few
conversations that run over a border are settled from those tables, and each task then repairs its own turns
between the states it was given.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import query
from .common import map_rows, table

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # states: the role of the last turn, or none yet
#: Other names that count as a role without a relabel.
NAMES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "assistant": ASSISTANT, "bot": ASSISTANT,
         "gpt": ASSISTANT, "model": ASSISTANT}
MERGE, INSERT, RELABEL, UNNAMED = 1, 2, 3, 1  # costs; UNNAMED: naming a turn whose role is null or unknown
INF = 1 << 40
#: Empty turns that lead from a state to where a role may follow; None: it never may.
_FILL = {(START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): (USER,), (SYSTEM, USER): (), (SYSTEM, ASSISTANT): (USER,),
         (USER, ASSISTANT): (), (USER, USER): (ASSISTANT,), (ASSISTANT, USER): (), (ASSISTANT, ASSISTANT): (USER,)}
_END = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _choices(role: int | None) -> dict[tuple[int, int], tuple[int, str, tuple[int, ...]]]:
    """(state before, state after) -> (cost, action, empty turns put in front) for a turn of a given role."""
    out = {}
    for s, q in product(range(4), (SYSTEM, USER, ASSISTANT)):
        named = 0 if role == q else UNNAMED if role is None else RELABEL
        ways = []
        if (fill := _FILL.get((s, q))) is not None:
            ways.append((named + INSERT * len(fill), "keep" if role == q else "relabel", fill))
        if s == q:
            ways.append((named + MERGE, "merge", ()))
        if ways:
            out[s, q] = min(ways, key=lambda w: w[0])
    return out


CHOICES = {r: _choices(r) for r in (None, SYSTEM, USER, ASSISTANT)}


def role_of(name: str | None) -> int | None:
    return NAMES.get((name or "").strip().lower())


def _advance(costs: list[int], role: int | None) -> tuple[list[int], list[int]]:
    """Least cost of each state after a turn, and the state before it (the first of equals)."""
    after, back = [INF] * 4, [-1] * 4
    for (s, q), (c, _, _) in CHOICES[role].items():
        if costs[s] + c < after[q]:
            after[q], back[q] = costs[s] + c, s
    return after, back


def table_of(roles) -> list[list[int]]:
    """The 4 x 4 cost table of some turns in a row."""
    rows = [[0 if a == b else INF for b in range(4)] for a in range(4)]
    for r in roles:
        rows = [_advance(row, r)[0] for row in rows]
    return rows


def end_cost(state: int) -> int:
    return INSERT * len(_END[state]) if state in _END else INF


def settle(tables: list[list[list[int]]]) -> list[int]:
    """The states between stretches of a whole conversation, START first, at least cost with a legal end."""
    costs, backs = [0, INF, INF, INF], []
    for t in tables:
        after = [min((costs[s] + t[s][q], s) for s in range(4)) for q in range(4)]
        costs = [c for c, _ in after]
        backs.append([s for _, s in after])
    state = min(range(1, 4), key=lambda q: (costs[q] + end_cost(q), -q))
    path = [state]
    for back in reversed(backs):
        path.append(back[path[-1]])
    return path[::-1]


def repair(roles: list[int | None], before: int = START, after: int | None = None) -> list[tuple[int, str, tuple[int, ...]]]:
    """(role, action, empty turns in front) for each turn, at least cost between two states (None: a legal end)."""
    costs, backs = [INF] * 4, []
    costs[before] = 0
    for r in roles:
        costs, back = _advance(costs, r)
        backs.append(back)
    state = after if after is not None else min(range(1, 4), key=lambda q: (costs[q] + end_cost(q), -q))
    out = []
    for r, back in zip(reversed(roles), reversed(backs)):
        s = back[state]
        out.append((state, *CHOICES[r][s, state][1:]))
        state = s
    return out[::-1]


def _empty(role: int) -> str:
    return f"<|im_start|>{ROLES[role - 1]}\n<|im_end|>\n"


def _stretches(rows):
    """(conversation, its rows in this task) in order."""
    now, held = None, []
    for r in rows:
        if held and r[1] != now:
            yield now, held
            held = []
        now = r[1]
        held.append(r)
    if held:
        yield now, held


def _borders(rows):
    """Cost tables of the first and the last conversation of a task: at most two rows."""
    first = last = None
    for conv, held in _stretches(rows):
        part = held[0][0]
        last = (part, conv, len(held), sum(table_of(role_of(r[3]) for r in held), []))
        if first is None:
            first = last
            yield first
    if last is not None and last is not first:
        yield last


def repaired_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, turn, seq, role, new_role, action, inserted, piece) for each given turn.

    Turns are taken in order of (turn, role, text), nulls first; repeated turns are all taken. A null conversation
    id is an id like any other, a null role is unnamed, a null text empty. seq counts a conversation's turns
    from 0, inserted lists the roles of empty turns put in front, and the pieces of a conversation in order of seq,
    set one after the other, are its rendered text. An empty table gives an empty one; other columns are not
    looked at.

    Only what lies on the borders of tasks, at most two cost tables a task, comes to the driver.
    """
    kind, turn_kind = turns.schema[conv_col].dataType.simpleString(), turns.schema[turn_col].dataType.simpleString()
    picked = turns.select(*(F.col(f"`{c}`").alias(n) for c, n in zip((conv_col, turn_col, role_col, text_col), ("conv", "turn", "role", "text"))))
    picked = picked.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    keys = ["conv", "turn", "role", "h", "text", "row"]  # row only deals out rows that are equal in all else
    spread = picked.repartitionByRange("conv", "turn", "role", "h", "row").sortWithinPartitions("conv", "turn", "role", "h", "row")
    spread = cut_lineage(spread.select(F.spark_partition_id().alias("part"), *(k for k in keys if k not in ("h", "row"))))
    found = map_rows(spread.select("part", "conv", "turn", "role"), _borders,
                     f"part int, conv {kind}, n bigint, costs array<bigint>").collect()

    split: dict = {}
    for r in sorted(found, key=lambda r: r["part"]):
        split.setdefault(r["conv"], {})[r["part"]] = r
    given = {}  # (part, conversation) -> state before, state after, turns before, whether more follows
    for conv, parts in split.items():
        if len(parts) > 1:
            order = sorted(parts)
            states = settle([[list(parts[p]["costs"][4 * i : 4 * i + 4]) for i in range(4)] for p in order])
            seen = 0
            for k, p in enumerate(order):
                given[p, conv] = (states[k], states[k + 1], seen, k + 1 < len(order))
                seen += parts[p]["n"]

    def run(rows):
        for conv, held in _stretches(rows):
            before, after, seq, more = given.get((held[0][0], conv), (START, None, 0, False))
            steps = repair([role_of(r[3]) for r in held], before, after)
            for k, ((_, _, turn, role, text), (state, action, fill)) in enumerate(zip(held, steps)):
                first = seq + k == 0
                if action == "merge":
                    piece = "\n" + (text or "")
                else:
                    piece = ("" if first else "<|im_end|>\n") + "".join(map(_empty, fill))
                    piece += f"<|im_start|>{ROLES[state - 1]}\n{text or ''}"
                if k + 1 == len(held) and not more:
                    piece += "<|im_end|>\n" + "".join(map(_empty, _END[state]))
                yield conv, turn, seq + k, role, ROLES[state - 1], action, [ROLES[f - 1] for f in fill], piece

    return map_rows(spread, run, f"`{conv_col}` {kind}, `{turn_col}` {turn_kind}, seq bigint, role string, new_role string, "
                    "action string, inserted array<string>, piece string")


@query("op5_chat_role_repair")
def op5_chat_role_repair(spark, sf_dir):
    """Every turn of conversations, repaired and rendered."""
    return repaired_turns(table(spark, sf_dir, "conversations"))
