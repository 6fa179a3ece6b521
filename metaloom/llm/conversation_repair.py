"""Conversation structure repair by divide and conquer over a four-state cost vector.

A repaired conversation is empty, or an optional system turn followed by pairs of user and assistant. Reading the roles
so far, it is in one of four states: nothing yet, after the system turn, after a user turn, after an assistant turn.
Every row is a step between states, and a run of rows is a step again, so a conversation that spans many partitions is
solved from one small summary of each piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from metaloom.operators.joins import skew_safe_join
from metaloom.session import stage

START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: Costs of edits; keeping is free, and a truncated row costs more unless it is deleted.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: Characters that leave a text blank.
BLANKS = "\x20\x09\x0A\x0B\x0C\x0D"
#: Faults of a row.
SOUND, CUT_SHORT, MUST_GO = range(3)
INITIALS = "sua"
LEGAL = frozenset({(0, 1), (1, 2), (2, 1)})
_FAR = 1 << 60
#: For each state entered, the states it can leave in: state, cost, place among the entry's audits in ASCII order.
Step = tuple[tuple[tuple[int, int, int], ...], ...]


def _after(state: int, role: int) -> int | None:
    """The state after a turn of ``role`` (0 system, 1 user, 2 assistant), if it may follow."""
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return None if state == USER else USER
    return ASSISTANT if state == USER else None


def _inserted(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _moves(initial: int, fault: int) -> list[dict[int, tuple[int, str]]]:
    """For each state, the cheapest edits of one row to each next state; of equal costs the least in ASCII.

    Insertions stand before the row they make fit. A row that goes moves no state: turns inserted before it may as
    well be inserted after it, which comes first in ASCII.
    """
    found = []
    for state in range(4):
        best = {state: (DELETE_COST, DELETE)}
        here, cost, audit = state, TRUNCATED_COST * (fault == CUT_SHORT), ""
        for _ in range(3 if fault != MUST_GO else 0):
            for letter, role, more in ((KEEP, initial, 0), (REROLE, 1, REROLE_COST), (REROLE, 2, REROLE_COST)):
                to = _after(here, role) if role < 3 else None
                if to is not None:
                    best[to] = min(best.get(to, (_FAR, "")), (cost + more, audit + letter))
            here, cost, audit = _inserted(here), cost + INSERT_COST, audit + INSERT
        found.append(best)
    return found


#: By code of a row, 3 * initial + fault (initials: s, u, a, any other).
MOVES = [_moves(initial, fault) for initial in range(4) for fault in range(3)]


def _step(best: list[dict[int, tuple[int, str]]]) -> Step:
    return tuple(
        tuple((to, found[to][0], at) for at, to in enumerate(sorted(found, key=lambda to: found[to][1]))) for found in best
    )


STEPS = [_step(best) for best in MOVES]
#: Turns to insert at the end, by state.
TAIL = (0, 2, 1, 0)


def _gone(copies: int) -> Step:
    return tuple(((state, DELETE_COST * copies, 0),) for state in range(4))


def _forward(steps: list[Step], lo: int, hi: int, entry: int) -> tuple[list[int], list[int]]:
    """Least cost of each state after the steps, and the states reached, in ASCII order of their best audits.

    Audits of different states end in different edits of the same last row, so none is the beginning of another
    and their order decides, whatever follows.
    """
    cost, order = [_FAR] * 4, [entry]
    cost[entry] = 0
    for step in steps[lo:hi]:
        new, key = [_FAR] * 4, [(0, 0)] * 4
        for at, state in enumerate(order):
            base = cost[state]
            for to, more, place in step[state]:
                if base + more < new[to]:
                    new[to], key[to] = base + more, (at, place)
        cost, order = new, sorted((s for s in range(4) if new[s] < _FAR), key=key.__getitem__)
    return cost, order


def _backward(steps: list[Step], lo: int, hi: int, exit_: int) -> list[int]:
    """Least cost from each state before the steps to ``exit_`` after them."""
    cost = [_FAR] * 4
    cost[exit_] = 0
    for step in reversed(steps[lo:hi]):
        cost = [min((more + cost[to] for to, more, _ in step[s]), default=_FAR) for s in range(4)]
    return cost


def crossings(steps: list[Step], entry: int, exit_: int) -> list[int]:
    """The states between and around the steps on the cheapest way, of equal ways on the one whose audit is the least.

    Forward and backward costs meet in the middle; of the cheapest states there, the way goes through the one whose
    audit so far is the least, and both halves are solved alike. Only the states are kept, so space is linear.
    """
    states = [entry] * (len(steps) + 1)
    states[-1] = exit_
    todo = [(0, len(steps))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        middle = (lo + hi) // 2
        cost, order = _forward(steps, lo, middle, states[lo])
        rest = _backward(steps, middle, hi, states[hi])
        states[middle] = min(order, key=lambda s: cost[s] + rest[s])  # the first of equal ones
        todo += [(lo, middle), (middle, hi)]
    return states


def summary(steps: list[Step]) -> Step:
    """Many steps as one."""
    found = []
    for entry in range(4):
        cost, order = _forward(steps, 0, len(steps), entry)
        found.append(tuple((s, cost[s], at) for at, s in enumerate(order)))
    return tuple(found)


def _expanded(codes: list[int], copies: list[int]) -> tuple[list[Step], list[int]]:
    """The steps of rows with copies, and where each row's own step is: later copies go."""
    steps, own = [], []
    for code, n in zip(codes, copies, strict=True):
        must = code % 3 == MUST_GO
        own.append(len(steps))
        steps.append(_gone(n) if must else STEPS[code])
        if n > 1 and not must:
            steps.append(_gone(n - 1))
    return steps, own


@dataclass
class Repaired:
    """``rows``: ``conv_id, at, sub, turn, role, text, edit`` of the repaired conversations, in the order of ``at, sub``.
    ``summaries``: one row a conversation with rows: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.
    """

    rows: DataFrame
    summaries: DataFrame


def _classified(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and a code. A digest of role and text finds those seen at an earlier turn."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    key = F.md5(F.to_json(F.struct(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.md5("text").alias("t"))))
    rows = rows.withColumn("digest", key)
    seen = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    first = rows.groupBy("digest").agg(F.min(seen).alias("first"), F.count("*").alias("n")).filter("n > 1")
    joined = skew_safe_join(rows, first.select("digest", "first"), ["digest"], "left")
    trimmed = F.rtrim("text", F.lit(BLANKS))
    again = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    ends = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    kind = F.when(trimmed == "", "blank").when(again, "duplicate").when(~ends, "truncated").otherwise("sound")
    initial = F.coalesce(
        F.create_map(*chain.from_iterable((F.lit(c), F.lit(i)) for i, c in enumerate(INITIALS)))[F.substring("role", 1, 1)],
        F.lit(3),
    )
    fault = F.when(F.col("kind").isin("blank", "duplicate"), MUST_GO).when(F.col("kind") == "truncated", CUT_SHORT).otherwise(SOUND)
    return (
        joined.withColumn("kind", kind)
        .withColumn("code", (initial * 3 + fault).cast("int"))
        .select("conv_id", "turn", "role", "text", "copies", "kind", "code")
    )


_STEP = pa.list_(pa.list_(pa.struct([("to", pa.int32()), ("cost", pa.int64()), ("place", pa.int32())])))
_STEP_DDL = "array<array<struct<to:int,cost:long,place:int>>>"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece: its summary, first and last initial, and neighbours that may not follow each other."""
    for batch in batches:
        step, first, last, illegal = [], [], [], []
        for rows in batch.column("rows").to_pylist():
            codes, copies = [r["code"] for r in rows], [r["copies"] for r in rows]
            roles = [c // 3 for c in codes]
            step.append([[dict(zip(("to", "cost", "place"), x, strict=True)) for x in s] for s in summary(_expanded(codes, copies)[0])])
            first.append(roles[0])
            last.append(roles[-1])
            illegal.append(sum(copies) - len(copies) + sum(x not in LEGAL for x in zip(roles, roles[1:])))
        arrays = [
            *(batch.column(c) for c in ("conv_id", "piece")),
            pa.array(step, _STEP),
            pa.array(first, pa.int32()),
            pa.array(last, pa.int32()),
            pa.array(illegal, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "piece", "step", "first", "last", "illegal"])


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation: cost, illegal neighbours, and the states around each of its pieces."""
    for batch in batches:
        cost, illegal, ways = [], [], []
        for pieces in batch.column("pieces").to_pylist():
            steps = [tuple(tuple((x["to"], x["cost"], x["place"]) for x in s) for s in p["step"]) for p in pieces]
            reached, order = _forward(steps, 0, len(steps), START)
            end = min(order, key=lambda s: reached[s] + INSERT_COST * TAIL[s])
            states = crossings(steps, START, end)
            tails = [0] * (len(pieces) - 1) + [TAIL[end]]
            cost.append(reached[end] + INSERT_COST * TAIL[end])
            between = sum((a["last"], b["first"]) not in LEGAL for a, b in zip(pieces, pieces[1:]))
            illegal.append(between + sum(p["illegal"] for p in pieces))
            ways.append(
                [
                    {"piece": p["piece"], "entry": e, "leave": x, "tail": t}
                    for p, e, x, t in zip(pieces, states, states[1:], tails, strict=False)
                ]
            )
        arrays = [batch.column("conv_id"), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64()), pa.array(ways, _WAYS)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "cost", "illegal", "ways"])


_WAYS = pa.list_(pa.struct([("piece", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32()), ("tail", pa.int32())]))
_WAYS_DDL = "array<struct<piece:long,entry:int,leave:int,tail:int>>"
_EDITS = pa.list_(pa.struct([("at", pa.int64()), ("sub", pa.int32()), ("edit", pa.string()), ("role", pa.string())]))
_EDITS_DDL = "array<struct<at:long,sub:int,edit:string,role:string>>"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each piece: its part of the audit, and every edit that is not a keep."""

    def insert(state: int, n: int, at: int, sub: int) -> Iterator[tuple[dict, int]]:
        for i in range(n):
            state = _inserted(state)
            yield {"at": at, "sub": sub + i, "edit": INSERT, "role": "user" if state == USER else "assistant"}, state

    for batch in batches:
        audits, edits = [], []
        columns = (batch.column(c).to_pylist() for c in ("rows", "entry", "leave", "tail"))
        for rows, entry, leave, tail in zip(*columns, strict=True):
            codes, copies = [r["code"] for r in rows], [r["copies"] for r in rows]
            steps, own = _expanded(codes, copies)
            states = crossings(steps, entry, leave)
            audit, changed = [], []
            for row, code, n, place in zip(rows, codes, copies, own, strict=True):
                state, to = states[place], states[place + 1]
                letters = MOVES[code][state][to][1]
                audit.append(letters + DELETE * (n - 1))
                more = len(letters) - 1
                changed += [x for x, _ in insert(state, more, row["at"], -more)]
                if letters[-1] != KEEP:
                    role = "user" if to == USER else "assistant"
                    changed.append({"at": row["at"], "sub": 0, "edit": letters[-1], "role": role if letters[-1] == REROLE else None})
            audit.append(INSERT * tail)
            changed += [x for x, _ in insert(leave, tail, rows[-1]["at"], 1)]
            audits.append("".join(audit))
            edits.append(changed)
        arrays = [batch.column("conv_id"), batch.column("piece"), pa.array(audits, pa.string()), pa.array(edits, _EDITS)]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "piece", "audit", "edits"])


def _field_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def repair_conversations(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repaired:
    """The cheapest edits that give every conversation the role initials ``(s?(ua)+)?``.

    Rows stand in the order of turn (nulls first), role and text. The first fault of a row counts: blank (no character
    ``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier in the conversation), truncated (the last such
    character is none of ``.!?``). Keep costs 0, rerole to user or assistant 1, delete 2, which blank and duplicate rows
    must be, and insert an empty user or assistant turn 5; a truncated row that stays costs 5. Of equally cheap audits
    (the edits' initials in order) the least in ASCII is taken; an audit determines the repaired conversation.

    Copies of a row are counted before anything is sorted. Rows are dealt by ranges of conversation and place, so a
    conversation may span any number of partitions: what a partition holds of it is a piece, a piece is summarised as
    one step between four states, and the states between pieces are found first (``crossings``), then those within.
    Only codes of a piece's rows, a few bytes each, and one summary for each piece are gathered; texts are not.

    Null roles and texts count as one space. A null turn comes first and takes no part in ``gaps``; null conversation
    ids are one conversation. Rows repeated exactly are copies, of which the first may stay. A role counts by its first
    character. ``gaps`` and costs beyond 64 bits are null. An empty table gives no rows; other columns are ignored. The
    four columns must not be of the same name.
    """
    named = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    kind = _field_type(named, "conv_id")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    dealt = _classified(named).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(dealt.withColumn("at", F.monotonically_increasing_id()), "turns")

    part = F.shiftright("at", 33).alias("part")
    held = F.sort_array(F.collect_list(F.struct("at", "code", "copies"))).alias("rows")
    pieces = rows.groupBy("conv_id", part).agg(F.min("at").alias("piece"), held).select("conv_id", "piece", "rows")
    pieces = stage(pieces, "pieces")
    steps = pieces.mapInArrow(
        _summaries, f"conv_id {kind}, piece long, step {_STEP_DDL}, first int, last int, illegal long"
    )
    whole = steps.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("piece", "step", "first", "last", "illegal"))).alias("pieces")
    )
    crossed = stage(whole.mapInArrow(_crossed, f"conv_id {kind}, cost long, illegal long, ways {_WAYS_DDL}"), "crossings")
    ways = crossed.select(F.inline("ways"))
    solved = pieces.join(ways, "piece").select("conv_id", "piece", "rows", "entry", "leave", "tail")
    solved = stage(solved.mapInArrow(_edits, f"conv_id {kind}, piece long, audit string, edits {_EDITS_DDL}"), "edits")

    audits = solved.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("piece", "audit"))).alias("parts"))
    audits = audits.select("conv_id", F.concat_ws("", F.col("parts.audit")).alias("audit"))
    summaries = _counted(rows).unionByName(crossed.select("conv_id", "cost", "illegal"), allowMissingColumns=True)
    summaries = summaries.unionByName(audits, allowMissingColumns=True).groupBy("conv_id")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repaired(_repaired(rows, solved), summaries.agg(*(F.max(c).alias(c) for c in counts)))


def _counted(rows: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation; only a row's first copy can be truncated."""

    def total(kind: str) -> Column:
        n = F.when(F.col("kind") == kind, F.col("copies"))
        if kind == "duplicate":
            n = F.coalesce(n, F.when(F.col("kind") != "blank", F.col("copies") - 1))
        elif kind == "truncated":
            n = F.when(F.col("kind") == kind, F.lit(1))
        return F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(kind)

    one = F.lit(1).cast("long")
    gaps = F.try_subtract(F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), one), F.count_distinct("turn"))
    gaps = F.when(F.count("turn") == 0, F.lit(0).cast("long")).otherwise(gaps)
    return rows.groupBy("conv_id").agg(gaps.alias("gaps"), *(total(k) for k in ("blank", "duplicate", "truncated")))


def _repaired(rows: DataFrame, solved: DataFrame) -> DataFrame:
    edits = solved.select("conv_id", F.inline("edits")).withColumnRenamed("role", "new_role")
    changed = edits.filter("sub = 0").select("at", "edit", "new_role")
    stayed = skew_safe_join(rows.select("conv_id", "at", "turn", "role", "text"), changed, ["at"], "left")
    stayed = stayed.filter(F.coalesce(F.col("edit"), F.lit(KEEP)) != DELETE).select(
        "conv_id",
        "at",
        F.lit(0).alias("sub"),
        "turn",
        F.coalesce("new_role", "role").alias("role"),
        "text",
        F.coalesce("edit", F.lit(KEEP)).alias("edit"),
    )
    inserted = edits.filter("sub != 0").select(
        "conv_id", "at", "sub", F.lit(None).cast("long").alias("turn"), F.col("new_role").alias("role"), F.lit("").alias("text"), "edit"
    )
    return stayed.unionByName(inserted)
