"""Conversation repair against every possible edit, and against a plain dynamic program over several partitions."""

import hashlib
import itertools
import random
import re

import pytest

from metaloom.llm.conversation_repair import MOVES, START, STEPS, TAIL, _forward, crossings, repair_conversations, summary
from metaloom.llm.queries import _joined_hash

SCHEMA = "conv_id long, turn long, role string, text string, at string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")
BLANKS = " \t\n\x0b\x0c\r"


def faults(rows):
    """Initial and fault of each row in order."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANKS)[-1:]
        kind = "blank" if not end else "duplicate" if (role, text) in seen else "sound" if end in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role[:1], kind))
    return out


def edits(marked, most_inserts):
    """Every sequence of edits: cost, audit, role initials."""
    own = []
    for initial, kind in marked:
        stays = 5 * (kind == "truncated")
        choices = [("D", 2, "")]
        if kind in ("sound", "truncated"):
            choices += [("K", stays, initial), ("R", stays + 1, "u"), ("R", stays + 1, "a")]
        own.append(choices)
    inserts = [c for n in range(most_inserts + 1) for c in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*own):
        for gaps in itertools.product(inserts, repeat=len(marked) + 1):
            cost = sum(c[1] for c in chosen) + 5 * sum(map(len, gaps))
            audit = "".join("I" * len(g) + c[0] for g, c in zip(gaps, chosen)) + "I" * len(gaps[-1])
            yield cost, audit, "".join("".join(g) + c[2] for g, c in zip(gaps, chosen)) + "".join(gaps[-1])


def plain(marked):
    """The least cost and audit by a table over all rows: states are what the initials so far end with."""
    following = {"": "su", "s": "u", "u": "a", "a": "u"}

    def close(best):
        for _ in range(2):
            for state, (cost, audit) in list(best.items()):
                to = "a" if state == "u" else "u"
                best[to] = min(best.get(to, (10**9, "")), (cost + 5, audit + "I"))
        return best

    best = {"": (0, "")}
    for initial, kind in marked:
        new = {}
        for state, (cost, audit) in best.items():
            new[state] = min(new.get(state, (10**9, "")), (cost + 2, audit + "D"))
        for state, (cost, audit) in close(dict(best)).items():
            for letter, role, more in (("K", initial, 0), ("R", "u", 1), ("R", "a", 1)):
                if kind in ("sound", "truncated") and role and role in following[state]:
                    found = (cost + more + 5 * (kind == "truncated"), audit + letter)
                    new[role] = min(new.get(role, (10**9, "")), found)
        best = new
    best = close(best)
    return min(best[s] for s in ("", "a") if s in best)


def codes(marked):
    number = {"blank": 2, "duplicate": 2, "truncated": 1, "sound": 0}
    return [("sua".index(i) if i and i in "sua" else 3) * 3 + number[k] for i, k in marked]


def solved(marked):
    own = codes(marked)
    steps = [STEPS[c] for c in own]
    cost, order = _forward(steps, 0, len(steps), START)
    end = min(order, key=lambda s: cost[s] + 5 * TAIL[s])
    states = crossings(steps, START, end)
    audit = "".join(MOVES[c][a][b][1] for c, a, b in zip(own, states, states[1:])) + "I" * TAIL[end]
    return cost[end] + 5 * TAIL[end], audit


def some(rng, n):
    return [(rng.choice("suuaat"), rng.choice(["sound"] * 4 + ["truncated", "blank", "duplicate"])) for _ in range(n)]


@pytest.mark.parametrize("n", range(4))
def test_against_all_edits(n):
    rng = random.Random(n)
    for _ in range(40 if n < 3 else 12):
        marked = some(rng, n)
        want = min((c, a) for c, a, roles in edits(marked, 2) if LEGAL.match(roles))
        assert solved(marked) == want == plain(marked), marked


def test_against_the_plain_table():
    rng = random.Random(7)
    for n in (5, 17, 64, 301):
        for _ in range(20):
            marked = some(rng, n)
            assert solved(marked) == plain(marked)


def test_summaries_compose():
    rng = random.Random(3)
    for _ in range(30):
        steps = [STEPS[c] for c in codes(some(rng, 24))]
        cuts = [0, *sorted(rng.sample(range(1, 24), 3)), 24]
        pieces = [summary(steps[a:b]) for a, b in zip(cuts, cuts[1:])]
        assert _forward(pieces, 0, 4, START) == _forward(steps, 0, 24, START)
        end = _forward(steps, 0, 24, START)[1][0]
        whole = crossings(steps, START, end)
        assert crossings(pieces, START, end) == [whole[c] for c in cuts]


def brute(rows):
    """Summary and repaired text of one conversation."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    marked = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit = plain(marked)
    left, out, systems = list(rows), [], 0
    for letter in audit:
        row = left.pop(0) if letter != "I" else None
        role = ("user", "assistant")[(len(out) - systems) % 2]
        if letter == "K":
            systems += row[1][:1] == "s"
            role = row[1]
        if letter != "D":
            out.append(f"{role}:{row[2] if row else ''}")
    pairs = list(zip(marked, marked[1:]))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(sum(k == kind for _, k in marked) for kind in ("blank", "duplicate", "truncated")),
        sum(a[0] + b[0] not in ("su", "ua", "au") or not a[0] or not b[0] for a, b in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def conversations():
    rng = random.Random(11)
    texts = ["One.", "Two!", "Three?  \n", "cut", "", " \t", None, "Ja. é", "x" * 200_000 + "."]
    rows = []
    for conv in (None, 1, 2, 3):
        for _ in range(3 + 5 * (conv or 0)):
            turn = rng.choice([None, *range(-2, 12)])
            rows.append((conv, turn, rng.choice(["system", "user", "user", "assistant", "tool", "", None]), rng.choice(texts), "x"))
    hot = [(9, t // 2, ("user", "assistant")[t % 2], f"{t}." if t % 7 else "same.", "x") for t in range(400)]
    return rows + rows[:6] + hot + [(9, 5, "user", "again and again.", "x")] * 300 + [(8, None, None, None, None)]


@pytest.mark.parametrize("spread", ["false", "true"])
def test_operator(spark, conf, spread):
    conf(**{"spark__sql__adaptive__coalescePartitions__enabled": spread, "spark__sql__shuffle__partitions": "7"})
    rows = conversations()
    found = repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    ordered = found.rows.repartition("conv_id").sortWithinPartitions("conv_id", "at", "sub")
    hashes = ordered.select("conv_id", "role", "text").mapInArrow(_joined_hash, "conv_id long, repaired_sha256 string")
    digests = {r[0]: r[1] for r in hashes.collect()}
    got = {r[0]: (*r[1:], digests.get(r[0], hashlib.sha256().hexdigest())) for r in found.summaries.collect()}
    want = {c: brute([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_no_rows(spark):
    found = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert found.summaries.count() == 0 and found.rows.count() == 0
    far = [(1, -(2**63), "user", "A.", ""), (1, 2**63 - 1, "assistant", "B.", "")]
    row = repair_conversations(spark.createDataFrame(far, SCHEMA)).summaries.first()
    assert row["gaps"] is None and row["audit"] == "KK"
