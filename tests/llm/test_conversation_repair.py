"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from rankloom.llm import conversation_repair as cr
from rankloom.llm.queries.conversation_repair_query import op11_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, present_ string, has_turn int, audit string"
_NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    """Rows of one conversation as the contract damages them."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def expected(rows):
    """Faults, then the least ``(cost, audit)`` over all ways from each row on."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def least(i, state, inserts):
        """Best ``(cost, audit, repaired lines)`` of rows ``i…`` behind a role with that initial."""
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            to = _NEXT[state]
            rest = least(i, to, inserts + 1)
            if rest:
                ways.append((3 + rest[0], "I" + rest[1], (f"{'user' if to == 'u' else 'assistant'}:", *rest[2])))
        if i < len(rows):
            _, role, text = rows[i]
            moves = [("D", state, 4, ())]
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                first = role[:1]
                if first and (first == _NEXT[state] or (first == "s" and state == "")):
                    moves.append(("K", first, more, (f"{role}:{text}",)))
                moves.append(("R", _NEXT[state], 3 + more, (f"{'user' if _NEXT[state] == 'u' else 'assistant'}:{text}",)))
            for letter, to, cost, lines in moves:
                rest = least(i + 1, to, 0)
                if rest:
                    ways.append((cost + rest[0], letter + rest[1], lines + rest[2]))
        return min(ways, key=lambda w: w[:2]) if ways else None

    turns = [r[0] for r in rows if r[0] is not None]
    pairs = ["".join((a[1][:1], b[1][:1])) for a, b in zip(rows, rows[1:])]
    cost, audit, lines = least(0, "", 0)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), list(lines)


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def random_rows():
    rnd = random.Random(11)
    roles = ["system", "user", "assistant", "tool", "", None, "u", "User"]
    texts = ["Hello.", "Is it so?", "cut off", "", " \n", None, "Hello.", "é!", "x" * 30_000 + "."]
    rows = []
    for conv in [None, *range(1, 120)]:
        for t in range(rnd.randint(1, 9)):
            turn = None if rnd.random() < 0.05 else t + 3 * (rnd.random() < 0.1)
            weights = [2, 6, 6, 1, 0.3, 0.3, 0.5, 0.3]
            rows.append((conv, turn, rnd.choices(roles, weights)[0], rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("spill", [1, 1 << 20])
def test_equal_to_search_over_all_edits(spark, spill):
    rows = random_rows()
    frame = spark.createDataFrame([(*r, "c", "p", 1, "a") for r in rows], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair_report(cr.damage(frame), spill_rows=spill).collect()}
    groups = by_conversation(rows)
    assert got.keys() == groups.keys()
    for conv, some in groups.items():
        assert got[conv] == expected(damaged(some))[0], conv


def test_repaired_rows_give_the_hash(spark):
    rows = random_rows()
    frame = cr.damage(spark.createDataFrame([(*r, "c", "p", 1, "a") for r in rows], SCHEMA))
    report = cr.repair_report(frame)
    lines = {}
    for r in sorted(cr.repaired_turns(frame, report).collect(), key=lambda r: r.position):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, some in by_conversation(rows).items():
        assert lines.get(conv, []) == expected(damaged(some))[1], conv


def test_given_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in op11_conversation_repair(spark, sf_dir).collect()}
    assert got == {conv: expected(damaged(some))[0] for conv, some in by_conversation(rows).items()}


def test_long_conversation_spills_and_leaves_nothing(spark):
    from rankloom.session import shared_dir
    import glob

    rows = [(7, t, "user" if t % 3 else "assistant", f"number {t}.") for t in range(5000)]
    got = cr.repair_report(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), spill_rows=100).collect()
    want, _ = expected_iterative(rows)
    assert [tuple(r)[1:] for r in got] == [want]
    assert not [f for f in glob.glob(shared_dir(spark).removeprefix("file:") + "/backpointers-*/*")]


def expected_iterative(rows):
    """As ``expected`` for rows without faults, from the last row to the first."""
    ahead = {"": (0, "", ()), "a": (0, "", ())}

    def close(states):
        for _ in range(2):
            for s in ("", "s", "u", "a"):
                if (rest := states.get(_NEXT[s])) is not None:
                    way = (3 + rest[0], "I" + rest[1], (("user:" if _NEXT[s] == "u" else "assistant:"), rest[2]))
                    states[s] = min([states[s], way], key=lambda w: w[:2]) if s in states else way
        return states

    ahead = close(ahead)
    for _, _, role, text in reversed(rows):
        here = {}
        for s in ("", "s", "u", "a"):
            ways = [(4 + ahead[s][0], "D" + ahead[s][1], ahead[s][2])] if s in ahead else []
            if role[0] == _NEXT[s] and role[0] in ahead:
                rest = ahead[role[0]]
                ways.append((rest[0], "K" + rest[1], (f"{role}:{text}", rest[2])))
            if _NEXT[s] in ahead:
                rest = ahead[_NEXT[s]]
                ways.append((3 + rest[0], "R" + rest[1], (("user:" if _NEXT[s] == "u" else "assistant:") + text, rest[2])))
            if ways:
                here[s] = min(ways, key=lambda w: w[:2])
        ahead = close(here)
    cost, audit, chain = ahead[""]
    lines = []
    while chain:
        lines.append(chain[0])
        chain = chain[1]
    roles = [r[2][0] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    return (0, 0, 0, 0, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def test_dropped_and_empty(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(5, dropped, "user", "gone.")], "conv_id long, turn long, role string, text string")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    damaged_rows = cr.damage(one)
    assert [tuple(r) for r in cr.repair_report(damaged_rows).collect()] == [(5, *nothing)]
    assert cr.repaired_turns(damaged_rows, cr.repair_report(damaged_rows)).count() == 0
    assert cr.repair_report(cr.damage(one.where("false"))).count() == 0
