"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from rosterforge.llm import turn_repair

OF = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """The damage, row by row."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """Dijkstra over (row, role initials so far by state): least cost, then least audit."""
    # the pattern's state is told from the initials written so far: '', 's', ...'u', ...'a'
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for role in ("user", "assistant"):
            if role[0] in allowed:
                heapq.heappush(queue, (cost + 3, audit + "I", i, role[0], (*lines, f"{role}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                if role[:1] and role[:1] in allowed:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if new[0] in allowed:
                        heapq.heappush(queue, (cost + more + 3, audit + "R", i + 1, new[0], (*lines, f"{new}:{text}")))
    raise AssertionError("no way")


def brute(rows):
    after = damaged(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(after.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in own:
            worth = text.strip(" \t\n\v\f\r")
            if not worth:
                faults.append("blank")
            elif (role, text) in seen:
                faults.append("duplicate")
            elif worth[-1] not in ".!?":
                faults.append("truncated")
            else:
                faults.append("")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = cheapest(own, faults)
        out[conv] = (
            conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def made_rows(seed, conversations=60, longest=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = rng.choice([0, 3, None])
        for k in range(rng.randint(1, longest)):
            role = rng.choices(["user", "assistant", "system", "tool", None, "", "ubot"], [8, 8, 3, 1, 1, 1, 1])[0]
            if rng.random() < 0.6:
                role = ("user", "assistant")[k % 2]
            text = rng.choice(["Yes.", "No!", "and so", " ", "", None, "Why?\n ", "Well. ", f"line {k}.", f"line {k}", "é中."])
            rows.append((conv, turn, role, text))
            turn = rng.choice([None, None, 5]) if turn is None else turn + rng.choice([1, 1, 1, 2, 0])
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hello."), (None, None, None, None)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, codes string, `a.b` int"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_report_equals_the_search(spark, chunk_rows):
    rows = made_rows(chunk_rows)
    given = frame(spark, rows)
    found = {r.conv_id: tuple(r) for r in turn_repair.report(turn_repair.damage(given), given, chunk_rows).collect()}
    assert found == brute(rows)


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", f"t {t}.", f"t {t}"])) for t in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hello.")]
    given = frame(spark, rows, 8)
    found = {r.conv_id: tuple(r) for r in turn_repair.report(turn_repair.damage(given), given, 64).collect()}
    assert found == brute(rows)


def test_fix_up_stops_where_vectors_differ_by_a_constant():
    rng = random.Random(1)
    for _ in range(300):
        codes = bytes(rng.choice([1, 2, 3, 10, 11, 4, 18, 0]) for _ in range(rng.randint(0, 30)))
        old, new = ((tuple(rng.randint(0, 3) for _ in range(3)) + (0,)) for _ in range(2))
        vectors, total = turn_repair.solve(codes, old)
        wanted, whole = turn_repair.solve(codes, new)
        assert turn_repair.fix_up(codes, old, new, vectors[0], total) == (wanted[0], whole)


def test_turns_are_whole_and_in_order(spark):
    rows = made_rows(9)
    given = frame(spark, rows)
    expected = brute(rows)
    turns = defaultdict(list)
    for row in turn_repair.edited(turn_repair.damage(given), 2).orderBy("conv_id", "chunk").collect():
        turns[row.conv_id] += zip(row.roles, row.texts, strict=True)
    for conv, lines in turns.items():
        assert OF.fullmatch("".join(r[:1] for r, _ in lines))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest() == expected[conv][-1]


def test_empty_table(spark):
    given = frame(spark, [], 1)
    assert turn_repair.report(turn_repair.damage(given), given).collect() == []
