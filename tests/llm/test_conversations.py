"""Conversation repair against a shortest-path search over whole conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from postlake.llm import conversations as cv
from postlake.llm import queries
from tests.conftest import SF_SMALL, rows

WHITE = " \t\n\x0b\x0c\r"


def _cheapest_by_hand(kinds):
    """(cost, edits) by Dijkstra with the edits as tie-break, over regex states."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, q = heapq.heappop(heap)
        if i == len(kinds) and q in ("", "a"):
            return cost, edits
        if (i, q) in seen:
            continue
        seen.add((i, q))
        for role in "ua":
            if role in steps[q]:
                heapq.heappush(heap, (cost + 3, edits + "I", i, role))
        if i < len(kinds):
            k = kinds[i]
            heapq.heappush(heap, (cost + 4, edits + "D", i + 1, q))
            if k != "d":
                more = 3 if k.isupper() else 0
                if k.lower() in steps[q]:
                    heapq.heappush(heap, (cost + more, edits + "K", i + 1, steps[q][k.lower()]))
                for role in "ua":
                    if role in steps[q]:
                        heapq.heappush(heap, (cost + 3 + more, edits + "R", i + 1, role))


def _damaged_by_hand(data):
    out = []
    for conv, turn, role, text in data:
        sp = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _repaired_by_hand(data, ids):
    out = []
    for conv in ids:
        mine = sorted((r for r in data if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        kinds, seen, faults = "", set(), [0, 0, 0]
        for _, _, role, text in mine:
            body = text.strip(WHITE)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            k = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "d" if fault in (0, 1) else k.upper() if fault == 2 else k
        cost, edits = _cheapest_by_hand(kinds)
        lines, i, q = [], 0, ""
        for e in edits:
            if e in "IR":
                q = "assistant" if q[:1] == "u" else "user"
                lines.append(f"{q}:{mine[i][3] if e == 'R' else ''}")
            elif e == "K":
                q = mine[i][2]
                lines.append(f"{q}:{mine[i][3]}")
            i += e != "I"
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out.append((conv, gaps, *faults, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def _frame(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def test_search_equals_shortest_path():
    rnd = random.Random(1)
    for _ in range(1500):
        kinds = "".join(rnd.choice("suaauuxdSUAX") for _ in range(rnd.randint(0, 9)))
        cost, edits, end = cv.cheapest_edits(kinds)
        assert (cost, edits) == _cheapest_by_hand(kinds), kinds
        assert end in (0, 3)


def test_op13_equals_brute_force(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = rows(queries.op13_conversation_repair(spark, SF_SMALL))
    assert got == _repaired_by_hand(_damaged_by_hand(data), {r[0] for r in data}) and len(got) >= 20


@pytest.mark.parametrize("piece", [3, 16])
def test_long_conversations_are_split_without_a_difference(spark, monkeypatch, piece):
    monkeypatch.setattr(cv, "PIECE", piece)
    rnd = random.Random(piece)
    data = []
    for conv, n in ((1, 70), (2, 1), (3, 25), (4, 0), (None, 9), (6, 4)):
        for turn in range(n):
            data.append((conv, None if rnd.random() < .05 else turn * rnd.choice((1, 1, 2)),
                         rnd.choice(["user", "assistant", "system", "bot", "assistant", "user"]),
                         rnd.choice(["Yes.", f"Text {turn}.", "no end", f"cut {turn}", " \t", "Why?"])))
    frame = _frame(spark, data).repartition(3)
    want = _repaired_by_hand(data, {r[0] for r in data})
    assert rows(cv.repair(frame)) == want
    want = _repaired_by_hand(_damaged_by_hand(data), {r[0] for r in data})
    assert rows(cv.repair_damaged(frame)) == want


def test_odd_rows(spark):
    data = [(1, None, None, None), (1, 5, "", "x."), (2, None, "user", "Hi."), (2, None, "assistant", "Yes!"),
            (3, 0, "user", "Same."), (3, 0, "user", "Same."), (None, 1, "user", "A " * 50_000 + "."), (4, 1, "ünal", "é?")]
    frame = _frame(spark, data).withColumns({c: F.lit(1) for c in ("kind", "ckey", "audit", "piece", "kinds", "left")})
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]
    got = rows(cv.repair(frame))
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:] == (0, 1, 0, 0, 1, 8, "DD", hashlib.sha256(b"").hexdigest())
    assert by_id[3][3] == 1 and got == _repaired_by_hand(clean, {1, 2, 3, 4, None})
    assert rows(cv.repair_damaged(frame)) == _repaired_by_hand(_damaged_by_hand(data), {1, 2, 3, 4, None})
    empty = cv.repair_damaged(frame.limit(0))
    assert empty.count() == 0 and empty.columns[0] == "conv_id"


def test_a_conversation_that_lost_every_row(spark):
    lost = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = _frame(spark, [(lost[0], 0, "user", "Hello.")])
    assert rows(cv.repair_damaged(frame)) == [
        (lost[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_costs_between_states_equal_search():
    rnd = random.Random(4)
    for _ in range(150):
        kinds = "".join(rnd.choice("suaauuxdSUAX") for _ in range(rnd.randint(1, 5)))
        for p in range(4):
            for q in range(4):
                found = cv.cheapest_edits(kinds, p, tuple(0 if e == q else cv._NEVER for e in range(4)), False)
                assert cv._cost(kinds, p, q) == (found[0] if found else cv._NEVER), (kinds, p, q)
