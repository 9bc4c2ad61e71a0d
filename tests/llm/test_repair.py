"""Structure repair: exhaustive search of short conversations, prices against a plain shortest path, awkward tables."""

import hashlib
import heapq
import itertools
import random
import re

import pytest

from visitlake.llm import repair

from helpers import agrees_with_sql

TURNS = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def kind(role, fault):
    return repair._KINDS[repair.FAULTS.index(fault) * 4 + repair.ROLES.index(role)]


def search(rows):
    """Least (cost, edits) by trying all edits, with up to two turns inserted at a place."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    own = []
    for role, fault in rows:
        late = 5 * (fault == "truncated")
        ways = [("D", 2, "")]
        if fault in ("", "truncated"):
            ways += [("K", late, role), ("R", late + 1, "u"), ("R", late + 1, "a")]
        own.append(ways)
    for ways in itertools.product(*own):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            roles, edits, cost = gaps[0], "I" * len(gaps[0]), 5 * len(gaps[0])
            for (letter, price, role), gap in zip(ways, gaps[1:]):
                roles, edits, cost = roles + role + gap, edits + letter + "I" * len(gap), cost + price + 5 * len(gap)
            if LEGAL.fullmatch(roles) and (best is None or (cost, edits) < best):
                best = (cost, edits)
    return best


def test_repairs_are_the_cheapest_and_least(spark):
    rnd = random.Random(4)
    layers = repair.Layers()
    kinds = [(r, f) for r in "sua " for f in repair.FAULTS]
    cases = [[k] for k in kinds] + [list(p) for p in itertools.product(kinds, repeat=2)] + [[rnd.choice(kinds) for _ in range(3)] for _ in range(60)]
    for rows in [[], *cases]:
        cost, edits = layers.repair("".join(kind(*r) for r in rows))
        assert (cost, "".join(e[0] for e in edits)) == search(rows), rows


def test_prices_are_shortest_paths():
    """Long conversations: the price of the start equals Dijkstra's distance."""
    rnd = random.Random(8)
    for length in (1, 30, 400):
        kinds = "".join(rnd.choice(repair._KINDS) for _ in range(length))
        arcs = [repair._arcs(k) for k in kinds] + [repair._arcs("")]
        queue, done = [(0, 0, repair.START)], set()
        while True:
            cost, row, state = heapq.heappop(queue)
            if row == length and state in (repair.START, repair.ASSISTANT):
                break
            if (row, state) in done:
                continue
            done.add((row, state))
            for _, more, to, onward in arcs[row][state]:
                heapq.heappush(queue, (cost + more, row + onward, to))
        assert repair.Layers().repair(kinds)[0] == cost


def reports(spark, rows):
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' as pos", "1 as conv", "2 as digest", "3 as kind")
    out = repair.repair_conversations(df, df).collect()
    heads = {r["conv_id"]: r for r in out if r["place"] == 0}
    turns = {c: [(r["role"], r["text"]) for r in sorted(out, key=lambda r: r["place"]) if r["conv_id"] == c and r["edit"] not in (None, "D")] for c in heads}
    return heads, turns


def test_faults_gaps_and_repaired_turns(spark):
    heads, turns = reports(spark, [
        (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, 4, "assistant", "Yes"), (1, None, "system", "Be good!"),
        (2, 0, "assistant", "No."), (2, 1, "assistant", " \t\n"), (3, None, "user", "a."), (3, None, "assistant", "b."),
        (None, 1, "tool", "x.\u2028"), (4, 9, "", "Empty role."), (5, 0, "user", "One. Two"), (5, 1, "assistant", "Three.\n"),
    ])
    short = lambda c: tuple(heads[c][n] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))
    assert short(1) == (3, 0, 1, 1, 1, 6, "RRDD")
    assert turns[1] == [("user", "Be good!"), ("assistant", "Hello.")]
    assert short(2) == (0, 1, 0, 0, 1, 4, "DD")
    assert short(3) == (0, 0, 0, 0, 0, 2, "RR")  # texts decide ties: assistant, then user
    assert short(None) == (0, 0, 0, 1, 0, 2, "D")  # a line separator is no blank
    assert short(4) == (0, 0, 0, 0, 0, 2, "D")
    assert short(5) == (0, 0, 0, 1, 0, 4, "DD")


def test_conversations_without_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "x"), (None, None, None, None)], TURNS)
    out = repair.repair_conversations(df, df.limit(0)).collect()
    assert sorted((r["conv_id"] is None, r["cost"], r["audit"], r["gaps"], r["place"]) for r in out) == [(False, 0, "", 0, 0), (True, 0, "", 0, 0)]
    assert repair.repair_conversations(df.limit(0)).collect() == []


def test_damage_cases(spark):
    """Each case of the damage, found by its CRC; nulls are spaces in what is hashed."""
    import zlib

    rows = [(c, t, None if t == 2 else "assistant", None if t == 3 else "A. B! C?") for c in (*range(40), None) for t in (0, 1, 2, 3, None)]
    got = sorted(map(tuple, repair.damage(spark.createDataFrame(rows, TURNS)).collect()), key=repr)
    want = []
    for c, t, role, text in rows:
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        want += [(c, t, "user" if case == 4 else role, text)] * (0 if case == 0 else 2 if case == 3 else 1)
    assert got == sorted(want, key=repr)


def test_a_long_conversation_of_many_copies(spark):
    """30,000 rows of one conversation, a third of them alike, beside short ones and a very long text."""
    rows = [(1, n, "user" if n % 2 else "assistant", f"{'same' if n % 3 == 0 else n}.") for n in range(30_000)]
    rows += [(2, 0, "user", "word " * 200_000 + "."), (2, 1, "assistant", "Fine.")]
    heads, turns = reports(spark, rows)
    assert heads[1]["duplicate"] == 9_998 and len(heads[1]["audit"]) >= 30_000
    assert LEGAL.fullmatch("".join(r[0] for r, _ in turns[1]))
    assert heads[2]["cost"] == 0 and len(turns[2][0][1]) == 1_000_001


def test_query_agrees_with_sql(spark, sf_dir):
    agrees_with_sql(spark, sf_dir, "op12_structure_repair")
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
