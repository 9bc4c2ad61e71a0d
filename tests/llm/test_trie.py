"""Prefix trie: brute force, bands of several heights, awkward tables."""

import hashlib
import random
import zlib

import pytest

from visitlake.llm import prefix_trie
from visitlake.llm.queries import QUERIES

from helpers import agrees_with_sql

TURNS = "conv_id bigint, turn bigint, role string, text string, k1 string, depth int, pos int, bytes int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def brute(rows):
    """Nodes of the trie by plain loops: NAMES and the ids that end there."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(turns)] for c, turns in own.items()}
    trie = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5 if conv >= 0 else -(abs(conv) % 5))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            trie.setdefault(path[:d], []).append((conv, d == len(path)))
    own_value = {p: (len(m) - 1) * (len(p[-1][1].encode()) if p else 0) for p, m in trie.items()}
    children = {p: sum(1 for q in trie if q and q[:-1] == p) for p in trie}
    out = []
    for p, members in trie.items():
        below = [q for q in trie if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c, last in members if last))
        out.append((
            min(c for c, _ in members), len(p), min(c for c, _ in trie[p[:-1]]) if p else None, len(members), children[p],
            sum(children[q] == 0 for q in below), sum(own_value[q] for q in below), ends,
        ))
    return sorted(out, key=repr)


def found(spark, rows, band):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], TURNS)
    nodes, ends = prefix_trie.prefix_trie(df, band)
    at = {}
    for r in ends.collect():
        at.setdefault((r["k1"], r["k2"]), []).append(r["conv_id"])
    return sorted(
        ((*(r[n] for n in NAMES), ",".join(map(str, sorted(at.get((r["k1"], r["k2"]), []))))) for r in nodes.collect()), key=repr
    )


@pytest.mark.parametrize("band", [2, 16])
def test_nodes_agree_with_brute_force(spark, band):
    rnd = random.Random(band)
    rows = []
    for conv in [*range(-6, 40), 10_000, 123_456]:
        for turn in range(rnd.randint(1, 12)):
            rows.append((conv, rnd.choice([turn, turn, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["é", "ab", "", None])))
    rows += [(7, n, "user", "same") for n in range(100, 140)] + [(8, n, "user", "same") for n in range(100, 150)]
    rows += [(None, 0, "user", "belongs nowhere"), (None, None, None, None)]
    assert found(spark, rows, band) == brute(rows)


def test_copies_of_a_conversation_and_a_long_one(spark):
    """A third of all rows in one conversation, many copies of another, every turn twice."""
    rows = [(5 * c, t, "user", f"t{t}") for c in range(200) for t in range(3)]
    rows += [(3, n // 2, "assistant", f"long {n // 2}") for n in range(300)]
    assert found(spark, rows, 4) == brute(rows)


def test_positions_over_several_partitions(spark):
    """A conversation that a sort splits is numbered through."""
    from visitlake.llm.turns import number_turns

    turns = spark.range(5000).selectExpr("id % 2 * 0 as c", "5000 - id as turn", "'r' as role", "repeat('x', 300) as text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = number_turns(turns, ["c"], ["turn"]).orderBy("turn").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["pos"] for r in rows] == list(range(5000))


def test_no_conversation_without_id_and_empty_table(spark):
    assert found(spark, [], 16) == []
    assert found(spark, [(None, 1, "user", "x")], 16) == []


def test_turnless_conversation_is_a_member_of_the_root(spark):
    short = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    rows = found(spark, [(short, 0, "user", "lost, as no other conversation lends turns")], 16)
    assert rows == [(short, 0, None, 1, 0, 1, 0, str(short))]


def test_query_agrees_with_sql(spark, sf_dir):
    agrees_with_sql(spark, sf_dir, "op11_prefix_trie")


def test_query_digests_ends(spark, tmp_path):
    rows = [(5 * c, 0, "user", "same") for c in range(2500)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = {r["depth"]: r for r in QUERIES["op11_prefix_trie"](spark, str(tmp_path)).collect()}
    ids = ",".join(str(5 * c) for c in range(2500))
    assert out[1]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest()
    assert out[0]["ends_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (out[1]["saved_tokens"], out[0]["n_convs"], out[0]["n_leaves"]) == (2499 * 4, 2500, 1)
