from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pulseframe.llm import prefix_trie
from pulseframe.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def built(rows: list[tuple]) -> dict[int, list[tuple[str, str]]]:
    """Every branched conversation's turns."""
    own: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = (t is not None, t or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())
            own.setdefault(c, []).append((key, (role, text)))
    own = {c: [x for _, x in sorted(r)] for c, r in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rest = c % 100 if c >= 0 else -(-c % 100)  # the sign of the id, as in SQL
        out[c] = own.get(c - rest, [])[:h] + turns[h:]
    return out


def brute(convs: dict[int, list]) -> dict:
    """Totals by walking every node's subtree."""
    members: dict[tuple, list[int]] = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids: dict[tuple, list[tuple]] = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        below = [out[k] for k in kids.get(node, [])]
        ends = sorted(c for c in members[node] if len(convs[c]) == len(node))
        out[node] = {
            "conv_id": min(members[node]), "depth": len(node), "parent_conv_id": min(members[node[:-1]]) if node else None, "n_convs": len(members[node]),
            "n_children": len(below), "n_leaves": sum(k["n_leaves"] for k in below) if below else 1,
            "saved_tokens": sum(k["saved_tokens"] for k in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0),
            "ends_sha256": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return {(r["conv_id"], r["depth"]): r for r in out.values()}


def totals(spark, rows, df=None):
    df = spark.createDataFrame(rows, SCHEMA) if df is None else df
    out = prefix_trie.trie_totals(prefix_trie.branched(prefix_trie.turns_in_order(df))).collect()
    got = {(r["conv_id"], r["depth"]): r.asDict() for r in out}
    assert len(got) == len(out)
    return got


def test_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").collect()]
    assert totals(spark, rows) == brute(built(rows))


def test_awkward_conversations(spark):
    rows = [
        (None, 0, "user", "no id"), (100, None, "user", "null turn"), (100, 0, None, None), (100, 0, "user", ""), (100, 1, "user", "a"), (100, 1, "user", "a"),
        *[(101 + i, t, "user", "a") for i in range(12) for t in range(i % 4)], (250, 0, "assistant", "é\U0001f600 " * 3), (-7, 0, "user", "below zero"),
        (-100, 0, "user", "base below zero"), (10**15 + 3, 0, "1", "2:x"), (10**15 + 4, 0, "12", ":x"), (10**15 + 5, 3, "user", "word " * 100_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "'x' AS place", "'x' AS node", "1 AS depth", "2 AS length")
    assert totals(spark, rows, df) == brute(built(rows))


def test_a_conversation_that_is_the_start_of_another_and_turnless_ones(spark):
    # Without their own first turns, and without a base, conversations are empty: they end at the root.
    rows = [(300 + i, 0, "user", "only") for i in range(1, 30)] + [(200, t, "user", f"t{t}") for t in range(4)] + [(200 + i, t, "user", f"t{t}") for i in range(1, 40) for t in range(i % 7)]
    want = brute(built(rows))
    assert totals(spark, rows) == want
    root = want[200, 0]
    assert root["n_convs"] == len(built(rows)) and root["ends_sha256"] != prefix_trie.EMPTY_SHA256


def chains(sizes: list[int], seed: int) -> dict[int, list]:
    """Conversations that leave earlier ones at random turns."""
    rng = random.Random(seed)
    out: dict[int, list] = {}
    for c, n in enumerate(sizes):
        start = list(out[rng.randrange(c)]) if c else []
        start = start[: rng.randrange(len(start) + 1)]
        out[c] = start + [("user", f"{c}.{i}") for i in range(n)]
    return out


@pytest.mark.parametrize(("sizes", "seed"), [([300, 5, 5, 200, 1], 1), ([1] * 60, 2), ([0, 0, 3, 40, 2, 2, 2, 30, 7], 3), ([2, 90, 1, 1, 1, 60, 4, 4], 4)])
def test_contraction_of_deep_and_bushy_tries(spark, sizes, seed):
    convs = chains(sizes, seed)
    rows = [(c, i + 1, hashlib.md5(repr(t).encode()).digest(), len(t[1])) for c, turns in convs.items() for i, t in enumerate(turns)]
    turns = spark.createDataFrame([*rows, *[(c, 0, None, 0) for c in convs]], "conv long, place long, turn_digest binary, length long")
    got = {(r["conv_id"], r["depth"]): r.asDict() for r in prefix_trie.trie_totals(turns).collect()}
    assert got == brute(convs)


def test_a_nested_chain_takes_few_rounds(spark, monkeypatch):
    """Each conversation is the one before and a turn, and then the spine has a leaf at every node."""
    rounds = []
    one = prefix_trie._round
    monkeypatch.setattr(prefix_trie, "_round", lambda *a: rounds.append(1) or one(*a))
    convs = {c: [("user", str(i)) for i in range(c)] for c in range(60)} | {100 + c: [("user", str(i)) for i in range(c)] + [("user", "leaf")] for c in range(60)}
    rows = [(c, i + 1, hashlib.md5(repr(t).encode()).digest(), len(t[1])) for c, turns in convs.items() for i, t in enumerate(turns)]
    turns = spark.createDataFrame([*rows, *[(c, 0, None, 0) for c in convs]], "conv long, place long, turn_digest binary, length long")
    got = {(r["conv_id"], r["depth"]): r.asDict() for r in prefix_trie.trie_totals(turns).collect()}
    assert got == brute(convs) and len(rounds) <= 12


def test_ends_of_one_node_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    ids = [3, 20, 100, 9, 1000, *range(2000, 2200)]
    ends = spark.createDataFrame([(b"n", c) for c in ids] + [(b"m", 5)], "node binary, conv long").repartition(9)
    got = {bytes(r["node"]): r["ends_sha256"] for r in prefix_trie.end_digests(ends).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"m": hashlib.sha256(b"5").hexdigest()}


def test_nothing(spark):
    assert totals(spark, []) == {}
    assert totals(spark, [(None, 0, "user", "no id")]) == {}
