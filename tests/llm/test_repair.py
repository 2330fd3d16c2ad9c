from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest
from pulseframe.llm import repair
from pulseframe.llm.common import table
from pulseframe.llm.repair import BLANK, COSTS, DUPLICATE, FINE, TRUNCATED, Costs

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def sound(roles: str) -> bool:
    body = roles[1:] if roles[:1] == "s" else roles
    return roles == "" or (len(body) >= 2 and body == "ua" * (len(body) // 2))


def brute(codes: bytes, costs: Costs, most: int) -> tuple[int, str]:
    """Every sequence of edits with up to ``most`` inserts in all."""
    best = None

    def go(i: int, roles: str, cost: int, audit: str, inserts: int) -> None:
        nonlocal best
        if i == len(codes) and sound(roles) and (best is None or (cost, audit) < best):
            best = cost, audit
        if inserts < most:
            for r in "ua":
                go(i, roles + r, cost + costs.insert, audit + "I", inserts + 1)
        if i == len(codes):
            return
        initial, fault = divmod(codes[i], 4)
        go(i + 1, roles, cost + costs.delete, audit + "D", inserts)
        if fault in (BLANK, DUPLICATE):
            return
        extra = costs.truncated if fault == TRUNCATED else 0
        go(i + 1, roles + "suax"[initial], cost + extra, audit + "K", inserts)
        for r in "ua":
            go(i + 1, roles + r, cost + costs.rerole + extra, audit + "R", inserts)

    go(0, "", 0, "", 0)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_integer_minimum_equals_all_edits(seed):
    rng = random.Random(seed)
    for _ in range(25):
        codes = bytes(4 * rng.randrange(4) + rng.choice([FINE, FINE, FINE, BLANK, DUPLICATE, TRUNCATED]) for _ in range(rng.randrange(6)))
        assert repair.cheapest(codes) == brute(codes, COSTS, 2)


@pytest.mark.parametrize("costs", [Costs(insert=1), Costs(delete=6, insert=2, truncated=1), Costs(rerole=9, delete=4, insert=3, truncated=2), Costs(rerole=3, delete=1, insert=2, truncated=0)])
def test_inserts_pay_at_other_costs(costs):
    rng = random.Random(7)
    some = 0
    for _ in range(25):
        codes = bytes(4 * rng.randrange(4) + rng.choice([FINE, FINE, BLANK, TRUNCATED]) for _ in range(rng.randrange(4)))
        got = repair.cheapest(codes, costs)
        assert got == brute(codes, costs, 4)
        some += "I" in got[1]
    assert some or costs.insert == 2 and costs.delete == 1


def test_ties_take_the_first_audit_in_ascii():
    users = bytes([4 * 1, 4 * 1, 4 * 1])  # u u u: many cheapest repairs of cost 3
    assert repair.cheapest(users) == brute(users, COSTS, 1)
    assert repair.cheapest(bytes([4, 4])) == (1, "KR")
    assert repair.cheapest(b"") == (0, "")
    assert repair.cheapest(bytes([0])) == (2, "D")  # a lone system turn goes


def test_a_long_conversation_is_solved():
    codes = bytes([4 * 1, 4 * 2] * 1500)
    assert repair.cheapest(codes) == (0, "K" * 3000)


def report(spark, rows):
    return {r["conv_id"]: r.asDict() for r in repair.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()}


def expected(rows: list[tuple]) -> dict:
    """The contract, conversation by conversation."""
    say = lambda x: " " if x is None else str(x)
    damaged: dict = {}
    for c, t, role, text in rows:
        role, text = say(role), say(text)
        f = zlib.crc32(f"{say(c)}:{say(t)}".encode()) % 20
        if f == 0:
            damaged.setdefault(c, [])
            continue
        text = "" if f == 1 else "".join(x for x in text if x not in ".!?") if f == 2 else text
        damaged.setdefault(c, []).extend([(t, "user" if f == 4 else role, text)] * (2 if f == 3 else 1))
    out = {}
    for c, own in damaged.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, codes = set(), []
        for _, role, text in own:
            last = text.rstrip(WHITE)[-1:]
            codes.append((role[:1], BLANK if not last else DUPLICATE if (role, text) in seen else FINE if last in ".!?" else TRUNCATED))
            seen.add((role, text))
        cost, audit = brute(bytes(4 * ("sua".find(r) if r and r in "sua" else 3) + f for r, f in codes), COSTS, 0)
        said, state = [], ""
        for letter, (_, role, text) in zip(audit, own):
            if letter != "D":
                role = role if letter == "K" else "assistant" if state == "u" else "user"
                state = role[0]
                said.append(f"{role}:{text}")
        turns = {t for t, _, _ in own if t is not None}
        out[c] = {
            "conv_id": c, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            **{name: sum(f == k for _, f in codes) for name, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
            "illegal": sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(codes)),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest(),
        }
    return out


def test_report_equals_the_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").filter("conv_id < 60").collect()]
    assert report(spark, rows) == expected(rows)


def test_awkward_conversations(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "No id."), (1, None, "user", "Null turn."), (1, None, None, "Null role."), (1, 0, "", "Empty role."),
        (2, 5, "user", None), (3, 1, "user", "Same."), (3, 1, "user", "Same."), (3, 1, "assistant", "Same."), (4, 7, "Sonstige", "Other role"),
        (5, 10**15, "user", "Far away."), (5, -4, "system", "x "), (6, 0, "user", " "), (7, 0, "üser", "é!"), *[(8, i, "user", f"Again {i}?") for i in range(8)],
        *[(100 + i, 0, "user", "Alone.") for i in range(40)],
    ]
    got = report(spark, rows)
    assert got == expected(rows)
    gone = [r for r in got.values() if r["cost"] == 0 and not r["audit"]]
    assert any(r["conv_id"] is not None and r["conv_id"] >= 100 for r in gone)  # a conversation without a row is reported


def test_very_long_texts_and_conversations(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(500)] + [(2, 0, "user", "word " * 200_000 + "."), (2, 1, "assistant", "Fine.")]
    got = report(spark, rows)
    assert len(got[1]["audit"]) > 400
    turns = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    back = repair.repaired(turns, repair.plan(turns)).filter("conv_id = 1").orderBy("place").collect()
    assert [r["place"] for r in back] == list(range(len(back)))
    assert sound("".join(r["role"][0] for r in back))


def test_repaired_rows_with_inserts(spark):
    costs = Costs(delete=9, insert=1)
    turns = spark.createDataFrame([(1, 0, "user", "One?"), (1, 1, "user", "Two?"), (2, 0, "assistant", "Hm."), (3, 0, "user", " ")], SCHEMA)
    plans = repair.plan(turns, costs)
    rows = repair.repaired(turns, plans).collect()
    got = {c: [(r["edit"], r["turn"], r["role"], r["text"]) for r in sorted(rows, key=lambda r: r["place"]) if r["conv_id"] == c] for c in (1, 2, 3)}
    assert got[1] == [("K", 0, "user", "One?"), ("R", 1, "assistant", "Two?")]
    assert got[2] == [("I", None, "user", ""), ("K", 0, "assistant", "Hm.")]
    assert got[3] == []


def test_many_conversations_in_few_partitions_and_clashing_columns(spark):
    rows = [(i, t, ("user", "assistant")[t % 2], f"Say {i} {t}.") for i in range(300) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS conv", "'x' AS digest", "'x' AS audit", "1 AS place", "'x' AS _fault")
    got = {r["conv_id"]: r.asDict() for r in repair.repair_report(df).collect()}
    assert got == expected(rows)


def test_nothing(spark):
    assert report(spark, []) == {}
