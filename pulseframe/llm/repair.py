"""Conversation structure repair: the cheapest edits, as integers, along a graph of role states.

A conversation is its turns in order. It is sound when its role initials read ``(s?(ua)+)?``: an
optional system turn, then user and assistant in turns, or nothing at all. A turn can be kept,
given the role user or assistant, or deleted, and an empty user or assistant turn can be inserted
anywhere. Blank turns and repetitions must be deleted; a truncated one costs extra if it stays.

Nodes of the graph are (turns read, role state, inserts so far), edges are edits. The weight of an
edge is one integer: its high digits are the cost, and each of its low digits, of three bits, stands
for one place of the audit, the string of the edits' initials; an edit fills in the digit of its own
place (D 1, I 2, K 3, R 4). There are as many places as the longest audit has letters, and those a
shorter one leaves empty are zeros at its end. So the sum along a path holds its whole cost and audit,
smaller sums mean cheaper edits and, at equal cost, the audit that comes first in ASCII, and the
minimum over paths decides everything; the audit is read off the minimum's digits.

Turns travel to their conversation twice: first a code and a digest each, in order, for the plan, of
which a task holds one conversation's codes and digests at a time; then the texts, in order behind
their conversation's plan, through which they stream, so no task holds a conversation's texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.llm.common import store

WHITE = " \t\n\x0b\x0c\r"
BITS = 3
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = {d: letter for letter, d in DIGITS.items()}

# Role states: nothing yet, after a system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
SOUND_ENDS = (NOTHING, ASSISTANT)

INITIALS = "sua"  # any other initial is number 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # of a truncated turn that stays


COSTS = Costs()


def spoken(state: int) -> tuple[str, int]:
    """The role a given or inserted turn gets after ``state``, and the state after it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def most_inserts(turns: int, costs: Costs) -> int:
    """No cheapest audit has more inserts.

    Instead of an insert, its partner in the pair can be deleted, and a system turn left alone with
    it; so no insert pays that costs more than two deletions. Others cost no more than deleting all.
    """
    return 0 if costs.insert > 2 * costs.delete else turns * costs.delete // costs.insert


def cheapest(codes: bytes, costs: Costs = COSTS) -> tuple[int, str]:
    """Cost and audit of the best edits of turns given as ``4 * initial + fault``."""
    most = most_inserts(len(codes), costs)
    places = len(codes) + most

    def weight(cost: int, letter: str, place: int) -> int:
        return (cost << BITS * places) | (DIGITS[letter] << BITS * (places - 1 - place))

    def offer(nodes: dict, node: tuple[int, int], w: int) -> None:
        if node not in nodes or w < nodes[node]:
            nodes[node] = w

    def with_inserts(nodes: dict, turns: int) -> dict:
        for inserts in range(most):
            for state in (NOTHING, SYSTEM, USER, ASSISTANT):
                if (state, inserts) in nodes:
                    w = nodes[state, inserts] + weight(costs.insert, "I", turns + inserts)
                    offer(nodes, (spoken(state)[1], inserts + 1), w)
        return nodes

    nodes = with_inserts({(NOTHING, 0): 0}, 0)
    for turns, code in enumerate(codes):
        initial, fault = divmod(code, 4)
        extra = costs.truncated if fault == TRUNCATED else 0
        after: dict[tuple[int, int], int] = {}
        for (state, inserts), w in nodes.items():
            place = turns + inserts
            offer(after, (state, inserts), w + weight(costs.delete, "D", place))
            if fault in (BLANK, DUPLICATE):
                continue
            if initial < len(INITIALS) and state in NEXT[INITIALS[initial]]:
                offer(after, (NEXT[INITIALS[initial]][state], inserts), w + weight(extra, "K", place))
            offer(after, (spoken(state)[1], inserts), w + weight(costs.rerole + extra, "R", place))
        nodes = with_inserts(after, turns + 1)
    least = min(w for (state, _), w in nodes.items() if state in SOUND_ENDS)
    digits = (least >> BITS * (places - 1 - i) & 7 for i in range(places))
    return least >> BITS * places, "".join(LETTERS[d] for d in digits if d)


def in_order(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, digest``; null roles and texts are empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("text")
    )
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def _by_turn() -> list[Column]:
    """A conversation's order; rows of one turn go by role, then by the digest of their text."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _planner(schema: list[str], costs: Costs):
    def planned(solve, turns: list, initials: str, faults: bytearray) -> tuple:
        seen = [t for t in turns if t is not None]
        gaps = seen[-1] - seen[0] + 1 - len(seen) if seen else 0
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(faults) - 1))
        codes = bytes(4 * (INITIALS.find(c) if c in INITIALS else 3) + f for c, f in zip(initials, faults))
        cost, audit = solve(codes)
        return (gaps, *[faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)], illegal, cost, audit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.string()]
        solve = lru_cache(20_000)(lambda codes: cheapest(codes, costs))  # short conversations are often alike
        conv, started = None, False
        turns, initials, faults, earlier = [], [], bytearray(), set()
        convs, rows = [], []

        def finish() -> None:
            convs.append(conv)
            rows.append(planned(solve, turns, "".join(initials), faults))

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, turn, role, digest, last in zip(*[x.to_pylist() for x in batch.columns]):
                if not started or c != conv:
                    if started:
                        finish()
                    conv, started = c, True
                    turns, initials, faults, earlier = [], [], bytearray(), set()
                if not turns or turn != turns[-1]:
                    turns.append(turn)
                initials.append(role[:1] or "-")
                said = (role, digest)
                faults.append(BLANK if not last else DUPLICATE if said in earlier else FINE if last in ".!?" else TRUNCATED)
                earlier.add(said)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(convs, kind), *map(pa.array, zip(*rows), types)], names=schema)
                convs, rows = [], []
        if started:
            finish()
            yield pa.RecordBatch.from_arrays([pa.array(convs, kind), *map(pa.array, zip(*rows), types)], names=schema)

    return run


def plan(
    turns: DataFrame, costs: Costs = COSTS, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, a row a conversation.

    Turns go by ``turn``, nulls first; rows of one turn by role and the digest of their text, so
    repeated rows follow each other and all but the first are duplicates. A null role or text is
    empty, a null conversation id is an id like any other. A role counts by its first character;
    only s, u and a can be kept. ``gaps`` counts whole turns missing between the first and the last
    (0 where all are null). An empty table gives an empty result; other columns are ignored.

    The time of one conversation grows with the square of its turns (a weight has a digit for every
    place), its memory with the turns, whatever the texts' length.
    """
    rows = in_order(turns, conv_col, turn_col, role_col, text_col)
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    slim = rows.select("conv", F.col("turn").cast("long").alias("turn"), "role", "digest", last.alias("last"))
    sorted_rows = slim.repartition("conv").sortWithinPartitions("conv", *_by_turn())
    schema = T.StructType([slim.schema["conv"], *T.StructType.fromDDL(PLAN).fields])
    return sorted_rows.mapInArrow(_planner(schema.fieldNames(), costs), schema).withColumnRenamed("conv", conv_col)


def _repairer(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, state, place, conv, kind = "", 0, NOTHING, 0, None, None
        out: list[tuple] = []

        def inserts() -> None:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                role, state = spoken(state)
                out.append((conv, place, "I", None, role, ""))
                at, place = at + 1, place + 1

        def packed() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            small = [x.to_pylist() for x in batch.columns[:-1]]
            for c, own, turn, role, text in zip(*small, batch.column(4)):
                if own is not None:  # a conversation begins with its plan
                    inserts()  # those behind the last turn of the conversation before
                    audit, at, state, place, conv = own, 0, NOTHING, 0, c
                    continue
                inserts()
                letter, at = audit[at], at + 1
                if letter == "D":
                    continue
                if letter == "R":
                    role, state = spoken(state)
                else:
                    state = NEXT[role[:1]][state]
                out.append((conv, place, letter, turn, role, text.as_py()))
                place += 1
            if out:
                yield packed()
                out.clear()
        inserts()
        if out:
            yield packed()

    return run


def repaired(
    turns: DataFrame,
    plans: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, place, edit, turn, role, text``: the turns that remain, by the plans of the same ``turns``.

    ``place`` numbers a conversation's rows from 0, ``edit`` is K, R or I; an inserted row has no
    turn. A conversation's rows are in order within one partition. Conversations of which nothing
    remains have no rows.
    """
    rows = in_order(turns, conv_col, turn_col, role_col, text_col).withColumn("turn", F.col("turn").cast("long"))
    none = F.lit(None)
    heads = plans.select(F.col(conv_col).alias("conv"), F.lit(0).alias("part"), F.col("audit"), *[none.alias(c) for c in ("turn", "role", "text", "digest")])
    both = heads.unionByName(rows.select("conv", F.lit(1).alias("part"), none.alias("audit"), "turn", "role", "text", "digest"))
    stream = both.repartition("conv").sortWithinPartitions("conv", "part", *_by_turn()).select("conv", "audit", "turn", "role", "text")
    schema = T.StructType([stream.schema["conv"], *T.StructType.fromDDL("place long, edit string, turn long, role string, text string").fields])
    return stream.mapInArrow(_repairer(schema.fieldNames()), schema).withColumnRenamed("conv", conv_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by a checksum of conversation and turn.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it
    and 4 makes it the user's. Nulls are one space, also in the checksum.
    """
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    check = F.crc32(F.concat(said["conv_id"], F.lit(":"), said["turn"])) % 20
    rows = conversations.select("conv_id", "turn", said["role"].alias("role"), said["text"].alias("text"), check.alias("_fault")).filter("_fault <> 0")
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _digests(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        out: list[tuple] = []
        for batch in batches:
            kind = batch.schema.field(0).type
            for c, place, role, text in zip(*[x.to_pylist() for x in batch.columns]):
                if place == 0:
                    if digest:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (kind, pa.string()))], names=names)
                out = []
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=names)

    return run


def digests(rows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``conv_id, repaired_sha256`` of :func:`repaired`'s rows, as ``role:text`` joined by line breaks; texts only stream by."""
    schema = T.StructType([rows.schema[conv_col], T.StructField("repaired_sha256", T.StringType())])
    return rows.select(conv_col, "place", "role", "text").mapInArrow(_digests(schema.fieldNames()), schema)


EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # fixed value: of no bytes


def repair_report(conversations: DataFrame, costs: Costs = COSTS) -> DataFrame:
    """Plan and digest of every conversation of the damaged table; one of which no row is left has zeros and an empty audit."""
    turns = damaged(conversations)
    plans = store(plan(turns, costs), "plans")
    said = digests(repaired(turns, plans))
    ids = conversations.select("conv_id").distinct()
    # Null ids meet as well; both sides have one row a conversation.
    own = [F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_id"), F.col("conv_id").isNull().alias("_null")]
    sides = [d.select(*own, *d.columns) for d in (ids, plans, said)]
    out = sides[0].join(sides[1].drop("conv_id"), ["_id", "_null"], "left").join(sides[2].drop("conv_id"), ["_id", "_null"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))


def oracle(costs: Costs = COSTS) -> str:
    """SQL that tries every sound sequence of edits; inserts are left out, since at these costs none pays."""
    assert most_inserts(1, costs) == 0
    crc = """xor(list_reduce(list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda h, b:
        list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END), xor(h, b)), 4294967295::BIGINT), 4294967295::BIGINT)"""
    white = "\\x20\\x09-\\x0D"
    return f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
),
drawn AS (SELECT *, {crc} % 20 AS f FROM keyed),
broken AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
        CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM drawn, (VALUES (1), (2)) c(copy) WHERE f <> 0 AND (copy = 1 OR f = 3)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, regexp_extract(text, '([^{white}])[{white}]*$', 1) AS last
    FROM broken
),
faulty AS (
    SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
        left(role, 1) AS initial, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following
    FROM placed
),
tried(conv_id, i, state, cost, audit, said) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, '', 0, '', []::VARCHAR[] FROM faulty
    UNION ALL
    SELECT t.conv_id, f.i, CASE e WHEN 'D' THEN t.state WHEN 'K' THEN f.initial WHEN 'U' THEN 'u' ELSE 'a' END,
        t.cost + CASE e WHEN 'D' THEN {costs.delete} WHEN 'K' THEN 0 ELSE {costs.rerole} END
            + CASE WHEN e <> 'D' AND f.fault = 'truncated' THEN {costs.truncated} ELSE 0 END,
        t.audit || CASE WHEN e IN ('U', 'A') THEN 'R' ELSE e END,
        CASE e WHEN 'D' THEN t.said WHEN 'K' THEN list_append(t.said, f.role || ':' || f.text)
            WHEN 'U' THEN list_append(t.said, 'user:' || f.text) ELSE list_append(t.said, 'assistant:' || f.text) END
    FROM tried t JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM t.conv_id AND f.i = t.i + 1, (VALUES ('D'), ('K'), ('U'), ('A')) v(e)
    WHERE e = 'D' OR f.fault NOT IN ('blank', 'duplicate')
        AND t.state || CASE e WHEN 'K' THEN f.initial WHEN 'U' THEN 'u' ELSE 'a' END IN ('s', 'u', 'su', 'ua', 'au')
),
done AS (
    SELECT t.conv_id, arg_min(struct_pack(cost, audit, said), (cost, audit)) AS best
    FROM tried t JOIN (SELECT conv_id, max(i) AS n FROM faulty GROUP BY conv_id) m ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND t.i = m.n
    WHERE state IN ('', 'a') GROUP BY t.conv_id
),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit,
    sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN done d ON o.conv_id IS NOT DISTINCT FROM d.conv_id
"""
