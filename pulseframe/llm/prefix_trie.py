"""Prefix trie of conversations, its subtree totals by parallel tree contraction.

Every distinct sequence of first turns is a node. A conversation's turns stream by in order, and a
turn's node is a digest of the node before and of the turn, so no task holds a conversation.

Totals of subtrees are sums over a tree that may be as deep as the longest conversation. Each round,
as joins, takes away what it can everywhere at once:

- rake: childless nodes leave; their total is known and goes to the parent;
- compress: of the unary nodes (one child left) of each chain, some that do not touch leave; their
  value goes to the parent, their child becomes the parent's, and the total they lack is the child's.

A unary node leaves if its coin shows 1 and that of its child 0. The first rounds read the coins off
the bits of the depth, which halves a whole chain each round, later ones off a hash. So the rounds
grow with the logarithm of the nodes, however deep the tree is, and the live tables shrink round by
round. Which child a parent has left is found without a search: it keeps the exclusive or of its
children's names, and those that leave are taken out.

At the end the contracted nodes are expanded again: a node's total is what it had plus its child's,
and pointers to children are shortened to pointers to raked nodes by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulseframe.llm.common import drop_stored, store

NODE_BYTES = 16
ROOT = bytes(NODE_BYTES)
PIECE = 4096  # ids whose decimals travel as one text
GROUP = 100  # conversations that branch off the same one
HEADS = 6  # they share fewer turns than this


def turns_in_order(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv, place, turn_digest, length``: every turn's place from 1, a digest of role and text, and the text's characters.

    Turns go by ``turn``, nulls first; those of one turn by role, then by the digest. A null role or
    text is empty. Rows without a conversation id belong to none and are left out. Texts stay where
    they are: only digests meet.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), digest.alias("turn_digest"), F.length(text).cast("long").alias("length")
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_digest")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).select("conv", "place", "turn_digest", "length")


def branched(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Conversations that share the start of their group's first one: ``turns`` rebuilt, and a row of place 0 a conversation.

    With ``h`` the checksum of the id modulo ``heads``, conversation c has the first h turns of
    conversation ``c - c % group`` (all if fewer, none if there is none), then its own after its
    first h. A conversation joins at most ``heads - 1`` turns, of one conversation that ``group`` share.
    """
    shared = F.crc32(F.col("conv").cast("string")) % heads
    convs = turns.groupBy("conv").agg(F.lit(0).cast("long").alias("place")).withColumn("shared", shared)
    firsts = turns.filter((F.col("conv") % group == 0) & (F.col("place") < heads))
    own = turns.filter(F.col("place") > shared)
    taken = convs.withColumn("base", F.col("conv") - F.col("conv") % group).select(F.col("conv").alias("to"), "base", "shared")
    taken = taken.join(firsts.withColumnRenamed("conv", "base"), "base").filter("place <= shared").select(F.col("to").alias("conv"), "place", "turn_digest", "length")
    tops = convs.select("conv", "place", F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("length"))
    return own.unionByName(taken).unionByName(tops)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of turns in order; a row says whether it is its conversation's last once the next one is there."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
    names = ["conv", "depth", "node", "parent", "length", "is_end"]
    held: tuple | None = None  # the row before, whose successor is not known yet
    out: list[tuple] = []

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)

    for batch in batches:
        for conv, place, digest, length in zip(*[x.to_pylist() for x in batch.columns]):
            if held:
                out.append((*held, held[0] != conv))
            if place == 0:
                held = (conv, 0, ROOT, None, 0)
            else:
                before = held[2]
                held = (conv, held[1] + 1, hashlib.blake2b(before + digest, digest_size=NODE_BYTES).digest(), before, length)
        if out:
            yield packed()
            out.clear()
    if held:
        out.append((*held, True))
        yield packed()


def paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, node, parent, length, is_end``: the nodes of every conversation, from the root on.

    ``turns`` has a row of place 0 for each conversation, and its turns in order of place.
    """
    rows = turns.select("conv", "place", "turn_digest", "length").repartition("conv").sortWithinPartitions("conv", "place")
    return rows.mapInArrow(_chained, "conv long, depth long, node binary, parent binary, length long, is_end boolean")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, joined by commas, ``PIECE`` at most in one text and one node in each."""
    out: list[tuple] = []
    node, ids = None, []

    def close() -> None:
        if ids:
            out.append((node, ids[0], ",".join(map(str, ids))))
            ids.clear()

    for batch in batches:
        for own, conv in zip(*[x.to_pylist() for x in batch.columns]):
            if own != node or len(ids) == PIECE:
                close()
                node = own
            ids.append(conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], names=["node", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    out: list[tuple] = []
    for batch in batches:
        for own, _, ids in zip(*[x.to_pylist() for x in batch.columns]):
            if own != node:
                if digest:
                    out.append((node, digest.hexdigest()))
                node, digest = own, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), (pa.binary(), pa.string()))], names=["node", "ends_sha256"])
            out = []
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends(node, conv)`` to ``node, ends_sha256`` over each node's ids in rising order, joined by commas.

    The ids of a node that many conversations end at are sorted in ranges, by many tasks, which
    join them to pieces; one task then reads the pieces, not the rows, since a SHA-256 is one chain.
    """
    pieces = ends.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(_pieces, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_hashed, "node binary, ends_sha256 string")


def trie(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes, stored, and where conversations end, ``node, conv``.

    A node is ``node, conv, depth, parent_conv, n_convs, n_children, length``: by its smallest member
    and its depth it is unique, and ``(parent_conv, depth - 1)`` is its parent.
    """
    rows = store(paths(turns), "paths")
    nodes = rows.groupBy("node").agg(
        F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.count("*").alias("n_convs"), F.max("length").alias("length")
    )
    nodes = store(nodes, "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    # One row a parent: where a parent has many children, adaptive execution splits their side.
    out = nodes.join(above, "parent", "left").join(children, "node", "left")
    named = out.select("node", "conv", "depth", "parent_conv", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "length")
    return store(named, "trie"), rows.filter("is_end").select("node", "conv")


def _coin(round_no: int, depth_bits: int, conv: Column, depth: Column) -> Column:
    """0 or 1 for a node in a round: a bit of its depth while there are any, then a bit of a hash."""
    if round_no < depth_bits:
        return F.shiftright(depth, round_no).bitwiseAND(F.lit(1))
    return F.xxhash64(F.lit(round_no), conv, depth).bitwiseAND(F.lit(1))


def contracted(tree: DataFrame, values: list[str]) -> DataFrame:
    """Subtree totals of ``tree(conv, depth, parent_conv, n_children, *values)``, as ``conv, depth, *values``.

    A node is ``(conv, depth)``, its parent ``(parent_conv, depth of the parent)``; at first that is
    one less. Values are whole numbers. An empty tree gives an empty result.
    """
    kids = tree.filter("parent_conv is not null").groupBy(F.col("parent_conv").alias("conv"), (F.col("depth") - 1).alias("depth"))
    kids = kids.agg(F.bit_xor("conv").alias("kid_conv"), F.bit_xor(F.col("depth")).alias("kid_depth"))
    start = tree.join(kids, ["conv", "depth"], "left").select(
        "conv", "depth", "parent_conv", (F.col("depth") - 1).alias("parent_depth"), F.col("n_children").alias("n"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kid_conv", "kid_depth")], *values
    )
    live = store(start.withColumn("fate", F.lit("live")), "live")
    depth_bits = int(live.agg(F.max("depth")).first()[0] or 0).bit_length()
    rounds, round_no = [], 0
    while not live.filter("fate = 'live'").isEmpty():
        after = store(_round(live.filter("fate = 'live'").drop("fate"), values, round_no, depth_bits), "live")
        rounds.append(after)
        live, round_no = after, round_no + 1
    if not rounds:
        return tree.select("conv", "depth", *values)
    out = _expanded(rounds, values)
    for done in rounds:
        drop_stored(done)
    return out


def _round(live: DataFrame, values: list[str], round_no: int, depth_bits: int) -> DataFrame:
    """``live`` after one rake and one compress; ``fate`` says which nodes left, raked or contracted."""
    names = ["conv", "depth", "parent_conv", "parent_depth", "n", "kid_conv", "kid_depth", *values]
    raked = live.filter("n = 0")
    gone = raked.filter("parent_conv is not null").groupBy(F.col("parent_conv").alias("conv"), F.col("parent_depth").alias("depth"))
    gone = gone.agg(
        F.count("*").alias("gone"), F.bit_xor("conv").alias("gone_conv"), F.bit_xor("depth").alias("gone_depth"), *[F.sum(v).alias(f"gone_{v}") for v in values]
    )
    had = {v: F.col(v) + F.coalesce(F.col(f"gone_{v}"), F.lit(0)) for v in values}
    left = live.filter("n > 0").join(gone, ["conv", "depth"], "left")
    left = left.select(
        "conv", "depth", "parent_conv", "parent_depth", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"),
        *[F.col(f"kid_{c}").bitwiseXOR(F.coalesce(f"gone_{c}", F.lit(0))).alias(f"kid_{c}") for c in ("conv", "depth")], *[had[v].alias(v) for v in values],
    )
    own, kid = _coin(round_no, depth_bits, F.col("conv"), F.col("depth")), _coin(round_no, depth_bits, F.col("kid_conv"), F.col("kid_depth"))
    left = left.withColumn("goes", (F.col("n") == 1) & F.col("parent_conv").isNotNull() & (own == 1) & (kid == 0))
    # A node that leaves tells its parent and its child; neither of them leaves in the same round.
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    up = F.struct(
        F.col("parent_conv").alias("conv"), F.col("parent_depth").alias("depth"), none.alias("new_conv"), none.alias("new_depth"),
        F.col("conv").bitwiseXOR(F.col("kid_conv")).alias("swap_conv"), F.col("depth").bitwiseXOR(F.col("kid_depth")).alias("swap_depth"), *[F.col(v).alias(f"more_{v}") for v in values],
    )
    down = F.struct(
        F.col("kid_conv").alias("conv"), F.col("kid_depth").alias("depth"), F.col("parent_conv").alias("new_conv"), F.col("parent_depth").alias("new_depth"),
        zero.alias("swap_conv"), zero.alias("swap_depth"), *[zero.alias(f"more_{v}") for v in values],
    )
    told = left.filter("goes").select(F.inline(F.array(up, down))).groupBy("conv", "depth")
    told = told.agg(
        *[F.max(f"new_{c}").alias(f"new_{c}") for c in ("conv", "depth")], *[F.bit_xor(f"swap_{c}").alias(f"swap_{c}") for c in ("conv", "depth")], *[F.sum(f"more_{v}").alias(f"more_{v}") for v in values]
    )
    stay = left.join(told, ["conv", "depth"], "left").select(
        "conv", "depth", *[F.coalesce(f"new_{c}", f"parent_{c}").alias(f"parent_{c}") for c in ("conv", "depth")], "n",
        *[F.col(f"kid_{c}").bitwiseXOR(F.coalesce(f"swap_{c}", F.lit(0))).alias(f"kid_{c}") for c in ("conv", "depth")],
        *[(F.col(v) + F.coalesce(F.col(f"more_{v}"), F.lit(0))).alias(v) for v in values], F.when(F.col("goes"), "contracted").otherwise("live").alias("fate"),
    )
    return stay.select(*names, "fate").unionByName(raked.select(*names, F.lit("raked").alias("fate")))


def _expanded(rounds: list[DataFrame], values: list[str]) -> DataFrame:
    """Totals of all nodes from what each round took away."""
    every = rounds[0]
    for later in rounds[1:]:
        every = every.unionByName(later)
    known = every.filter("fate = 'raked'").select("conv", "depth", *values)
    open_nodes = store(every.filter("fate = 'contracted'").select("conv", "depth", "kid_conv", "kid_depth", *values), "open")
    while True:
        # Where the child is open as well, go on to its child; pointers double their reach.
        further = open_nodes.select(
            F.col("conv").alias("kid_conv"), F.col("depth").alias("kid_depth"), F.col("kid_conv").alias("far_conv"), F.col("kid_depth").alias("far_depth"), *[F.col(v).alias(f"far_{v}") for v in values]
        )
        moved = open_nodes.join(further, ["kid_conv", "kid_depth"], "left").select(
            "conv", "depth", *[F.coalesce(f"far_{c}", f"kid_{c}").alias(f"kid_{c}") for c in ("conv", "depth")],
            *[(F.col(v) + F.coalesce(F.col(f"far_{v}"), F.lit(0))).alias(v) for v in values], F.col("far_conv").isNotNull().alias("moved"),
        )
        moved = store(moved, "open")
        drop_stored(open_nodes)
        open_nodes = moved
        if moved.filter("moved").isEmpty():
            break
    ends = known.toDF("kid_conv", "kid_depth", *[f"far_{v}" for v in values])
    found = open_nodes.join(ends, ["kid_conv", "kid_depth"]).select("conv", "depth", *[(F.col(v) + F.col(f"far_{v}")).alias(v) for v in values])
    out = store(known.unionByName(found), "totals")
    drop_stored(open_nodes)
    return out


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def trie_totals(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    ``turns(conv, place, turn_digest, length)`` has a row of place 0 for every conversation.
    ``n_leaves`` counts the childless nodes of the subtree, ``saved_tokens`` sums each node's
    members but one, times the characters of its last text; ``ends_sha256`` is over the ids that end
    at the node. Equal conversations end at the same node; one without turns ends at the root.
    An empty table has no root either.
    """
    nodes, ends = trie(turns)
    tree = nodes.select(
        "conv", "depth", "parent_conv", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("length")).alias("saved")
    )
    totals = contracted(tree, ["leaves", "saved"])
    named = nodes.join(end_digests(ends), "node", "left").join(totals, ["conv", "depth"])
    return named.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def oracle(group: int = GROUP, heads: int = HEADS) -> str:
    """SQL of the trie of branched ``conversations``: prefixes as running digests, subtrees as all pairs of node and ancestor on its path."""
    crc = """xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda h, b:
        list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END), xor(h, b)), 4294967295::BIGINT), 4294967295::BIGINT)"""
    said = "md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
WITH own AS (
    SELECT conv_id, {said} AS m, length(coalesce(text, '')) AS n,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), {said}) AS i
    FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (SELECT conv_id, {crc} % {heads} AS h, conv_id - conv_id % {group} AS base FROM (SELECT DISTINCT conv_id FROM own)),
built AS (
    SELECT c.conv_id, i, m, n FROM conv c JOIN own o ON o.conv_id = c.base AND i <= h
    UNION ALL SELECT o.conv_id, i, m, n FROM own o JOIN conv c ON o.conv_id = c.conv_id AND i > h
    UNION ALL SELECT conv_id, 0, '', 0 FROM conv
),
path AS (
    SELECT conv_id, n, row_number() OVER w - 1 AS depth, string_agg(m, '') OVER w AS p, count(*) OVER (PARTITION BY conv_id) - 1 AS turns
    FROM built WINDOW w AS (PARTITION BY conv_id ORDER BY i)
),
node AS (
    SELECT p, min(conv_id) AS conv_id, depth, count(*) AS n_convs, max(n) AS n,
        coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = depth), '') AS ends
    FROM path GROUP BY p, depth
),
up AS (
    SELECT u.conv_id, u.depth, a.p AS above_p, a.depth AS above_depth, NOT EXISTS (SELECT 1 FROM path c WHERE c.depth = u.depth + 1 AND c.p[:length(u.p)] = u.p) AS leaf, (u.n_convs - 1) * u.n AS saved
    FROM node u JOIN path a ON a.conv_id = u.conv_id AND a.depth <= u.depth
),
below AS (SELECT above_p AS p, above_depth AS depth, sum(CAST(leaf AS BIGINT)) AS n_leaves, sum(saved) AS saved_tokens, count(*) FILTER (depth = above_depth + 1) AS n_children FROM up GROUP BY ALL)
SELECT v.conv_id, v.depth, a.conv_id AS parent_conv_id, v.n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM node v JOIN below USING (p, depth) LEFT JOIN path q ON q.conv_id = v.conv_id AND q.depth = v.depth - 1 LEFT JOIN node a ON a.p = q.p AND a.depth = q.depth
"""
