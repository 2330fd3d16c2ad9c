"""Shards of even row counts that keep linked documents together: balanced label propagation.

Links are a bipartite table ``(id, hub)``: a hub stands for whatever its members share, so a group
of n members costs n rows, not n squared pairs. Each round a hub takes the label most of its members
have, each document wants the label its hubs hold, and moves between two shards are admitted up to
the opposite flow plus the room below the quota (one row per pair of shards decides the rates).
Documents without links have no preference; they fill the quotas at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import drop_stored, ranked, store, unit_hash


def text_hubs(docs: DataFrame, n_shards: int) -> DataFrame:
    """``docs(id, group)`` to ``(id, hub)`` for groups of two or more rows.

    A group that would not fit into nine tenths of a shard becomes several hubs by a hash of the id,
    so no hub outgrows a shard and no task sees a whole dominant group.
    """
    total = docs.count()
    piece = max(1, 9 * total // (10 * n_shards))
    sizes = docs.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    return (
        docs.filter("id is not null")
        .join(sizes, "group")
        .select("id", F.xxhash64("group", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / piece))).alias("hub"))
        .distinct()
    )


def _wishes(links: DataFrame, state: DataFrame) -> DataFrame:
    """``id, want``: the label most weight of a document's hubs holds, a hub's being that of most of its members."""
    votes = links.join(state, "id").groupBy("hub", "label").agg(F.count("*").alias("n"))
    tie = F.xxhash64("hub", "label")
    hubs = votes.groupBy("hub").agg(F.max_by(F.struct("label", "n"), F.struct("n", tie.alias("t"))).alias("top"))
    return (
        links.join(hubs, "hub")
        .groupBy("id", F.col("top.label").alias("want"))
        .agg(F.sum("top.n").alias("n"))
        .groupBy("id")
        .agg(F.max_by("want", F.struct("n", F.xxhash64("id", "want").alias("t"))).alias("want"))
    )


def propagate(links: DataFrame, total: int, n_shards: int, rounds: int = 8, settle: bool = True) -> DataFrame:
    """``links(id, hub)`` to ``(id, unit, label)``: a shard for every linked document.

    ``total`` counts all documents, linked or not; ``total / n_shards`` is the quota of a shard.
    Ends when no document wants to move, or after ``rounds``; then, with ``settle``, all that still
    want to move do, and it is left to the evening out to move whole units out of full shards.
    """
    quota = total / n_shards
    links = store(links, "links")
    state = store(
        links.groupBy("id")
        .agg(F.min("hub").alias("unit"))
        .withColumn("label", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int")),
        "shards",
    )
    for turn in range(rounds):
        wanted = store(state.join(_wishes(links, state), "id"), "wishes")
        moves = wanted.filter("want <> label")
        if moves.isEmpty():
            drop_stored(wanted)
            settle = False
            break
        flows = moves.groupBy(F.col("label").alias("s"), F.col("want").alias("t")).agg(F.count("*").alias("n"))
        back = flows.select(F.col("s").alias("t"), F.col("t").alias("s"), F.col("n").alias("back"))
        filled = wanted.groupBy(F.col("label").alias("t")).agg(F.count("*").alias("filled"))
        pairs = (
            flows.join(back, ["s", "t"], "left")
            .join(filled, "t", "left")
            .select(
                "s", "t", "n",
                F.least("n", F.coalesce("back", F.lit(0))).alias("swap"),
                F.greatest(F.lit(quota) - F.coalesce("filled", F.lit(0)), F.lit(0.0)).alias("room"),
            )
        )
        extra = pairs.groupBy("t").agg(F.sum(F.col("n") - F.col("swap")).alias("extra"))
        share = F.least(F.lit(1.0), F.col("room") / F.greatest("extra", F.lit(1)))
        rates = pairs.join(extra, "t").select(
            F.col("s").alias("label"), F.col("t").alias("want"),
            ((F.col("swap") + (F.col("n") - F.col("swap")) * share) / F.col("n")).alias("rate"),
        )
        admitted = (F.col("want") != F.col("label")) & (unit_hash(F.col("unit"), F.lit(turn)) < F.coalesce("rate", F.lit(0.0)))
        after = store(
            wanted.join(F.broadcast(rates), ["label", "want"], "left")  # n_shards squared rows at most
            .select("id", "unit", F.when(admitted, F.col("want")).otherwise(F.col("label")).alias("label")),
            "shards",
        )
        drop_stored(wanted)
        drop_stored(state)
        state = after
    if settle:
        state = store(state.join(_wishes(links, state), "id").select("id", "unit", F.col("want").alias("label")), "shards")
    drop_stored(links)
    return state.select("id", "unit", "label")


def even_out(nodes: DataFrame, n_shards: int) -> DataFrame:
    """``nodes(id, unit, label, ...)`` to the same rows with ``shard`` and ``slot``; counts differ by one at most.

    Linked documents stay in their shard up to its quota; the rest, and all unlinked rows (label
    null), fill what the shards lack. Slots run from 0 without gaps.
    """
    order = [F.col("label").asc_nulls_last(), F.col("unit"), F.xxhash64("id"), F.col("id")]
    placed = ranked(nodes, order, "placed")
    counts = {r["label"]: r["n"] for r in placed.groupBy("label").agg(F.count("*").alias("n")).collect()}  # n_shards + 1 rows
    total = sum(counts.values())
    quota = [(s + 1) * total // n_shards - s * total // n_shards for s in range(n_shards)]
    have = [counts.get(s, 0) for s in range(n_shards)]
    starts, kept, over, lacks = [0], [], [0], [0]
    for q, n in zip(quota, have):
        starts.append(starts[-1] + n)
        kept.append(min(q, n))
        over.append(over[-1] + max(0, n - q))
        lacks.append(lacks[-1] + max(0, q - n))

    def of(values, index):
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)

    group = F.coalesce("label", F.lit(n_shards))  # unlinked rows come after the last shard
    place = F.col("rank") - of(starts, group)
    stays = place < of([*kept, 0], group)
    index = of(over, group) + place - of([*kept, 0], group)
    goes = F.size(F.filter(F.array(*[F.lit(v).cast("long") for v in lacks[1:]]), lambda end: end <= F.col("_over")))
    return (
        placed.withColumn("_stays", stays)
        .withColumn("_place", place)
        .withColumn("_over", index)
        .withColumn("shard", F.when(F.col("_stays"), F.col("label")).otherwise(goes).cast("int"))
        .withColumn(
            "slot",
            F.when(F.col("_stays"), F.col("_place")).otherwise(
                F.col("_over") - of(lacks, F.col("shard")) + of([*kept, 0], F.col("shard"))
            ),
        )
        .drop("_stays", "_place", "_over", "rank")
    )


def in_order(placed: DataFrame, n_shards: int) -> DataFrame:
    """``placed(id, size, text_crc32, shard, position)`` with ``slot``s by the position within each shard."""
    rows = ranked(placed, [F.col("shard"), F.col("position").asc_nulls_last(), F.xxhash64("id"), F.col("id"), F.col("text_crc32"), F.col("size")], "ordered")
    counts = rows.groupBy("shard").agg(F.count("*").alias("n")).collect()  # n_shards rows
    starts = [sum(r["n"] for r in counts if r["shard"] < s) for s in range(n_shards)]
    start = F.element_at(F.array(*[F.lit(v).cast("long") for v in starts]), F.col("shard") + 1)
    return rows.withColumn("slot", F.col("rank") - start).drop("rank", "position")


def file_place() -> Column:
    """Where a row of a Parquet table stands: number of its file and place in it.

    A table that was written from sorted ranges has its rows in order of this.
    """
    name = F.col("_metadata.file_name")
    part, piece = (F.coalesce(F.regexp_extract(name, p, 1).try_cast("long"), F.lit(0)) for p in (r"part-(\d+)", r"-c(\d+)"))
    return F.struct(part.alias("part"), piece.alias("piece"), F.col("_metadata.row_index").alias("row"))


def shard(
    docs: DataFrame, n_shards: int = 40, rounds: int = 8, id_col: str = "doc_id", text_col: str = "text", places: DataFrame | None = None, place: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, shard, slot``; equal texts are linked.

    Null texts have size 16 and the checksum of nothing, and link with nothing. Repeated rows are
    rows of their own; a null id is never linked. With ``place``, a value of each row of ``docs``, or
    with ``places(id, position)``, a shard's slots are in that order. An empty table gives an empty result.
    """
    raw = F.encode(F.col(text_col), "UTF-8")
    slim = store(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16).alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
            F.unhex(F.md5(raw)).alias("group"),
            *([] if place is None else [place.alias("position")]),
        ),
        "slim",
    )
    total = slim.count()
    hubs = text_hubs(slim.filter("group is not null").select("id", "group"), n_shards)
    labels = propagate(hubs, total, n_shards, rounds)
    nodes = slim.drop("group").join(labels, "id", "left")
    placed = even_out(nodes, n_shards)
    if places is not None:
        first = places.select("id", "position").groupBy(F.col("id").alias("_id")).agg(F.min("position").alias("position"))
        placed = placed.join(first.hint("merge"), F.col("id").eqNullSafe(F.col("_id")), "left")
    if places is not None or place is not None:
        placed = in_order(placed.select("id", "size", "text_crc32", "shard", "position"), n_shards)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
