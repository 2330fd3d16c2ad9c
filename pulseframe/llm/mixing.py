"""Interleave sources at target weights: Pfair windows, earliest deadline first.

A source's documents are cut into blocks of equal row counts. With weight ``a`` of a total of ``W``,
its i-th block (from 1) may run from slot ``floor((i-1)W/a)`` and must have run before slot
``ceil(iW/a)``; of the blocks that may run, the one with the earliest deadline gets the slot. The
weights are the targets themselves, as whole numbers of any length, so every window is met and no
source is ever a whole block ahead of or behind its target, however long the input. When a source
runs out, the others go on with a new phase at their own weights, so every document gets a position
and none is dropped or repeated.

The driver finds where sources end, and nothing in between: where the timetable stands at a slot follows from
the weights (:func:`standing`). So tasks walk segments of ``SEGMENT`` slots, each from where it
begins, and make the blocks' slots a table. Ranks within sources are a distributed sort,
and documents meet their block's slot in a join by source and block.
"""

from __future__ import annotations

import heapq
import json
import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import ranked

# Slots of the timetable that a task walks at a time.
SEGMENT = 100_000


def parts_of(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole shares of a period by largest remainder; every source gets one at least."""
    period = max(period, 2 * len(weights))
    total = sum(weights.values())
    exact = {s: w * period / total for s, w in weights.items()}
    parts = {s: max(1, int(x)) for s, x in exact.items()}
    rest = period - sum(parts.values())
    by_rest = sorted(exact, key=lambda s: (parts[s] - exact[s], s))
    for i in range(max(0, rest)):
        parts[by_rest[i % len(by_rest)]] += 1
    return parts


def exact(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in exactly the same proportions."""
    ratios = {s: w.as_integer_ratio() for s, w in weights.items()}
    common = math.lcm(*[d for _, d in ratios.values()])
    parts = {s: n * (common // d) for s, (n, d) in ratios.items()}
    least = math.gcd(*parts.values())
    return {s: a // least for s, a in parts.items()}


class Timetable:
    """``slot, source, block, release, deadline`` of every block in order of slots, from ``state`` on."""

    def __init__(self, parts: dict[str, int], blocks: dict[str, int], state: tuple | None = None):
        self.parts, self.blocks = parts, blocks
        # The slot a phase starts at, the blocks done before it, and all blocks done.
        self.first, self.before, self.done = state or (0, dict.fromkeys(blocks, 0), dict.fromkeys(blocks, 0))

    def state(self) -> tuple:
        """What the slot given out last started from."""
        return self.first, dict(self.before), dict(self.done)

    def __iter__(self) -> Iterator[tuple[int, str, int, int, int]]:
        parts, blocks, done = self.parts, self.blocks, self.done
        left = {s for s, n in blocks.items() if done[s] < n}
        slot = sum(done.values())
        while left:
            before, first, total = self.before, self.first, sum(parts[s] for s in left)
            waiting = [((done[s] - before[s]) * total // parts[s], s) for s in left]
            heapq.heapify(waiting)
            ready: list[tuple[int, int, str]] = []
            while True:
                while waiting and waiting[0][0] <= slot - first:
                    release, s = heapq.heappop(waiting)
                    heapq.heappush(ready, (-(-(done[s] - before[s] + 1) * total // parts[s]), release, s))
                deadline, release, s = heapq.heappop(ready)
                yield slot, s, done[s], first + release, first + deadline
                done[s] += 1
                slot += 1
                if done[s] == blocks[s]:
                    break
                heapq.heappush(waiting, ((done[s] - before[s]) * total // parts[s], s))
            left.remove(s)
            self.first, self.before = slot, dict(done)


def standing(parts: dict[str, int], live: Iterable[str], slot: int) -> dict[str, int]:
    """How many blocks of each source were given the slots before ``slot`` of a phase, without walking there.

    A source of weight w has done ``floor(slot w)`` blocks or the next one as well, if that was
    released. Which ones are still waiting follows from earliest deadline first, under which blocks due by a
    deadline are served as if the later ones were not there: those that wait are as many as were released since some
    earlier slot beyond the slots there were, for the slot that makes it most. Only slots since the
    earliest release of a waiting block can make a difference, so this looks back one window of the rarest source.
    """
    live = sorted(live)
    total = sum(parts[s] for s in live)
    due = {s: slot * parts[s] // total for s in live}
    released = {s: -(-slot * parts[s] // total) for s in live}
    # Blocks that may be done or not, most urgent first: (deadline, release, source).
    may = sorted((-(-(due[s] + 1) * total // parts[s]), due[s] * total // parts[s], s) for s in live if released[s] > due[s])
    if not may:
        return due
    begin = min(r for _, r, _ in may) + 1
    came = np.zeros(slot - begin + 1, dtype=np.int64)  # blocks released in each slot from there on
    for s in live:
        first = -(-begin * parts[s] // total)
        places = [i * total // parts[s] - begin for i in range(first, released[s])]
        came += np.bincount(np.array(places, dtype=np.int64), minlength=len(came))[: len(came)]
    waits = sum(-(-begin * parts[s] // total) for s in live) - begin + np.concatenate([[0], np.cumsum(came[:-1] - 1)])
    later = np.zeros(len(waits), dtype=np.int64)  # less urgent blocks not yet released
    every = sum(released.values()) - slot
    done = dict(due)
    upto = every  # waiting blocks as urgent as this one or more
    for n, (_, release, s) in enumerate(reversed(may), 1):
        later[: max(0, release - begin + 1)] += 1
        more = every - min(n, int((waits + later).min()))  # those more urgent than it
        done[s] += upto == more  # else it is the one that waits
        upto = more
    return done


def phases(parts: dict[str, int], blocks: dict[str, int]) -> list[tuple[int, dict[str, int]]]:
    """``(first slot, blocks done before it)`` of every phase: up to the next end of a source."""
    done, slot, out = dict.fromkeys(blocks, 0), 0, []
    while live := [s for s, n in blocks.items() if done[s] < n]:
        out.append((slot, dict(done)))
        total = sum(parts[s] for s in live)
        start = min((blocks[s] - done[s] - 1) * total // parts[s] for s in live)  # no last block is released earlier
        way = Timetable(parts, blocks, (slot, dict(done), {**done, **{s: done[s] + n for s, n in standing(parts, live, start).items()}}))
        for slot, s, block, _, _ in way:
            if block + 1 == blocks[s]:
                break
        done, slot = way.done, slot + 1
        done[s] += 1
    return out


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    block_rows: int = 16,
    period: int | None = None,
    smoothing: float = 0.5,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, weight, block, slot, release, deadline, position`` for every row.

    ``weights`` by source; a source without one, or all of them, gets the square root of its rows
    (``smoothing``) relative to the rest. ``position`` runs from 0 without gaps. ``slot``,
    ``release`` and ``deadline`` are places of the block on the common timetable. A null source is
    a source named ``""``. Within a source the order is a hash of the id; repeated rows are rows of
    their own. With a ``period``, weights are rounded to whole parts of it. An empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    # A hash of its own: shards are ranges of the plain one, and each should hold all of the mix.
    order = [F.col("source"), F.xxhash64(F.lit("mix"), "id"), F.col("id")]
    places = ranked(slim, order, "mixing")
    rows = {r["source"]: r["n"] for r in places.groupBy("source").agg(F.count("*").alias("n")).collect()}  # a row a source
    names = sorted(rows, key=lambda s: s.encode())
    targets = {s: float((weights or {}).get(s, rows[s] ** smoothing)) for s in names}
    if any(not 0 < w < math.inf for w in targets.values()):
        raise ValueError("weights must be positive")
    parts = parts_of(targets, period) if names and period else exact(targets)
    blocks = {s: -(-rows[s] // block_rows) for s in names}
    # A source's last block may be short; later positions move up by what it lacks.
    lacks = {s: -rows[s] % block_rows for s in names}
    known = phases(parts, blocks)
    begins, whole, length = [first for first, _ in known], sum(blocks.values()), SEGMENT
    marks = [(at, json.dumps(known[bisect_right(begins, at) - 1])) for at in range(0, whole, length)]

    def slots(batches):
        for frame in batches:
            for at, mark in zip(frame["slot"].tolist(), frame["phase"]):
                first, before = json.loads(mark)
                live = [s for s, n in before.items() if n < blocks[s]]
                done = {**before, **{s: before[s] + n for s, n in standing(parts, live, at - first).items()}}
                moved = sum(lacks[s] for s, n in done.items() if n == blocks[s])
                out = []
                for slot, s, block, release, deadline in Timetable(parts, blocks, (first, before, done)):
                    if slot == at + length:
                        break
                    out.append((s, block, slot, release, deadline, slot * block_rows - moved))
                    if block + 1 == blocks[s]:
                        moved += lacks[s]
                yield pd.DataFrame(out, columns=["source", "block", "slot", "release", "deadline", "base"])

    spark = docs.sparkSession
    segments = spark.createDataFrame(marks, "slot long, phase string").repartition(max(1, len(marks)))
    timetable = segments.mapInPandas(slots, "source string, block long, slot long, release long, deadline long, base long")
    total = sum(parts.values())
    starts = np.cumsum([0, *[rows[s] for s in names]]).tolist()
    sources = spark.createDataFrame([(s, i, parts[s] / total) for s, i in zip(names, starts)], "source string, start long, weight double")
    place = F.col("rank") - F.col("start")
    placed = places.select("id", "source", "rank").join(sources, "source").withColumn("block", F.floor(place / block_rows)).withColumn("offset", place % block_rows)
    return placed.join(timetable, ["source", "block"]).select(
        F.col("id").alias(id_col), "source", "weight", "block", "slot", "release", "deadline", (F.col("base") + F.col("offset")).alias("position")
    )


def in_order(docs: DataFrame, position: Column) -> DataFrame:
    """``docs`` dealt out in ranges of ``position`` and sorted, so files written from it are the mix in order."""
    return docs.repartitionByRange(position).sortWithinPartitions(position)


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, all their columns, in the order of the mix.

    Rows that share an id follow each other at the place of the first.
    """
    own = "_place" + "_" * max([0, *(len(c) for c in docs.columns)])  # no column has this name
    first = mix(docs, id_col=id_col, source_col=source_col, **options).groupBy(F.col(id_col).alias("_id")).agg(F.min("position").alias(own))
    rows = docs.join(first.hint("merge"), docs[id_col].eqNullSafe(first["_id"])).select(*[docs[c] for c in docs.columns], own)
    return in_order(rows, F.col(own)).drop(own)
