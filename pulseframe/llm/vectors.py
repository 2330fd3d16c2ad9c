"""Near-duplicate vectors by cosine, over an inverted multi-index.

A unit vector is cut into halves, each half has a codebook of its own, and the pairs of nearest
codes are the cells of a product grid. A vector looks into cells in order of distance (the sum of its
halves' distances to the two codes, walked by the multi-sequence algorithm) until it has seen
``probes`` of them; how many are needed is measured: for a sample of vectors, at which step of the
walk the cells of all their true neighbours come. Sampled vectors that link with each other count
as one, so a large group of near copies does not outvote the small ones; sampling goes on until
``PROBE_GROUPS`` linked ones are met. Where fewer are, vectors planted at the bound itself decide.
Candidates are verified by the cosine in double precision.

Equal vectors are one vector that counts several times. Neighbouring cells with the same first code
form a group of about ``BLOCK`` rows, and a vector is sent once to each group it looks into, with the list of
its cells there: the codes it visits grow with the square root of its cells, and so do its copies. Of two
vectors the one with the smaller id looks for the other, so every pair is met once. Both sides of a
group are dealt into blocks of a fixed size, so a cell with a third of all vectors
becomes many tasks of one size. A block returns counts and, for each cell's local groups, one edge a
member, never its pairs.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import components, drop_stored, store

SIMILARITY = 0.9
TARGET_RECALL = 0.995
# Vectors that fit the codebooks, at most.
FIT_SAMPLE = 20_000
# Vectors whose neighbours set the number of probes: at first, at most, and the linked groups among them that are enough.
PROBE_SAMPLE = 400
MOST_PROBE_SAMPLE = 2400
PROBE_GROUPS = 200
# Distances are counted in steps of this size, rounded up.
DISTANCE_STEP = 1 / 4096
PER_CELL = 50
MOST_CODES = 1024
# A walk visits so many cells at least, where there are as many.
LEAST_PROBES = 64
# Rows of one side of a block, and of a group of cells, about.
BLOCK = 2000
_U = np.uint64


@dataclass
class Grid:
    """The two codebooks, and how many cells a vector looks into."""

    first: np.ndarray
    second: np.ndarray
    probes: int = 1

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return squared(x[:, :cut], self.first), squared(x[:, cut:], self.second)

    def walks(self, x: np.ndarray, cells: int) -> np.ndarray:
        """The nearest ``cells`` cells of each vector, nearest first."""
        da, db = self.distances(x)
        oa, ob = np.argsort(da, axis=1, kind="stable"), np.argsort(db, axis=1, kind="stable")
        sa, sb = np.take_along_axis(da, oa, 1), np.take_along_axis(db, ob, 1)
        return np.array([walk(sa[i], sb[i], oa[i], ob[i], cells) for i in range(len(x))], dtype=np.int64).reshape(len(x), -1)


def walk(a: np.ndarray, b: np.ndarray, codes_a: np.ndarray, codes_b: np.ndarray, cells: int) -> list[int]:
    """Multi-sequence traversal: cells by rising ``a[i] + b[j]`` of two sorted lists."""
    out, front, last = [], [(a[0] + b[0], 0, 0)], {}
    while front and len(out) < cells:
        _, i, j = heapq.heappop(front)
        out.append(int(codes_a[i]) * len(b) + int(codes_b[j]))
        last[i] = j + 1  # columns of row i that are done
        if i + 1 < len(a) and last.get(i + 1, 0) == j:
            heapq.heappush(front, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or last.get(i - 1, 0) > j + 1):
            heapq.heappush(front, (a[i] + b[j + 1], i, j + 1))
    return out


def squared(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ codes.T + (codes**2).sum(1)[None, :], 0)


def codebook(x: np.ndarray, codes: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly taken rows."""
    centers = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        own = squared(x, centers).argmin(1)
        n = np.bincount(own, minlength=codes)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision."""
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(1))[:, None]


def units(column: pa.Array) -> np.ndarray:
    """:func:`unit_rows` of a column of lists of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return unit_rows(column.flatten().to_numpy().reshape(len(column), -1)) if len(column) else np.empty((0, 0))


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector has a direction: not null or empty, all components finite, not all zero."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.filter(v.isNotNull()).filter(~F.coalesce(bad, F.lit(True))).filter(F.exists(v, lambda e: e != 0))


def fitted(rows: DataFrame, count: int, dim: int, least: float) -> Grid:
    """Codebooks of ``rows(id, v)`` and the number of probes that reaches the target recall."""
    codes = int(min(MOST_CODES, max(1, round((count / PER_CELL) ** 0.5))))
    most = max(64, min(FIT_SAMPLE, 4_000_000 // dim))
    order = [F.xxhash64(F.lit("codes"), "id"), F.col("id")]
    sample = rows.orderBy(*order).limit(most).toArrow()
    x = units(sample.column("v"))
    codes = min(codes, len(x))
    cut = max(1, dim // 2)
    grid = Grid(codebook(x[:, :cut], codes), codebook(x[:, cut:], codes) if dim > 1 else np.zeros((codes, 0)))
    grid.probes = probes_of(grid, rows, count, np.array(sample.column("id").to_pylist()), x, least)
    return grid


def neighbours(grid: Grid, rows: DataFrame, ids: np.ndarray, queries: np.ndarray, least: float) -> pd.DataFrame:
    """``query, step, n``: how many links of a query lie in cells that its walk has seen by that step."""

    def far(batches):
        da, db = grid.distances(queries)
        for batch in batches:
            every, other = units(batch.column(1)), np.array(batch.column(0).to_pylist())
            for at in range(0, len(every), 1000):
                y = every[at : at + 1000]
                q, r = np.nonzero((queries @ y.T >= least) & (ids[:, None] != other[None, at : at + 1000]))
                if not len(q):
                    continue
                ya, yb = grid.distances(y)
                d = da[q, ya.argmin(1)[r]] + db[q, yb.argmin(1)[r]]
                found, n = np.unique(np.stack([q, np.ceil(d / DISTANCE_STEP).astype(np.int64)]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1]), pa.array(n.astype(np.int64))], names=["query", "far", "n"])

    seen = rows.select("id", "v").mapInArrow(far, "query long, far long, n long").groupBy("query", "far").agg(F.sum("n").alias("n")).toPandas()
    da, db = (np.sort(d, axis=1) for d in grid.distances(queries))
    seen["step"] = [
        int(np.searchsorted(db[q], f * DISTANCE_STEP * (1 + 1e-9) - da[q], "right").sum()) for q, f in zip(seen["query"], seen["far"])
    ]
    return seen[["query", "step", "n"]]


def planted_steps(grid: Grid, x: np.ndarray, least: float) -> np.ndarray:
    """Steps at which the walks of ``x`` come to neighbours planted at the bound: one towards another row, one anywhere."""
    rng = np.random.default_rng(1)
    out = []
    for towards in (x[rng.permutation(len(x))], rng.normal(size=x.shape)):
        side = towards - (towards * x).sum(1)[:, None] * x
        length = np.sqrt((side * side).sum(1))[:, None]
        side = np.divide(side, length, out=np.zeros_like(side), where=length > 1e-9)
        y = least * x + np.sqrt(1 - least * least) * side
        (da, db), (ya, yb) = grid.distances(x), grid.distances(y / np.sqrt((y * y).sum(1))[:, None])
        at = np.arange(len(x))
        far = (da[at, ya.argmin(1)] + db[at, yb.argmin(1)]) * (1 + 1e-9)
        out += [int(np.searchsorted(np.sort(b), f - a, "right").sum()) for a, b, f in zip(da, db, far)]
    return np.array(out)


def reached(steps: np.ndarray, weights: np.ndarray) -> int:
    """The step by which the target share of the weights has come."""
    order = np.argsort(steps, kind="stable")
    share = np.cumsum(weights[order]) / weights.sum()
    return int(steps[order][min(len(steps) - 1, np.searchsorted(share, TARGET_RECALL))])


def probes_of(grid: Grid, rows: DataFrame, count: int, ids: np.ndarray, x: np.ndarray, least: float) -> int:
    """The number of probes by which links and groups alike reach the target recall.

    The first sample is taken as it comes. Later ones leave out vectors that link with one sampled
    before, whose group has been measured. A group's links share one vote; counted singly, they must
    reach the target too.
    """
    taken = fresh = np.arange(min(PROBE_SAMPLE, len(x)))
    known = np.zeros(len(x), dtype=bool)
    seen = neighbours(grid, rows, ids[taken], x[taken], least)
    while True:
        groups = groups_of(x[taken] @ x[taken].T >= least)
        met = len(np.unique(groups[seen["query"].to_numpy()]))
        more = min(MOST_PROBE_SAMPLE - len(taken), max(PROBE_SAMPLE, -(-len(taken) * (PROBE_GROUPS - met) // max(1, met))))
        for at in range(0, len(fresh), 100):
            known |= (x @ x[fresh[at : at + 100]].T >= least).any(1)
        known[fresh] = True
        fresh = np.nonzero(~known)[0][: max(0, more)]
        if met >= PROBE_GROUPS or not len(fresh):
            break
        found = neighbours(grid, rows, ids[fresh], x[fresh], least)
        found["query"] += len(taken)
        seen, taken = pd.concat([seen, found], ignore_index=True), np.concatenate([taken, fresh])
    enough = 4
    if len(seen):
        steps, n = seen["step"].to_numpy(), seen["n"].to_numpy(dtype=float)
        group = groups[seen["query"].to_numpy()]
        first = (seen["query"] < PROBE_SAMPLE).to_numpy()
        enough = reached(steps, n / np.bincount(group, n)[group])
        if first.any():
            enough = max(enough, reached(steps[first], n[first]))
    if met < PROBE_GROUPS and len(taken) < count:  # too few links to go by
        planted = planted_steps(grid, x[taken], least)
        enough = max(enough, reached(planted, np.ones(len(planted))))
    return int(min(len(grid.first) * len(grid.second), max(LEAST_PROBES, -(-enough * 3 // 2))))


def groups_of(links: np.ndarray) -> np.ndarray:
    """The smallest row that links reach, for each row of a symmetric matrix that links rows with themselves."""
    head = np.arange(len(links))
    while True:
        low = np.where(links, head[None, :], len(links)).min(1)
        if (low == head).all():
            return head
        head = low


@dataclass
class Layout:
    """Which group a cell belongs to, -1 without rows, and how many blocks its two sides have: arrays of a proven size."""

    group: np.ndarray  # by cell, at most the square of ``MOST_CODES`` of them
    row_blocks: np.ndarray  # by group
    ask_blocks: np.ndarray | None = None


def grouped_cells(grid: Grid, cells: np.ndarray, rows: np.ndarray) -> Layout:
    """Groups of cells with one first code: neighbours by their second one, until ``BLOCK`` rows are reached."""
    second = len(grid.second)
    held = np.zeros((len(grid.first), second), dtype=np.int64)
    held[cells // second, cells % second] = rows
    spread = grid.second - grid.second.mean(0)
    along = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0] if spread.size else np.zeros(second), kind="stable")
    before = np.cumsum(held[:, along], axis=1) - held[:, along]
    part = np.empty_like(held)
    part[:, along] = before // BLOCK
    named = np.arange(len(held))[:, None] * (part.max() + 1) + part
    found, group = np.unique(np.where(held > 0, named, -1), return_inverse=True)
    group = group.reshape(-1) - (found[0] < 0)
    size = np.bincount(group[cells], rows, int(group.max()) + 1)
    return Layout(group.astype(np.int32), np.ceil(size / BLOCK).astype(np.int64))


def asked(probes: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each vector's groups as ``(vector, group, first, cells)``: the cells it looks into there begin at ``first`` of ``cells``."""
    group = layout.group[probes]
    order = np.argsort(group, axis=1, kind="stable")
    group, cells = np.take_along_axis(group, order, 1).reshape(-1), np.take_along_axis(probes, order, 1).reshape(-1)
    vector = np.repeat(np.arange(len(probes)), probes.shape[1])
    vector, group, cells = (x[group >= 0] for x in (vector, group, cells))
    first = np.flatnonzero(np.diff(vector, prepend=-1).astype(bool) | np.diff(group, prepend=-1).astype(bool))
    return vector[first], group[first], first, cells


def dealt(ids: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of each id among so many."""
    x = ids.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return ((x >> _U(20)) % blocks.astype(_U)).astype(np.int64)


def copies(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place so often, and the number of the copy."""
    at = np.repeat(np.arange(len(times)), times)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)


def block_links(least: float):
    """Counts and group edges of one block: queries ``q`` with the cells they look into, rows ``r`` of these cells."""

    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": pd.Series(dtype="int64"), "n": pd.Series(dtype="int64"), "head": pd.Series(dtype="int64")})]
        if not len(q) or not len(r):
            return out[0]
        r = r.sort_values("own", kind="stable")
        x, y = (unit_rows(np.stack(side["v"].to_numpy())) for side in (q, r))
        qi, ri, q_times, r_times = q["id"].to_numpy(), r["id"].to_numpy(), q["times"].to_numpy(), r["times"].to_numpy()
        lists = q["cells"].to_numpy()
        wanted, who = np.concatenate(lists), np.repeat(np.arange(len(q)), [len(c) for c in lists])
        order = np.argsort(wanted, kind="stable")
        wanted, who = wanted[order], who[order]
        cells, first = np.unique(r["own"].to_numpy(), return_index=True)
        big = np.iinfo(np.int64).max
        for cell, begin, end in zip(cells, first, [*first[1:], len(r)]):
            a = who[np.searchsorted(wanted, cell, "left") : np.searchsorted(wanted, cell, "right")]
            hit = (x[a] @ y[begin:end].T >= least) & (qi[a][:, None] < ri[None, begin:end])
            some_q, some_r = hit.any(1), hit.any(0)
            if not some_q.any():
                continue
            hit, a, b = hit[some_q][:, some_r], a[some_q], np.arange(begin, end)[some_r]
            head_q, head_r = qi[a], ri[b]
            while True:
                to_q = np.minimum(head_q, np.where(hit, head_r[None, :], big).min(1))
                to_r = np.minimum(head_r, np.where(hit, to_q[:, None], big).min(0))
                if (to_q == head_q).all() and (to_r == head_r).all():
                    break
                head_q, head_r = to_q, to_r
            for ids, n, head in ((qi[a], hit @ r_times[b], head_q), (ri[b], q_times[a] @ hit, head_r)):
                out.append(pd.DataFrame({"id": ids, "n": n.astype(np.int64), "head": head}))
        return pd.concat(out, ignore_index=True)

    return lambda key, q, r: run(q, r)


def linked(rows: DataFrame, count: int, dim: int, least: float) -> DataFrame:
    """``id, n, head`` of blocks over ``rows(id, v, times)`` of ``dim`` components."""
    grid = fitted(rows, count, dim, least)
    v_type = rows.schema["v"].dataType.simpleString()

    def placed(batches):
        g = grid
        for batch in batches:
            probes = g.walks(units(batch.column(1)), g.probes).astype(np.int32)  # the vector's own cell comes first
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(probes) + 1, dtype=np.int32) * probes.shape[1]), pa.array(probes.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(probes[:, 0] if len(probes) else [], pa.int32()), lists], names=["id", "v", "times", "own", "probes"])

    items = store(rows.select("id", "v", "times").mapInArrow(placed, f"id long, v {v_type}, times long, own int, probes array<int>"), "vectors")
    held = items.groupBy("own").agg(F.count("*").alias("n")).collect()  # a row a cell
    layout = grouped_cells(grid, np.array([r["own"] for r in held], dtype=np.int64), np.array([r["n"] for r in held], dtype=np.int64))

    def matrix(column) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), -1)

    def asking(batches):
        total = np.zeros(len(layout.row_blocks), dtype=np.int64)
        for batch in batches:
            if len(batch):
                total += np.bincount(asked(matrix(batch.column(0)), layout)[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["grp", "n"])

    asks = items.select("probes").mapInArrow(asking, "grp long, n long").groupBy("grp").agg(F.sum("n").alias("n")).collect()  # a row a group
    layout.ask_blocks = np.ones(len(layout.row_blocks), dtype=np.int64)
    for r in asks:
        layout.ask_blocks[r["grp"]] = -(-r["n"] // BLOCK)

    def queries(batches):
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                vector, group, first, cells = asked(matrix(batch.column(4)), layout)
                ids = batch.column(0).to_numpy()[vector]
                size = np.diff(np.append(first, len(cells)))
                row, rb = copies(layout.row_blocks[group])  # to every block of the group's rows
                _, place = copies(size[row])
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[row])).astype(np.int32)), pa.array(cells[np.repeat(first[row], size[row]) + place]))
                qb = dealt(ids, layout.ask_blocks[group])[row]
                picked = pa.array(vector[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group[row].astype(np.int64)), pa.array(qb), pa.array(rb), *[batch.column(i).take(picked) for i in (0, 1, 2)], lists], names=["grp", "qb", "rb", "id", "v", "times", "cells"]
                )

    def members(batches):
        for batch in batches:
            group = layout.group[batch.column(3).to_numpy()]
            row, qb = copies(layout.ask_blocks[group])  # to every block of those who ask
            rb = dealt(batch.column(0).to_numpy(), layout.row_blocks[group])[row]
            picked = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[row].astype(np.int64)), pa.array(qb), pa.array(rb), *[batch.column(i).take(picked) for i in (0, 1, 2, 3)]], names=["grp", "qb", "rb", "id", "v", "times", "own"]
            )

    keys = ["grp", "qb", "rb"]
    place = "grp long, qb long, rb long, id long"
    ask_rows = items.mapInArrow(queries, f"{place}, v {v_type}, times long, cells array<int>")
    member_rows = items.select("id", "v", "times", "own").mapInArrow(members, f"{place}, v {v_type}, times long, own int")
    return ask_rows.groupBy(*keys).cogroup(member_rows.groupBy(*keys)).applyInPandas(block_links(least), "id long, n long, head long")


def near_vectors(vectors: DataFrame, least: float = SIMILARITY, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every distinct row of ``vectors``.

    ``n_links`` counts the other vectors of cosine ``least`` or more, ``component_id`` is the
    smallest id that links reach, ``kept`` whether that is the row's own. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing, nor do vectors of different
    lengths with each other. Rows of one id and vector are one vector; of one id with different
    vectors, each row stands for itself under that id. A null id stays null and is nobody's component.
    An empty table gives an empty result.
    """
    kind = "array<float>" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"  # floats travel as floats
    every = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(vec_col).cast(kind).alias("v")).distinct()
    every = store(every, "rows")
    good = usable(every, "v")
    kinds = store(good.groupBy("v").agg(F.min("vec").alias("id"), F.count("*").alias("times")).filter("id is not null"), "kinds")
    found = None
    for r in kinds.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy("dim").collect():
        part = linked(kinds.filter(F.size("v") == r["dim"]), r["n"], r["dim"], least)
        found = part if found is None else found.union(part)
    spark = vectors.sparkSession
    found = store(found if found is not None else spark.createDataFrame([], "id long, n long, head long"), "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("id").alias("a"), F.col("head").alias("b")))
    named = kinds.join(counts, "id", "left").join(groups, "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("component", "id").alias("c")
    )
    return every.join(named, "v", "left").select(
        F.col("vec").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_links"), F.coalesce("c", "vec").alias("component_id"),
        F.coalesce(F.coalesce("c", "vec") == F.col("vec"), F.lit(True)).alias("kept"),
    )
