"""Documents that hold passages of a benchmark, found by the q-gram lemma.

Text is lower-cased and white space runs become one space. A window of ``window`` characters of an
item that occurs in a document with at most ``edits`` character edits shares at least
``window + 1 - q * (edits + 1)`` of its q-grams with it, and all of these lie within ``edits``
neighbouring diagonals (document place minus item place). Diagonals are counted in bands of twice
that width that overlap by half, so one band holds them all; only windows of bands that reach the
count are aligned, by banded edit distance, and kept if the distance is within ``edits``. Every
document has bands of its own, so what is found does not depend on which ones are scanned together.

The benchmark is a stated query set: its items are dealt into blocks of a proven size, and each
block's index goes to the tasks that scan the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

Q = 8
WINDOW = 80
EDIT_RATE = 0.1
BLOCK_CHARS = 1_000_000
_CHUNK_CHARS = 1_000_000
_BITS = 20
_SPACES = re.compile(r"\s+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> str:
    return _SPACES.sub(" ", text.lower()).strip() if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def qgrams(points: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of every q-gram, by place."""
    n = len(points) - q + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    wide = points.astype(np.uint64) + np.uint64(1)
    for i in range(q):
        out *= _ODD
        out += wide[i : i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def banded(item: np.ndarray, text: np.ndarray, starts: np.ndarray, window: int, low: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each window of ``item`` to any stretch of ``text`` on the diagonals
    ``low .. low + bands - 1``, and where that stretch ends."""
    far = np.int32(1 << 20)
    diagonals = low + np.arange(bands)
    place = starts[:, None] + diagonals[None, :]  # the stretch may start at any of these
    cost = np.where((place >= 0) & (place <= len(text)), np.int32(0), far)
    step = np.arange(bands, dtype=np.int32)
    for i in range(window):
        at = place + i
        inside = (at >= 0) & (at < len(text))
        same = text[np.clip(at, 0, max(0, len(text) - 1))] == item[starts + i][:, None]
        best = np.where(inside, cost + np.where(same, 0, 1).astype(np.int32), far)  # both advance
        best[:, :-1] = np.minimum(best[:, :-1], cost[:, 1:] + 1)  # the item's character is missing in the text
        cost = np.minimum.accumulate(best - step, axis=1) + step  # the text has characters more
        cost = np.where((at + 1 >= 0) & (at + 1 <= len(text)), cost, far)
    least = cost.argmin(axis=1)
    return cost[np.arange(len(starts)), least], starts + window + diagonals[least]


class Index:
    """The q-grams of one block of items, as sorted hash arrays with postings."""

    def __init__(self, items: list[tuple[object, str]], q: int, window: int, edit_rate: float):
        self.q, self.ids = q, [i for i, _ in items]
        self.points = [codes(t) for _, t in items]
        self.windows = [min(window, len(p)) for p in self.points]
        self.edits = [max(0, min(int(edit_rate * w), w // q - 1)) for w in self.windows]  # so many leave a q-gram untouched
        self.needs = [w + 1 - q * (e + 1) for w, e in zip(self.windows, self.edits)]
        grams = [qgrams(p, q) if need > 0 else np.empty(0, np.uint64) for p, need in zip(self.points, self.needs)]
        every = np.concatenate([*grams, np.empty(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        self.hashes, first = np.unique(every, return_index=True)
        sorted_first = np.searchsorted(every[order], self.hashes)
        self.begin = np.append(sorted_first, len(every))
        self.item = np.concatenate([np.full(len(g), i, np.int32) for i, g in enumerate(grams)] + [np.empty(0, np.int32)])[order]
        self.place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams] + [np.empty(0, np.int32)])[order]
        self.seen = np.zeros(1 << _BITS, dtype=bool)
        self.seen[self.hashes >> np.uint64(64 - _BITS)] = True
        self.half = np.maximum(np.array([*self.edits, 0]), 1)
        self.need = np.array([*self.needs, 0])
        self.least = min([n for n in self.needs if n > 0], default=0)
        self.reach = max([w + e for w, e in zip(self.windows, self.edits)], default=0)

    def copied(self, i: int, w: int, text: np.ndarray, windows: np.ndarray, diagonals: np.ndarray) -> tuple[int, int] | None:
        """The first window that stands unchanged on one of the diagonals of a text, and where it ends."""
        for s in windows:
            for d in diagonals:
                if d + s >= 0 and np.array_equal(text[d + s : d + s + w], self.points[i][s : s + w]):
                    return int(s), int(d + s + w)
        return None

    def scan(self, texts: list[str]) -> Iterator[tuple[int, object, int, int, int]]:
        """``(text, item, edits, item_start, text_end)`` of the best window of each text and item."""
        gap = np.full(max(self.edits, default=0) + 1, 0xFFFFFFFF, dtype="<u4")  # no window within its edits spans two texts
        points = [codes(t) for t in texts]
        begins = np.concatenate([[0], np.cumsum([len(p) + len(gap) for p in points])])[:-1]
        flat = np.concatenate([x for p in points for x in (p, gap)])
        grams = qgrams(flat, self.q)
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _BITS)])
        if not len(at) or not len(self.hashes):
            return
        hit = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        good = self.hashes[hit] == grams[at]
        at, hit = at[good], hit[good]
        # A place counts only if some stretch of one window around it holds enough shared q-grams.
        ahead = np.searchsorted(at, at + self.reach, "left") - np.arange(len(at))
        starts = np.flatnonzero(ahead >= self.least)
        if not len(starts):
            return
        mark = np.zeros(len(at) + 1, dtype=np.int64)
        np.add.at(mark, starts, 1)
        np.add.at(mark, starts + ahead[starts], -1)
        dense = np.cumsum(mark[:-1]) > 0
        at, hit = at[dense], hit[dense]
        counts = self.begin[hit + 1] - self.begin[hit]
        post = np.repeat(self.begin[hit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        item, place = self.item[post], self.place[post]
        half = self.half[item]
        where = np.repeat(at, counts)
        text = np.repeat(np.searchsorted(begins, at, "right") - 1, counts)
        where = where - begins[text]  # places within the text
        diagonal = (where - place) // half  # in half bands
        # Item, text and band side by side in one number: a chunk of many texts is short, a long one is a text alone.
        reach = max([len(p) for p in self.points], default=0) + 2
        band_bits, text_bits = int(2 * (len(flat) + reach)).bit_length() + 1, len(texts).bit_length()
        whose = (item.astype(np.int64) << (band_bits + text_bits)) + (text.astype(np.int64) << band_bits) + len(flat) + reach
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for shift in (0, 1):  # bands of twice the width, overlapping by half
            band = (diagonal + shift) // 2 * 2 - shift
            key = whose + band
            # Few bands hold enough: count them in hashed bins first, and sort what is left.
            bins = ((key.astype(np.uint64) * _ODD) >> np.uint64(64 - _BITS)).astype(np.int64)
            left = np.flatnonzero(np.bincount(bins, minlength=1 << _BITS)[bins] >= self.need[item])
            left = left[np.lexsort((place[left], key[left]))]
            cut = np.flatnonzero(np.diff(key[left])) + 1
            edges = np.concatenate([[0], cut, [len(left)]]) if len(left) else np.zeros(1, int)
            for g in np.flatnonzero(np.diff(edges) >= self.need[item[left[edges[:-1]]]]):
                own = left[edges[g] : edges[g + 1]]
                i, w, e = int(item[own[0]]), self.windows[item[own[0]]], self.edits[item[own[0]]]
                p = np.unique(place[own])
                windows = np.arange(len(self.points[i]) - w + 1)
                shared = np.searchsorted(p, windows + w - self.q, "right") - np.searchsorted(p, windows, "left")
                windows = windows[shared >= self.need[i]]
                if not len(windows):
                    continue
                d = int(text[own[0]])
                if best.get((d, i), (1,))[0] == 0 and best[d, i][1] <= windows[0]:
                    continue
                if found := self.copied(i, w, points[d], windows[shared[shared >= self.need[i]] == w + 1 - self.q], np.unique(where[own] - place[own])):
                    best[d, i] = min((0, *found), best.get((d, i), (0, *found)))
                    continue
                width = int(self.half[i])
                cost, end = banded(self.points[i], points[d], windows, w, int(band[own[0]]) * width, 2 * width)
                for k in np.flatnonzero(cost <= e):
                    found = (int(cost[k]), int(windows[k]), int(end[k]))
                    best[d, i] = min(found, best.get((d, i), found))
        for (d, i), (cost, start, end) in sorted(best.items()):
            yield d, self.ids[i], cost, start, end


def chunks(texts: list[str], most: int = _CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``most`` characters, with the place of the first."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > most:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, texts[begin:]


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, dealt by a hash."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null").distinct()
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // BLOCK_CHARS)
    for block in range(n):
        own = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == block).collect()
        if own:
            yield sorted(((r["i"], normal(r["t"])) for r in own), key=repr)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", q: int = Q, window: int = WINDOW, edit_rate: float = EDIT_RATE,
) -> DataFrame:
    """``doc_id, item_id, edits, item_start, text_end`` for every row of ``docs`` and item that meet.

    ``item_start`` and ``text_end`` are places in the normalised texts of the best window: fewest
    edits, then first. A window of w characters may have ``edit_rate * w`` edits, but no more than
    leave one q-gram untouched; an item shorter than ``window`` is one window itself, and one shorter
    than ``q`` matches nothing. Null and empty texts match nothing, repeated
    rows and items give repeated findings per row and one per distinct item row. An empty benchmark
    or empty table gives an empty result.
    """
    id_type, item_type = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField(item_col, item_type), T.StructField("edits", T.IntegerType()), T.StructField("item_start", T.IntegerType()), T.StructField("text_end", T.IntegerType())])
    kinds = [to_arrow_type(f.dataType) for f in schema]
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def scan(items):
        def run(batches):
            index = Index(items, q, window, edit_rate)
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [normal(t) for t in batch.column(1).to_pylist()]
                for begin, part in chunks(texts):
                    found = [(ids[begin + d], i, c, s, e) for d, i, c, s, e in index.scan(part)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], names=schema.names)

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for items in blocks(benchmark, item_col, item_text_col):
        out = out.union(slim.mapInArrow(scan(items), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", q: int = Q, window: int = WINDOW, edit_rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs``, all their columns, whose text meets no item; nothing is shuffled.

    Null and empty texts meet nothing and stay, repeated rows all stay or go, and an empty benchmark
    or empty table changes nothing. Texts of any length are scanned whole.
    """
    at = docs.columns.index(text_col)

    def keep(items):
        def run(batches):
            index = Index(items, q, window, edit_rate)
            for batch in batches:
                texts = [normal(t) for t in batch.column(at).to_pylist()]
                hit = {begin + found[0] for begin, part in chunks(texts) for found in index.scan(part)}
                yield batch.filter(pa.array([i not in hit for i in range(len(texts))], pa.bool_()))

        return run

    for items in blocks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(keep(items), docs.schema)
    return docs
