"""Perplexity of texts under a class-based bigram model with exchange clustering.

    P(text) = product of P(class of w | class of the word before) * P(w | its class)

Units are clustered: every word that goes to the tasks is one; the rarer ones, and
words never seen, count with those that end in the same two bytes, or with all others where these
are too rare as well. So the number of units has a proven bound while every word has a class.
Exchange starts from classes by frequency and, round by round, moves units to the class that raises
the likelihood of the class bigrams most, until rounds hardly raise it any more. A unit's neighbours are one row, its gains for all classes
are computed in the task that reads the row, and half of the units may move in a round, because
their gains hold while the rest stand still.

Both probabilities are smoothed: transitions by the class frequencies, emissions by one count for
each word and one for an unseen word of the class.

Counts of words come from all training texts. The frequent ones, again of a proven number, go to
every task; the others meet the texts in one join by word, where a row holds a word and the texts of
a chunk it is in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import batches_of, drop_stored, store

CLASSES = 48
# Relative count of the words that go to every task, 250,000 at most; they and groups of rarer words above it are clustered.
HEAD_SHARE = 4e-6
# Exchange ends when two rounds raise the likelihood by less than this many nats a token, or after so many.
LEAST_GAIN = 0.01
ROUNDS = 30
PRIOR = 20.0
END = b""  # no word is empty
_CHUNK_TOKENS = 2_000_000
_CHUNK_BYTES = 3_000_000  # of text whose words are looked up at once
_BATCH_BYTES = 1_000_000  # that go to Python at once
_BATCH_ENTRIES = 100_000  # that come back at once
_OTHER = b"\x00"
FIXED = 0  # the class of the end alone


def tokens(text: str | None) -> list[bytes]:
    """Words between white space, A to Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def training(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) != 2, F.lit(True))


def _chunks(batches, column: int = 0):
    """The batches in pieces of about ``_CHUNK_BYTES`` of text: small ones are put together, large ones cut between rows."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64) + 1)
        start = done = 0
        while start < batch.num_rows:
            stop = min(int(np.searchsorted(ends, done + _CHUNK_BYTES - size)) + 1, batch.num_rows)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - done
            start, done = stop, int(ends[stop - 1])
            if size >= _CHUNK_BYTES:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _encoded(texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """:func:`tokens` of many texts at once: the distinct words, each word's number among these, and its text's."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    coded = lists.flatten().dictionary_encode()
    codes, owners = coded.indices.to_numpy(), pc.list_parent_indices(lists).to_numpy()
    blank = pc.index(coded.dictionary, "").as_py()  # before and after outer white space
    if blank >= 0:
        codes, owners = codes[codes != blank], owners[codes != blank]
    return coded.dictionary.cast(pa.binary()), codes, owners


def _one_coding(parts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of some lists, and the number of each entry's word among these."""
    coded = pa.concat_arrays(parts).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy()


def _pieces(batch: pa.RecordBatch, sizes: np.ndarray | None = None):
    """The batch cut between rows, into pieces of ``_BATCH_ENTRIES`` rows or as many entries of rows of these sizes."""
    ends = np.cumsum(sizes) if sizes is not None else np.arange(1, batch.num_rows + 1)
    start = done = 0
    while start < batch.num_rows:
        stop = max(int(np.searchsorted(ends, done + _BATCH_ENTRIES, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start, done = stop, int(ends[stop - 1])


def _word_counts(batches):
    parts: list[tuple[pa.Array, np.ndarray]] = []
    size = texts = 0

    def flush():
        parts.append((pa.array([END], pa.binary()), np.array([texts])))
        words, codes = _one_coding([w for w, _ in parts])
        n = np.bincount(codes, np.concatenate([n for _, n in parts]), len(words)).astype(np.int64)
        parts.clear()
        whole = pa.RecordBatch.from_arrays([words, pa.array(n)], names=["word", "n"]).filter(pa.array(n > 0))
        yield from _pieces(whole)

    for batch in _chunks(batches):
        words, codes, _ = _encoded(batch.column(0))
        parts.append((words, np.bincount(codes, minlength=len(words))))
        texts += batch.num_rows
        size += len(codes) + batch.num_rows
        if size > _CHUNK_TOKENS:
            yield from flush()
            size = texts = 0
    yield from flush()


@dataclass
class Units:
    """The numbers of the clustered units: 0 is the end, 1 all that has no unit of its own."""

    known: dict[bytes, int]

    def of(self, word: bytes) -> int:
        unit = self.known.get(word)
        if unit is None:
            unit = self.known.get(_OTHER + word[-2:], 1)  # no word starts with this byte and is known by it alone
        return unit


@dataclass
class Model:
    units: Units
    classes: np.ndarray  # by unit
    step: np.ndarray  # log10 P(class | class before)
    room: np.ndarray  # log10 of the counts a class's emissions are shares of
    head: dict[bytes, int]  # counts of the frequent words
    total: int
    types: int


def unit_rows(docs: DataFrame, units: Units) -> DataFrame:
    """``unit, before, n_before, after, n_after, itself``: each unit's neighbours and how often they stand there."""
    many = max(units.known.values(), default=1) + 1

    def pairs(batches):
        cache: dict[bytes, int] = {}
        parts, size = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.int64),) * 2
            parts.clear()
            if len(keys):
                yield from _pieces(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pq", "n"]))

        get = units.known.get
        for batch in _chunks(batches):
            words, codes, owners = _encoded(batch.column(0))
            own = words.to_pylist()
            found = [get(w, -1) for w in own]
            for i in [i for i, u in enumerate(found) if u < 0]:  # words without a unit of their own
                w = own[i][-2:]
                u = cache.get(w)
                if u is None:
                    u = cache[w] = get(_OTHER + w, 1)
                found[i] = u
            row = np.zeros(len(codes) + batch.num_rows + 1, dtype=np.int64)  # the end stands around each text
            row[np.arange(1, len(codes) + 1) + owners] = np.array(found, dtype=np.int64)[codes]
            parts.append(row[:-1] * many + row[1:])
            size += len(row)
            if size > _CHUNK_TOKENS:
                yield from flush()
                size = 0
        yield from flush()

    found = docs.mapInArrow(pairs, "pq long, n long").groupBy("pq").agg(F.sum("n").alias("n"))  # one number is a smaller key than two
    table = store(found.selectExpr(f"int(pq div {many}) AS p", f"int(pq % {many}) AS q", "n"), "pairs")
    itself = table.filter("p = q").select(F.col("p").alias("unit"), F.col("n").alias("itself"))
    other = table.filter("p <> q")
    after = other.groupBy(F.col("p").alias("unit")).agg(F.collect_list(F.struct("q", "n")).alias("a"))  # at most one entry a unit
    before = other.groupBy(F.col("q").alias("unit")).agg(F.collect_list(F.struct("p", "n")).alias("b"))
    rows = after.join(before, "unit", "full").join(itself, "unit", "full").select(
        "unit", F.col("a.q").alias("after"), F.col("a.n").alias("n_after"), F.col("b.p").alias("before"), F.col("b.n").alias("n_before"), F.coalesce("itself", F.lit(0)).alias("itself")
    )
    out = store(rows, "units")
    drop_stored(table)
    return out


def _row_vectors(batch, classes, many):
    """Each unit of a batch with how often each class stands after and before it, and how often it follows itself."""
    rows = np.arange(batch.num_rows)

    def sums(others, counts) -> np.ndarray:
        at = np.repeat(rows, others.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        cells = at * many + classes[others.flatten().to_numpy()]
        return np.bincount(cells, counts.flatten().to_numpy().astype(float), batch.num_rows * many).reshape(-1, many)

    after, before = sums(batch.column(1), batch.column(2)), sums(batch.column(3), batch.column(4))
    yield from zip(batch.column(0).to_pylist(), after, before, map(float, batch.column(5).to_pylist()))


def class_pairs(rows: DataFrame, classes: np.ndarray, many: int) -> np.ndarray:
    """How often a class follows a class."""

    def run(batches):
        total = np.zeros((many, many))
        for batch in batches:
            for unit, s, _, itself in _row_vectors(batch, classes, many):
                total[classes[unit]] += s
                total[classes[unit], classes[unit]] += itself
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(total[c, d])], names=["c", "d", "n"])

    out = np.zeros((many, many))
    for r in rows.mapInArrow(run, "c int, d int, n double").groupBy("c", "d").agg(F.sum("n").alias("n")).collect():  # classes squared at most
        out[r["c"], r["d"]] = r["n"]
    return out


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def best_class(matrix: np.ndarray, own: int, s: np.ndarray, p: np.ndarray, itself: float, logs: np.ndarray | None = None) -> tuple[int, float]:
    """The class a unit should be in, and the gain in log likelihood over where it is.

    ``s`` and ``p`` count the classes after and before the unit, without itself; ``matrix`` has it in ``own``.
    ``logs`` may be ``matrix`` times its logarithm.
    """
    m = matrix.copy()
    m[own] -= s
    m[:, own] -= p
    m[own, own] -= itself
    m[own], m[:, own] = np.maximum(m[own], 0), np.maximum(m[:, own], 0)
    now = _xlogx(matrix) if logs is None else logs.copy()
    now[own], now[:, own] = _xlogx(m[own]), _xlogx(m[:, own])
    after, before = np.flatnonzero(s), np.flatnonzero(p)  # a rare unit has few neighbours
    d, d_now = np.diag(m), np.diag(now)
    gain = (_xlogx(m[:, after] + s[after]) - now[:, after]).sum(axis=1) - (_xlogx(d + s) - d_now)
    gain += (_xlogx(m[before] + p[before, None]) - now[before]).sum(axis=0) - (_xlogx(d + p) - d_now)
    gain += _xlogx(d + s + p + itself) - d_now
    out, inn = m.sum(axis=1) + p, m.sum(axis=0) + s  # the neighbours stay before and after the unit wherever it goes
    gain -= _xlogx(out + s.sum() + itself) - _xlogx(out) + _xlogx(inn + p.sum() + itself) - _xlogx(inn)
    gain[FIXED] = -np.inf
    to = int(np.argmax(gain))
    return to, float(gain[to] - gain[own])


def exchange(rows: DataFrame, sizes: np.ndarray, many: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each unit; ``sizes`` are the units' counts."""
    classes = np.zeros(len(sizes), dtype=np.int64)
    order = np.argsort(-sizes[1:], kind="stable") + 1
    classes[order] = 1 + np.arange(len(order)) % (many - 1)
    gained = []
    for turn in range(rounds):
        matrix = class_pairs(rows, classes, many)
        now = classes.copy()

        def run(batches, now=now, matrix=matrix, turn=turn):
            logs = _xlogx(matrix)
            for batch in batches:
                units, to, gains = [], [], []
                for unit, s, p, itself in _row_vectors(batch, now, many):
                    if unit and (unit * 2654435761 >> (8 + turn)) & 1:
                        best, gain = best_class(matrix, int(now[unit]), s, p, itself, logs)
                        if gain > 1e-6:
                            units.append(unit), to.append(best), gains.append(gain)
                yield pa.RecordBatch.from_arrays([pa.array(units, pa.int32()), pa.array(to, pa.int32()), pa.array(gains, pa.float64())], names=["unit", "c", "gain"])

        moves = rows.mapInArrow(run, "unit int, c int, gain double").collect()  # a row a unit at most
        for r in moves:
            classes[r["unit"]] = r["c"]
        gained.append(sum(r["gain"] for r in moves))
        if turn and sum(gained[-2:]) <= LEAST_GAIN * sizes.sum():
            break
    return classes


def fit(docs: DataFrame, words: DataFrame, many: int = CLASSES, rounds: int = ROUNDS, head_share: float = HEAD_SHARE) -> Model:
    """The model of the training texts ``docs(text)``, whose words are counted in ``words(word, n)``."""
    total, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = words.filter(F.col("n") >= F.lit(total * head_share)).toPandas()
    head = dict(zip(map(bytes, head["word"]), head["n"].tolist()))
    known, sizes, kinds = {END: 0}, [float(head.get(END, words.filter(F.length("word") == 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])), 0.0], [1.0, 0.0]
    for w in sorted((w for w in head if w != END), key=lambda w: (-head[w], w)):
        known[w] = len(sizes)
        sizes.append(float(head[w]))
        kinds.append(1.0)
    # The other words by their last two bytes: 65,792 groups at most.
    rare = words.filter((F.length("word") > 0) & (F.col("n") < F.lit(total * head_share)))
    ends = rare.groupBy(F.expr("substring(word, greatest(length(word) - 1, 1), 2)").alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("types"))
    for r in sorted(ends.collect(), key=lambda r: bytes(r["e"])):
        if r["n"] >= total * head_share:
            known[_OTHER + bytes(r["e"])] = len(sizes)
            sizes.append(float(r["n"]))
            kinds.append(float(r["types"]))
        else:
            sizes[1] += r["n"]
            kinds[1] += r["types"]
    units = Units(known)
    sizes, kinds = np.array(sizes), np.array(kinds)
    rows = unit_rows(docs, units)
    classes = exchange(rows, sizes, many, rounds)
    matrix = class_pairs(rows, classes, many)
    drop_stored(rows)
    count = np.bincount(classes, sizes, many)
    share = (count + 1) / (count.sum() + many)
    step = np.log10((matrix + PRIOR * share[None, :]) / (matrix.sum(axis=1, keepdims=True) + PRIOR))
    room = np.log10(count + np.bincount(classes, kinds, many) + 1)
    return Model(units, classes, step, room, head, int(total), int(types))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    Texts whose id has checksum remainder 2 of 7 are held out; a null id is trained on. A null text
    is an empty one: the end alone. ``base_score`` is the add-one unigram, ``score`` the class model,
    both log10 of the whole text's probability. Repeated rows are rows of their own and are counted
    each. An empty table gives an empty result, and without training texts every word is unseen.
    """
    with batches_of(docs.sparkSession, _BATCH_BYTES):  # what is left to run afterwards has no Python
        return _score(docs, id_col, text_col, many, rounds)


def _score(docs: DataFrame, id_col: str, text_col: str, many: int, rounds: int) -> DataFrame:
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"), training(id_col).alias("_train"))
    train = rows.filter("_train").select("_text")
    words = store(train.mapInArrow(_word_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    model = fit(train, words, many, rounds)

    def run(batches):
        m = model
        place = {w: i for i, w in enumerate(m.head)}.get
        head_class = np.array([*[m.classes[m.units.of(w)] for w in m.head], 0])
        head_log = np.log10(np.array([*m.head.values(), 0], dtype=float) + 1)
        tails: dict[bytes, int] = {}  # class of the words of an ending that are not in the head
        last = place(END, -1)
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def flush(ids):
            """The other words, each with the texts it is in, a text as often as it has the word."""
            words, codes = _one_coding([w for w, _, _ in held])
            first = np.cumsum([0, *[len(w) for w, _, _ in held]])
            which = np.concatenate([codes[k + c] for k, (_, c, _) in zip(first.tolist(), held)])
            texts = np.concatenate([t for _, _, t in held])
            held.clear()
            order = np.argsort(which, kind="stable")
            rows_ = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(which, minlength=len(words)))).astype(np.int32)), pa.array(texts[order]))
            lengths = rows_.value_lengths().to_numpy()
            some = pa.array(lengths > 0)
            for part in _pieces(pa.RecordBatch.from_arrays([words, rows_], names=names[:2]).filter(some), lengths[lengths > 0]):
                empty = [pa.nulls(part.num_rows, t) for t in (pa.int64(), ids, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *empty], names=names)

        for batch in _chunks(batches, 2):
            ids, n = batch.schema.field(1).type, batch.num_rows
            words_, codes, owners = _encoded(batch.column(2))
            own = words_.to_pylist()
            places = np.array([place(w, -1) for w in own], dtype=np.int32)
            kinds = head_class[places]
            for i in np.flatnonzero(places < 0).tolist():
                w = own[i][-2:]
                c = tails.get(w)
                if c is None:
                    c = tails[w] = int(m.classes[m.units.known.get(_OTHER + w, 1)])
                kinds[i] = c
            # Texts one after the other, each with its end.
            sizes = np.bincount(owners, minlength=n) + 1
            stops = np.cumsum(sizes)
            slots = np.arange(len(codes)) + owners
            at, path = np.full(len(codes) + n, last, dtype=np.int32), np.full(len(codes) + n, FIXED, dtype=np.int32)
            at[slots], path[slots] = places[codes], kinds[codes]
            logs, moves, rooms = head_log[at], m.step[np.append(FIXED, path[:-1]), path], m.room[path]
            spans = list(zip((stops - sizes).tolist(), stops.tolist()))
            base = [float(logs[i:j].sum()) for i, j in spans]
            gone = [float(moves[i:j].sum() - rooms[i:j].sum()) for i, j in spans]
            known = np.add.reduceat(at >= 0, stops - sizes, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64())), batch.column(0), batch.column(1), batch.column(3), pa.array(sizes.astype(np.int64)), pa.array(known), pa.array(base, pa.float64()), pa.array(gone, pa.float64())],
                names=names,
            )
            rows_ = batch.column(0).to_numpy()
            rare = np.flatnonzero(places < 0).astype(np.int32)
            number = np.zeros(len(own), dtype=np.int32)
            number[rare] = np.arange(len(rare))
            others = places[codes] < 0
            held.append((words_.take(pa.array(rare)), number[codes[others]], rows_[owners[others]]))
            if last < 0:
                held.append((pa.array([END], pa.binary()), np.zeros(n, dtype=np.int32), rows_))
            size += len(at)
            if size > _CHUNK_TOKENS:
                yield from flush(ids)
                size = 0
        if held:
            yield from flush(ids)

    names = ["word", "rows", "row", "id", "train", "n_tokens", "known", "base", "path"]
    kind = rows.schema[0].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), "_text", "_train")
    both = store(
        numbered.mapInArrow(run, f"word binary, rows array<long>, row long, id {kind}, train boolean, n_tokens long, known long, base double, path double"),
        "tokens",
    )
    # A word stands once for each time a text has it; sum what it adds to each text.
    seen = both.filter("word is not null").select("word", "rows").join(words.withColumnRenamed("n", "c"), "word")
    rest = (
        seen.select(F.log10(F.col("c") + 1).alias("l"), F.explode("rows").alias("row"))
        .groupBy("row")
        .agg(F.sum("l").alias("rare"), F.count("*").alias("n_rare"))
    )
    rest = rest.withColumnRenamed("row", "_row")
    texts = both.filter("word is null")
    whole = texts.join(rest, F.col("row") == F.col("_row"), "left")
    rare = F.coalesce("rare", F.lit(0.0))
    unigram = float(np.log10(model.total + model.types + 1))
    return whole.select(
        F.col("id").alias(id_col),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + rare - F.col("n_tokens") * F.lit(unigram)).alias("base_score"),
        (F.col("base") + rare + F.col("path")).alias("score"),
        F.pow(F.lit(10.0), -(F.col("base") + rare + F.col("path")) / F.col("n_tokens")).alias("perplexity"),
    )
