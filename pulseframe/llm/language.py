"""Language of whole texts: interpolated Kneser-Ney character models, one per language.

A text is its lower-cased letters with one space for anything else between them. Counts of character
4-grams by language are one aggregate over all training texts, and each lower order counts in how
many ways its grams continue. From every order the grams above a relative count are kept (so the
model has a proven size); what the others and the discount leave goes to the order below:

    p_n(w | h) = max(c(h w) - D, 0) / c(h) + left(h) * p_{n-1}(w | h')

A gram is one 64-bit number, four characters of 16 bits. The model is one array per order of the
grams' hashes, sorted, with a row of log probabilities, one for each language; a text is scored by
looking up its distinct grams. The language of lowest cross-entropy per character wins; temperature
and rejection bounds are fitted on training texts that no count has seen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import drop_stored, store

ORDER = 4
# Grams rarer than this share of an order's count are left to the order below: 500,000 a language and order at most.
LEAST_SHARE = 2e-6
TEMPERATURES = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0)
REJECT_SIGMAS = 6.0
_CHUNK_CHARS = 1_000_000
_SPACE = 32


def letter_table() -> np.ndarray:
    """For each code point its 16-bit letter, or the space; letters beyond 16 bits are folded into the private area."""
    out = np.full(0x110000, _SPACE, dtype=np.uint64)
    for c in range(0x110000):
        if chr(c).isalpha():
            out[c] = c if c < 0x10000 else 0xE000 + c % 0x1900
    return out


def letters(text: str | None, table: np.ndarray) -> np.ndarray:
    """The text's letters with single spaces between words, after ``ORDER - 1`` spaces and before one."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    x = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    x = np.concatenate([[_SPACE], x, [_SPACE]]).astype(np.uint64)
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != _SPACE) | (x[:-1] != _SPACE)
    x = x[keep]
    if len(x) < 2:
        return np.empty(0, dtype=np.uint64)
    return np.concatenate([np.full(ORDER - 2, _SPACE, dtype=np.uint64), x])


def grams(x: np.ndarray) -> np.ndarray:
    n = len(x) - ORDER + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | x[i : i + n]
    return out


def hashed(key: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers."""
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(32))


@dataclass
class Table:
    """Sorted hashes and a row of values for each."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        h = hashed(keys)
        order = np.argsort(h)
        return cls(h[order], values[order])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys and whether they are there."""
        if not len(self.hashes):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        h = hashed(keys)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return at, self.hashes[at] == h


@dataclass
class Model:
    languages: list[str]
    floor: np.ndarray  # log probability of an unseen character
    grams: dict[int, Table]  # log probabilities by order
    left: dict[int, Table]  # log of what a history leaves to the order below, by order
    temperature: float = 20.0
    bounds: dict[str, float] = field(default_factory=dict)

    def logs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log probability of each gram's last character in each language."""
        if order == 0 or not len(keys):
            return np.repeat(self.floor[None, :], len(keys), axis=0)
        at, there = self.grams[order].find(keys)
        out = self.grams[order].values[at] if len(self.grams[order].hashes) else np.empty((len(keys), len(self.floor)))
        if not there.all():
            rest = keys[~there]
            below = self.logs(rest & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
            where, known = self.left[order].find(rest >> np.uint64(16))
            below[known] += self.left[order].values[where[known]]
            out[~there] = below
        return out

    def entropies(self, x: np.ndarray) -> np.ndarray | None:
        """Cross-entropy per character in nats for each language; None without a letter."""
        keys, n = np.unique(grams(x), return_counts=True)
        if not len(keys):
            return None
        return -(n @ self.logs(keys)) / n.sum()

    def chances(self, entropies: np.ndarray) -> np.ndarray:
        z = -entropies * self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4))


def _counted(batches):
    table = letter_table()
    for batch in batches:
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for lang, parts in sorted(waiting.items()):
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())],
                    names=["lang", "key", "n"],
                )
            waiting.clear()

        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            g = grams(letters(text.as_py(), table))
            waiting.setdefault(lang, []).append(g)
            size += len(g)
            if size > _CHUNK_CHARS:
                yield from flush()
                size = 0
        yield from flush()


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least_share: float = LEAST_SHARE) -> Model:
    """A model of the languages of ``docs`` from their texts; rows without a text or language are skipped."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = rows.filter("text is not null and lang is not null").mapInArrow(_counted, "lang string, key long, n long")
    level = store(counts.groupBy("lang", "key").agg(F.sum("n").alias("n")), "grams")
    kept, lefts = {}, {}
    for order in range(ORDER, 0, -1):
        # The discount comes from how many grams were seen once and twice.
        seen = level.groupBy("lang").agg(
            F.sum("n").alias("all"), F.sum((F.col("n") == 1).cast("int")).alias("n1"), F.sum((F.col("n") == 2).cast("int")).alias("n2")
        )
        discount = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        seen = seen.select("lang", "all", discount.alias("d"))
        history = F.shiftrightunsigned("key", 16) if order > 1 else F.lit(0).cast("long")
        whole = level.withColumn("h", history)
        totals = whole.groupBy("lang", "h").agg(F.sum("n").alias("total"))
        share = (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("p")
        some = whole.join(F.broadcast(seen), "lang").filter(F.col("n") >= F.col("all") * least_share)
        kept[order] = some.join(totals, ["lang", "h"]).select("lang", "key", "h", share).toPandas()
        if order > 1:
            suffix = F.col("key").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1)).alias("key")
            below = store(level.groupBy("lang", suffix).agg(F.count("*").alias("n")), "grams")
            drop_stored(level)
            level = below
    drop_stored(level)
    names = sorted(set(kept[1]["lang"]))
    place = {s: i for i, s in enumerate(names)}
    letters_seen = kept[1]["key"].nunique() + 1
    model = Model(names, np.full(len(names), -np.log(letters_seen)), {}, {})
    for order in range(1, ORDER + 1):
        frame = kept[order]
        lang = frame["lang"].map(place).to_numpy(dtype=np.int64)
        keys, row = np.unique(frame["key"].to_numpy(dtype=np.int64).view(np.uint64), return_inverse=True)
        histories, h = np.unique(frame["h"].to_numpy(dtype=np.int64).view(np.uint64), return_inverse=True)
        given = np.zeros((len(histories), len(names)))
        np.add.at(given, (h, lang), frame["p"].to_numpy())
        left = np.maximum(1 - given, 1e-12)
        own = np.zeros((len(keys), len(names)))
        own[row, lang] = frame["p"].to_numpy()
        low = np.uint64((1 << 16 * (order - 1)) - 1)
        below = np.exp(model.logs(keys & low, order - 1))
        of = np.searchsorted(histories, keys >> np.uint64(16) if order > 1 else np.zeros(len(keys), np.uint64))
        model.grams[order] = Table.of(keys, np.log(own + left[of] * below))
        model.left[order] = Table.of(histories, np.log(left))
    return model


def scored(docs: DataFrame, model: Model, id_col: str, text_col: str, *also: str) -> DataFrame:
    """``id, [also], lang_pred, score, entropy, chars, rejected`` and ``entropies`` of every row."""
    def run(batches):
        table, m = letter_table(), model
        for batch in batches:
            langs, scores, lowest, chars, out, every = [], [], [], [], [], []
            for text in batch.column(0):
                x = letters(text.as_py(), table)
                e = m.entropies(x) if m.languages else None
                if e is None:
                    langs.append("und"), scores.append(0.0), lowest.append(None), out.append(True), every.append(None)
                else:
                    best = int(np.argmin(e))
                    langs.append(m.languages[best]), scores.append(float(m.chances(e)[best])), lowest.append(float(e[best]))
                    out.append(bool(e[best] > m.bounds.get(m.languages[best], np.inf)))
                    every.append(e.tolist())
                chars.append(max(0, len(x) - ORDER + 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(lowest, pa.float64()), pa.array(chars, pa.int64()), pa.array(out, pa.bool_()), pa.array(every, pa.list_(pa.float64()))],
                names=names,
            )

    slim = docs.select(F.col(text_col).cast("string").alias("_text"), F.col(id_col), *also)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[1:])
    schema = f"{own}, lang_pred string, score double, entropy double, chars long, rejected boolean, entropies array<double>"
    names = [*slim.columns[1:], "lang_pred", "score", "entropy", "chars", "rejected", "entropies"]
    return slim.mapInArrow(run, schema)


def calibrated(docs: DataFrame, model: Model, id_col: str, text_col: str, lang_col: str) -> Model:
    """The model with the temperature that gives ``docs`` the highest likelihood and, for each language,
    the entropy above which a text is rejected: mean and ``REJECT_SIGMAS`` deviations of its own texts."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("_lang"))
    rows = scored(rows.filter("_lang is not null"), model, "_id", "_text", "_lang").filter("entropies is not null")
    own = F.array_position(F.array(*[F.lit(s) for s in model.languages]), F.col("_lang")).cast("int")
    rows = rows.withColumn("_own", own).filter("_own > 0")
    losses = [
        F.sum(F.col("entropies")[F.col("_own") - 1] * t + F.log(F.aggregate("entropies", F.lit(0.0), lambda s, e: s + F.exp((F.col("entropy") - e) * t))) - F.col("entropy") * t).alias(f"t{i}")
        for i, t in enumerate(TEMPERATURES)
    ]
    loss = np.zeros(len(TEMPERATURES))
    right = F.when(F.col("_lang") == F.col("lang_pred"), F.col("entropy"))
    for r in rows.groupBy("_lang").agg(F.avg(right).alias("mean"), F.stddev_pop(right).alias("sd"), *losses).collect():  # a row for each language
        if r["mean"] is not None:
            model.bounds[r["_lang"]] = r["mean"] + REJECT_SIGMAS * max(r["sd"] or 0.0, 0.01)
        loss += [r[f"t{i}"] for i in range(len(TEMPERATURES))]
    if loss.any():
        model.temperature = TEMPERATURES[int(np.argmin(loss))]
    return model


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, entropy, chars, rejected`` for every row of ``docs``.

    Texts whose id has checksum remainder 2 of 4 are held out of everything; remainders 0 and 1 are
    counted, 3 calibrates. ``lang_pred`` is the likeliest learned language, and ``und`` with score 0
    for a null text or one without a letter. ``rejected`` says that even that language explains the
    text worse than nearly all of its own texts. Repeated rows are rows of their own. Without any
    labelled text every row is ``und``. An empty table gives an empty result.
    """
    marked = docs.withColumn("_fold", fold(id_col))
    model = fit(marked.filter("_fold in (0, 1)"), text_col, lang_col)
    if model.languages:
        model = calibrated(marked.filter("_fold = 3"), model, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return scored(rows, model, id_col, "_text").select(
        id_col, F.coalesce(fold(id_col) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "entropy", "chars", "rejected"
    )
