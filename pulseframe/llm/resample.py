"""Quality by importance resampling: hashed n-gram models of wanted and raw text, Gumbel top-k.

Words and marks, lower-cased, and pairs of them are hashed into ``BUCKETS``. Two bags of buckets are
counted: of good labelled texts (a bounded sample, all of them while they are few) and of every text.
A document's log weight is the sum of the log ratio of its buckets' probabilities; with Gumbel noise
added, the k largest keys are a sample without replacement in proportion to the weights. ``k`` is
given, or the number of documents whose key reaches the threshold that best separates labelled
documents held out of the model.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.llm.common import ranked, unit_hash

BUCKETS = 1 << 15
# At most so many good and so many bad labelled documents fit the model and its threshold.
LABELLED = 20_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_WORDS_KEPT = 200_000


class Grams:
    """Bucket numbers of a text's words and neighbouring pairs; a repeated word is a pair of its own kind."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def buckets(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        if len(self.known) > _WORDS_KEPT:
            self.known = {}
        get, known = self.known.get, self.known
        h = np.empty(len(tokens), dtype=np.uint64)
        for i, w in enumerate(tokens):
            x = get(w)
            if x is None:
                x = known[w] = xxhash.xxh32_intdigest(w)
            h[i] = x
        pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
        pair[h[:-1] == h[1:]] = 0
        both = np.concatenate([h * np.uint64(0x165667B19E3779F9), pair])
        return ((both ^ (both >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25) >> np.uint64(49)).astype(np.int64)


def labelled_sample(labels: DataFrame, most: int = LABELLED, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, good, fold`` of at most ``most`` good and ``most`` bad labelled ids, smallest hash first.

    Good is quality 1 that is not marked toxic, bad is quality 0; ids with other or contradicting
    labels are left out. Fold 0 fits the model, fold 1 the threshold.
    """
    one = labels.groupBy(F.col(id_col)).agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"), F.max("toxic").alias("toxic"))
    one = one.filter(f"{id_col} is not null and lo = hi")
    good = one.filter("lo = 1 and coalesce(toxic, 0) = 0").withColumn("good", F.lit(True))
    bad = one.filter("lo = 0").withColumn("good", F.lit(False))
    order = [F.xxhash64(F.lit("sample"), id_col), F.col(id_col)]
    parts = [x.orderBy(*order).limit(most) for x in (good, bad)]
    return parts[0].union(parts[1]).select(id_col, "good", F.pmod(F.xxhash64(F.lit("fold"), id_col), F.lit(2)).alias("fold"))


def _counts(batches):
    grams = Grams()
    total = np.zeros((2, BUCKETS), dtype=np.int64)
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
            text = text.as_py()
            if text:
                n = np.bincount(grams.buckets(text), minlength=BUCKETS)
                total[0] += n
                if wanted:
                    total[1] += n
    at = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "raw", "target"])


def fit(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The log ratio of target to raw probability of every bucket, add-one smoothed."""
    wanted = sample.filter("good and fold = 0").select(F.col(id_col).alias("_id"), F.lit(True).alias("_wanted"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.join(F.broadcast(wanted), "_id", "left").select("_text", F.coalesce("_wanted", F.lit(False)).alias("_wanted"))
    counts = rows.mapInArrow(_counts, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in counts.collect():  # BUCKETS rows at most
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def scored(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text", temperature: float = 1.0) -> DataFrame:
    """``docs`` with ``_grams`` (n-grams counted), ``_weight`` (log weight) and ``_key`` (with noise).

    The noise is decided by id and text length, so every run draws the same sample. A null, empty
    or blank text has no n-grams and null weight and key.
    """

    def weigh(batches):
        grams = Grams()
        for batch in batches:
            n, w = [], []
            for text in batch.column(at):
                text = text.as_py()
                b = grams.buckets(text) if text else np.empty(0, np.int64)
                n.append(len(b))
                w.append(float(ratio[b].sum()) if len(b) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(w, pa.float64())], names=[*batch.schema.names, "_grams", "_weight"])

    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("_grams", T.LongType()), T.StructField("_weight", T.DoubleType())])
    out = docs.mapInArrow(weigh, schema)
    u = (unit_hash(F.lit("gumbel"), F.col(id_col), F.length(text_col)) * (1 - 2.0**-40)) + 2.0**-41
    return out.withColumn("_key", F.col("_weight") / temperature - F.log(-F.log(u)))


def threshold(docs: DataFrame, sample: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> float:
    """The key that best separates good from bad labelled documents of fold 1: most of both sides right.

    Halfway between the two documents it parts. Without both kinds it is minus infinity: all are kept.
    """
    held = sample.filter("fold = 1").select(F.col(id_col).alias("_id"), F.col("good").alias("_good"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(held), "_id")
    keys = scored(rows, ratio, "_id", "_text").filter("_key is not null").select("_good", "_key").collect()  # twice LABELLED at most
    good = np.sort([r["_key"] for r in keys if r["_good"]])
    bad = np.sort([r["_key"] for r in keys if not r["_good"]])
    if not len(good) or not len(bad):
        return float("-inf")
    every = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[every[0] - 1], (every[1:] + every[:-1]) / 2, [every[-1] + 1]])
    right = 1 - np.searchsorted(good, cuts) / len(good) + np.searchsorted(bad, cuts) / len(bad)
    return float(cuts[np.argmax(right)])


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_grams, log_weight, gumbel_key, selected`` for every row of ``docs``.

    With ``k``, the k largest keys are selected (ties by id); without, those that reach the fitted
    threshold. Texts without n-grams (null, empty, blank) are never selected. Repeated rows with one
    id and text get one key. An empty table gives an empty result; without labels of both kinds all
    texts with n-grams are selected.
    """
    sample = labelled_sample(labels, id_col=id_col)
    ratio = fit(docs, sample, id_col, text_col)
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    keys = scored(slim, ratio, id_col, text_col).select(id_col, F.col("_grams").alias("n_grams"), F.col("_weight").alias("log_weight"), F.col("_key").alias("gumbel_key"))
    if k is None:
        cut = threshold(docs, sample, ratio, id_col, text_col)
        return keys.withColumn("selected", F.coalesce(F.col("gumbel_key") >= F.lit(cut), F.lit(False)))
    places = ranked(keys, [F.col("gumbel_key").desc_nulls_last(), F.col(id_col)], "keys")
    return places.withColumn("selected", (F.col("rank") < k) & F.col("gumbel_key").isNotNull()).drop("rank")


def selected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that reach the threshold; nothing is shuffled.

    Null, empty and blank texts have no n-grams and go; repeated rows all stay or go. Without labels
    of both kinds all texts with n-grams stay, and an empty table stays empty. Texts are counted whole.
    """
    sample = labelled_sample(labels, id_col=id_col)
    ratio = fit(docs, sample, id_col, text_col)
    cut = threshold(docs, sample, ratio, id_col, text_col)
    inner = docs.withColumnsRenamed({c: f"_{i}" for i, c in enumerate(docs.columns)})
    ids, texts = f"_{docs.columns.index(id_col)}", f"_{docs.columns.index(text_col)}"
    kept = scored(inner, ratio, ids, texts).filter(F.coalesce(F.col("_key") >= F.lit(cut), F.lit(False)))
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
