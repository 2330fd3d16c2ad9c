"""Near-duplicate groups by Order MinHash, verified by banded alignment.

A text is the sequence of its lower-cased words, its k-mers are ``k`` words long and labelled with
how often they occurred before, so repeats count. A sketch takes the ``ell`` labelled k-mers of
smallest hash and keeps them in text order: two texts agree in a sketch only if they share these
k-mers in the same order, which follows edit similarity and not just overlap. Texts that agree in
any of ``m`` sketches are candidates.

A candidate pair is aligned on its labelled k-mers: the longest chain of shared k-mers that is in
order in both texts, within the diagonal band outside which the similarity cannot be reached. With
``c`` k-mers in the chain the similarity is ``c / (n_a + n_b - c)``.

Equal texts are one text from the start. The texts of one sketch bucket are not paired with each
other but with a member picked by hash, and again within those that also agree in the next sketch: as many pairs as rows,
whatever the size of the bucket. Buckets that are still not one group are then dealt with again: all
pairs across their groups in small ones; the texts of large ones, which often share a passage and nothing
else, are paired where they share one of their rarest k-mers, as all pairs similar enough do.
So no candidate pair is lost but those that other links make one group anyway.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.common import components, drop_stored, store

K = 5
ELL = 3
SKETCHES = 16
SIMILARITY = 0.8
# A bucket of so few texts is finished by a join with itself, larger ones by their rarest k-mers.
SMALL_BUCKET = 16
# Classes of k-mers whose frequencies are counted.
RARITY = 1 << 16
# Longs of a text's parity bits.
PARITY = 16
_WORDS_KEPT = 200_000
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """Hashes of words, remembered for the frequent ones."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        words = text.lower().split()
        if len(self.known) > _WORDS_KEPT:
            self.known = {}
        get, known = self.known.get, self.known
        out = np.empty(len(words), dtype="<u4")
        for i, w in enumerate(words):
            h = get(w)
            if h is None:
                h = known[w] = xxhash.xxh32_intdigest(w)
            out[i] = h
        return out


def labelled(words: np.ndarray, k: int) -> np.ndarray:
    """The k-mers by place, each with its number among equal ones; fewer than ``k`` words are one k-mer."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - k + 1)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(min(k, len(words))):
        out = out * _U(0x9E3779B97F4A7C15) + mixed(words[j : j + n].astype(np.uint64) + _U(1))
    out = mixed(out)
    order = np.argsort(out, kind="stable")
    same = out[order[1:]] == out[order[:-1]]
    if same.any():
        run = np.arange(n)
        first = np.maximum.accumulate(np.where(np.concatenate([[False], same]), 0, run))
        nth = np.empty(n, dtype=np.uint64)
        nth[order] = (run - first).astype(np.uint64)
        out = np.where(nth > 0, mixed(out + nth * _U(0xD6E8FEB86659FD93)), out)
    return out


def sketches(mers: np.ndarray, ell: int, m: int) -> list[int]:
    out = []
    for t in range(m):
        if len(mers) > ell:
            least = np.sort(np.argpartition(mixed(mers ^ _U((t + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1)), ell)[:ell])
            picked = mers[least]
        else:
            picked = mers
        h = t + 1
        for x in picked.tolist():
            h = (h * 0x100000001B3 ^ x) & (1 << 64) - 1
        out.append(h - (1 << 63))
    return out


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Similarity of two labelled k-mer sequences by alignment, or 0.0 when it is below ``least``."""
    total = len(a) + len(b)
    if not total or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    need = least / (1 + least) * total  # k-mers of a chain that reaches the similarity
    off = total - 2 * need  # so many are unpaired at most, and as far off the diagonal a pair can lie
    near = np.abs(i - j) <= off + 1e-9
    i, j = i[near], j[near]
    if len(i) < need - 1e-9:
        return 0.0
    j = j[np.argsort(i)]
    if np.all(np.diff(j) > 0):
        chain = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            if at == len(tails):
                tails.append(x)
            else:
                tails[at] = x
        chain = len(tails)
    s = chain / (total - chain)
    return s if s >= least - 1e-12 else 0.0


def _sketch_rows(k: int, ell: int, m: int):
    def run(batches):
        words = Words()
        for batch in batches:
            keys, rows = [], []
            for key, text in zip(batch.column(0), batch.column(1)):
                mers = labelled(words.hashes(text.as_py()), k)
                if len(mers):
                    keys.append(key.as_py())
                    rows.append(sketches(mers, ell, m))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(rows, pa.list_(pa.int64()))], names=["g", "sketches"])

    return run


def _word_rows(batches):
    words = Words()
    for batch in batches:
        seqs = [words.hashes(t.as_py()).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seqs, pa.binary())], names=["g", "words"])


def _verified(k: int, least: float):
    def run(batches):
        for batch in batches:
            a, b = [], []
            last, mers = None, None
            for ga, gb, wa, wb in zip(*[batch.column(i) for i in range(4)]):
                gb = gb.as_py()
                if gb != last:  # rows of one picked text often follow each other
                    last, mers = gb, labelled(np.frombuffer(wb.as_py(), dtype="<u4"), k)
                if similarity(labelled(np.frombuffer(wa.as_py(), dtype="<u4"), k), mers, least):
                    a.append(ga.as_py())
                    b.append(gb)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _picked(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Pairs of each of ``rows(g, c, *keys)`` with the one its bucket picks, the least by ``order``, unless both are of group ``c``."""
    picks = rows.groupBy(*keys).agg(F.min_by(F.struct("g", "c"), order).alias("p"))
    return rows.join(picks, keys).filter("c <> p.c").select(F.least("g", "p.g").alias("a"), F.greatest("g", "p.g").alias("b"))


def _linked(pairs: DataFrame, words: DataFrame, k: int, least: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts, ``words(g, words)``, are similar enough."""
    sides = (
        pairs.join(words.toDF("a", "wa"), "a")
        .join(words.toDF("b", "wb"), "b")
        .select("a", "b", "wa", "wb")
    )
    return store(sides.mapInArrow(_verified(k, least), "a binary, b binary"), "links")


def _rare_counts(words: DataFrame, k: int) -> np.ndarray:
    """How many texts' k-mers fall into each of ``RARITY`` classes of hashes: a table of fixed size."""

    def count(batches):
        total = np.zeros(RARITY, dtype=np.int64)
        for batch in batches:
            for w in batch.column(0):
                mers = labelled(np.frombuffer(w.as_py(), dtype="<u4"), k)
                total += np.bincount((mers % _U(RARITY)).astype(np.int64), minlength=RARITY)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])

    found = words.select("words").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # RARITY rows at most
    out = np.zeros(RARITY, dtype=np.int64)
    for r in found:
        out[r["at"]] = r["n"]
    return out


def _prefix_rows(k: int, least: float, counts: np.ndarray):
    """The rarest k-mers of each text, so many that two texts of the least similarity must share one, and its parity bits."""

    def run(batches):
        for batch in batches:
            sizes, rarest, parity = [], [], []
            for w in batch.column(2):
                mers = labelled(np.frombuffer(w.as_py(), dtype="<u4"), k)
                n = len(mers)
                order = np.lexsort((mers, counts[(mers % _U(RARITY)).astype(np.int64)]))  # one order for all texts
                sizes.append(n)
                rarest.append(mers[order[: n - int(np.ceil(least * n - 1e-9)) + 1]].view(np.int64))
                odd = np.bincount((mers >> _U(32) & _U(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
                parity.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (rarest, parity)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), *lists], names=["g", "c", "n", "rarest", "parity"])

    return run


def rare_rows(texts: DataFrame, k: int, least: float) -> DataFrame:
    """``x, g, c, n, i, parity``, stored: the rarest k-mers of ``texts(g, c, words)`` that texts of several groups have.

    Of n k-mers a text has ``n - ceil(least n) + 1`` rows, numbered from 0 by rarity.
    """
    prefixes = texts.select("g", "c", "words").mapInArrow(_prefix_rows(k, least, _rare_counts(texts, k)), "g binary, c binary, n long, rarest array<long>, parity array<long>")
    prefixes = store(prefixes, "prefixes")
    rows = prefixes.select("g", "c", "n", F.posexplode("rarest").alias("i", "x"))
    out = store(_met(rows).join(prefixes.select("g", "parity"), "g").select("x", "g", "c", "n", "i", "parity"), "rarest")
    drop_stored(prefixes)
    return out


def _met(rows: DataFrame) -> DataFrame:
    """Most of the rarest k-mers have one text alone, or texts of one group; the rows of the others."""
    return rows.join(rows.groupBy("x").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("x"), "x")


def _may_reach(least: float) -> Column:
    """Whether texts of ``na`` and ``nb`` k-mers with parity bits ``pa`` and ``pb`` can reach the similarity.

    Few k-mers may be in one of the two alone: there are at least as many as places at which the
    bits differ, the parities of the counts of k-mers by hash.
    """
    both = F.col("na") + F.col("nb")
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.get("pa", F.lit(i)).bitwiseXOR(F.get("pb", F.lit(i)))) for i in range(PARITY)])
    long_enough = F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-9
    return (F.col("ca") != F.col("cb")) & long_enough & (apart <= (1 - 2 * least / (1 + least)) * both + 1e-9)


def star_pairs(rows: DataFrame, least: float) -> DataFrame:
    """Pairs of each text with one of the texts that have its rare k-mer: as many at most as rows.

    It is the text with the fewest rarer k-mers, which among copies of one text is the one least changed.
    """
    picks = rows.groupBy("x").agg(F.min_by(F.struct("g", "c", "n", "parity"), F.struct("i", F.xxhash64("g"))).alias("p"))
    sides = rows.join(picks, "x").select(
        F.col("g").alias("a"), F.col("p.g").alias("b"), F.col("c").alias("ca"), F.col("p.c").alias("cb"), F.col("n").alias("na"), F.col("p.n").alias("nb"), F.col("parity").alias("pa"), F.col("p.parity").alias("pb")
    )
    return sides.filter(_may_reach(least)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def across_pairs(rows: DataFrame, least: float) -> DataFrame:
    """All pairs across the groups of ``rows`` that may reach the similarity: no other pair can.

    Such texts share ``least / (1 + least)`` of their k-mers, so in any order of all k-mers they
    share one of the first few of each: of n k-mers ``n - ceil(least n) + 1`` of the longer text and
    ``n - ceil(2 least / (1 + least) n) + 1`` of the shorter one. The order goes by rarity, so a passage that many
    texts have comes last in all of them and brings no two together. What is left of both behind a shared k-mer must
    be enough as well.
    """
    share = least / (1 + least)
    index = rows.filter(F.col("i") <= F.col("n") - F.ceil(2 * share * F.col("n") - 1e-9)).select("x", "g", "c", "n", "i", "parity").toDF("x", "a", "ca", "na", "ia", "pa")
    probe = rows.select("x", "g", "c", "n", "i", "parity").toDF("x", "b", "cb", "nb", "ib", "pb")
    shorter = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    enough = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= share * (F.col("na") + F.col("nb")) - 1e-9
    pairs = index.join(probe, "x").filter(shorter & enough & _may_reach(least))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _grouped(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the group ``c`` that ``links`` give each text ``g``; a text without links is its own."""
    groups = components(links).select(F.col("id").alias("g"), F.col("component").alias("_c"))
    return rows.drop("c").join(groups, "g", "left").withColumn("c", F.coalesce("_c", "g")).drop("_c")


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def near_duplicates(
    docs: DataFrame, k: int = K, ell: int = ELL, m: int = SKETCHES, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, class_id, cluster_id, kept`` for every row of ``docs``.

    ``class_id`` is the smallest id with an equal text, ``cluster_id`` the smallest id that links of
    similarity ``least`` or more reach, ``kept`` whether the row's id is that one. A null text is
    equal to nothing; empty texts, and texts of white space alone, are equal only to the same text.
    A text of fewer than ``k`` words is one k-mer. Repeated rows are copies of each other. An empty
    table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("g", text_key(F.col("text")))
    slim = store(rows.select("id", "g"), "texts")
    classes = store(slim.filter("g is not null").groupBy("g").agg(F.min("id").alias("first")), "classes")
    # Equal texts have equal sketches.
    texts = rows.filter("g is not null").select("g", "text", "id")
    sketched = texts.select("g", "text").mapInArrow(_sketch_rows(k, ell, m), "g binary, sketches array<long>")
    sketched = store(sketched.groupBy("g").agg(F.first("sketches").alias("s")), "sketches")
    buckets = sketched.select("g", "s", F.posexplode("s").alias("t", "key")).select(
        "g", "t", "key", F.element_at("s", (F.col("t") + 1) % m + 1).alias("key2")
    )
    buckets = store(buckets, "buckets")
    shared = buckets.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1")
    full = store(buckets.join(shared, ["t", "key"]).withColumn("c", F.col("g")), "shared")
    drop_stored(buckets)
    # The words of one row of each text that has a candidate; every later step reads these.
    needed = full.select("g").distinct().join(classes, "g").select("g", F.col("first").alias("id"))
    needed = texts.join(needed.hint("merge"), ["g", "id"], "left_semi").dropDuplicates(["g", "id"])
    words = store(needed.select("g", "text").mapInArrow(_word_rows, "g binary, words binary"), "words")
    # First the same few texts are picked in all sketches, so most pairs come up again and again.
    first = F.xxhash64("g")
    pairs = store(_picked(full, ["t", "key"], first).union(_picked(full.filter("n > 2"), ["t", "key", "key2"], first)).distinct(), "pairs")
    links = _linked(pairs, words, k, least)
    groups = components(links)
    # Then the buckets whose texts are not one group yet: pairs across their groups.
    grouped = full.drop("c").join(groups.select(F.col("id").alias("g"), F.col("component").alias("c")), "g", "left").withColumn("c", F.coalesce("c", "g"))
    split = grouped.groupBy("t", "key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
    open_rows = store(grouped.join(split.select("t", "key"), ["t", "key"]).select("g", "t", "key", "key2", "n", "c"), "open")
    few, many = open_rows.filter(F.col("n") <= SMALL_BUCKET), open_rows.filter(F.col("n") > SMALL_BUCKET)
    x, y = few.select("t", "key", F.col("g").alias("a"), F.col("c").alias("ca")), few.select("t", "key", F.col("g").alias("b"), F.col("c").alias("cb"))
    across = x.join(y, ["t", "key"]).filter("a < b and ca <> cb").select("a", "b")
    again = store(across.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = _linked(again, words, k, least)
    # In large ones, by their rarest k-mers: first with one text each, then, where that left several groups, all across.
    links = store(links.union(more), "links")
    mixed_texts = store(many.select("g", "c").distinct().join(words, "g"), "mixed")
    rare = rare_rows(mixed_texts, k, least)
    near = mixed_texts.select("g", "words")
    stars = store(star_pairs(rare, least).join(pairs, ["a", "b"], "left_anti").join(again, ["a", "b"], "left_anti"), "pairs")
    links = store(links.union(_linked(stars, near, k, least)), "links")
    left = store(_met(_grouped(rare, links)), "rarest")
    rest = across_pairs(left, least).join(pairs, ["a", "b"], "left_anti").join(again, ["a", "b"], "left_anti").join(stars, ["a", "b"], "left_anti")
    links = store(links.union(_linked(rest, near, k, least)), "links")
    for done in (full, open_rows, words, sketched, pairs, again, mixed_texts, rare, stars, left):
        drop_stored(done)
    groups = components(links)
    drop_stored(links)
    named = classes.join(groups.withColumnRenamed("id", "g"), "g", "left").withColumn("c", F.coalesce("component", "g"))
    least_id = named.groupBy("c").agg(F.min("first").alias("cluster_id"))
    named = named.join(least_id, "c").select("g", F.col("first").alias("class_id"), "cluster_id")
    return slim.join(named, "g", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("cluster_id", "id").alias("cluster_id"),
        F.coalesce(F.col("cluster_id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all their columns, of which one document of each group stays: the one with the smallest id.

    Null texts are groups of their own; texts without a word are grouped only with equal ones. Of repeated
    rows (one id and text) one stays; of rows with one id and other texts, those of the kept id stay. Rows
    without an id stay as well. An empty table stays empty. Texts are read whole.
    """
    gone = near_duplicates(docs, id_col=id_col, text_col=text_col, **options).filter("not kept").select(id_col).distinct()
    return docs.join(gone.hint("merge"), id_col, "left_anti").select(*docs.columns).dropDuplicates([id_col, text_col])
