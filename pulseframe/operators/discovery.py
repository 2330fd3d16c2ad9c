"""Finding keys that still have to be fetched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SALTS = 16  # join tasks a dominant subject is spread over
DETAIL_BATCH_SIZE = 20  # fixed value: rows written per flush
PAGE_SIZE = 100  # fixed value: entries of a full page of the feed


def missing_keys(wanted: DataFrame, present: DataFrame, keys: Sequence[str] = ("natural_key",)) -> DataFrame:
    """Keys of ``wanted`` that ``present`` lacks.

    Both sides are reduced to distinct keys first; the anti join then reuses
    that hash partitioning, so each side is shuffled once, keys only.
    """
    return (
        wanted.select(*keys)
        .distinct()
        .join(present.select(*keys).distinct(), list(keys), "left_anti")
    )


def new_until_known(feed: DataFrame, known: DataFrame, key: str, newest_first: str) -> DataFrame:
    """The newest entries of a feed, up to the first one already known.

    ``newest_first`` is a numeric feed position that falls with age. Everything
    at or behind the first known entry is dropped, also if unknown. The cut is
    a single number, applied as a scalar subquery that reaches the feed's scan.
    """
    hits = feed.select(key, newest_first).join(known.select(key).distinct(), key, "left_semi")
    cut = hits.agg(F.max(newest_first)).scalar()
    return feed.filter(cut.isNull() | (F.col(newest_first) > cut))


def new_until_known_by(
    feed: DataFrame, known: DataFrame, key: str, newest_first: str, subject: str, salts: int = SALTS
) -> DataFrame:
    """:func:`new_until_known` for a feed of many subjects, each with its own cut.

    The cuts, one row per subject, are repeated ``salts`` times, so the feed of
    a dominant subject is spread over that many join tasks. They are few enough
    next to the feed that adaptive execution often broadcasts them instead.
    """
    cuts = _known_cuts(feed, known, key, newest_first, subject)
    return _up_to(feed, cuts, F.col(newest_first) <= F.col("_cut"), key, subject, salts)


def _known_cuts(feed: DataFrame, known: DataFrame, key: str, newest_first: str, subject: str) -> DataFrame:
    """The position of every subject's first known entry."""
    hits = feed.select(subject, key, newest_first).join(known.select(subject, key).distinct(), [subject, key], "left_semi")
    return hits.groupBy(subject).agg(F.max(newest_first).alias("_cut"))


def _up_to(feed: DataFrame, cuts: DataFrame, behind: Column, key: str, subject: str, salts: int) -> DataFrame:
    """``feed`` less the entries ``behind`` their subject's cuts, which are repeated for every salt."""
    slices = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    salted = feed.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    found = salted.join(cuts.select("*", slices), [subject, "_salt"], "left")
    return found.filter(~F.coalesce(behind, F.lit(False))).select(*feed.columns)


def last_pages(feed: DataFrame, page: str, subject: str, size: int = PAGE_SIZE) -> DataFrame:
    """``subject, last_page``: the first page of every subject that is not full, which is the last one read.

    An empty page has no entries at all, so it shows as a number that is not there. The first
    number that is not a full page is 0 or follows a full page: candidates and full pages meet by
    subject and number, and no task sees all pages of a subject. ``feed`` is reduced to a row a page before the shuffle.
    """
    full = feed.groupBy(subject, F.col(page).cast("bigint").alias("_page")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= size).drop("_n")
    first = feed.select(subject).distinct().select(subject, F.lit(0).cast("bigint").alias("_page"))
    following = full.select(subject, (F.col("_page") + 1).alias("_page"))
    open_pages = first.unionByName(following).join(full, [subject, "_page"], "left_anti").filter("_page >= 0")
    return open_pages.groupBy(subject).agg(F.min("_page").alias("last_page"))


def new_until_stop(
    feed: DataFrame,
    known: DataFrame,
    key: str,
    newest_first: str,
    page: str,
    subject: str | None = None,
    size: int = PAGE_SIZE,
    salts: int = SALTS,
) -> DataFrame:
    """:func:`new_until_known_by` of a feed that is read page by page, from page 0.

    Reading ends with the first page that is short or empty as well as at the first known entry;
    what lies behind either is dropped. A null or negative page is never read. Without a ``subject`` there is one feed.
    """
    if subject is None:
        one = "_one"
        whole, have = feed.withColumn(one, F.lit(1)), known.select(key).withColumn(one, F.lit(1))
        return new_until_stop(whole, have, key, newest_first, page, one, size, salts).select(*feed.columns)
    cuts = last_pages(feed, page, subject, size).join(_known_cuts(feed, known, key, newest_first, subject), subject, "left")
    unread = F.coalesce(F.col(page) > F.col("last_page"), F.lit(True)) | (F.col(page) < 0)
    return _up_to(feed, cuts, unread | F.coalesce(F.col(newest_first) <= F.col("_cut"), F.lit(False)), key, subject, salts)


def update_pending(pending: DataFrame, changes: DataFrame, keys: Sequence[str], wanted: str, answer: str) -> DataFrame:
    """Keys of which only one of two landed tables has a row, after ``changes``; ``has_wanted`` and ``has_answer`` say which.

    ``pending`` is the result for an earlier version of the table, or has no rows; ``changes`` is the
    feed since then. Only keys inserted in one of the two tables count, and a key that both have
    drops out for good: so neither table is read again, and what is kept has the size of
    what is open. Each side is reduced by key before the shuffle.
    """
    keys = list(keys)
    fresh = changes.filter((F.col("change") == "inserted") & F.col("collector_name").isin(wanted, answer))
    fresh = fresh.select(*keys, (F.col("collector_name") == wanted).alias("has_wanted"), (F.col("collector_name") == answer).alias("has_answer"))
    sides = [F.bool_or(c).alias(c) for c in ("has_wanted", "has_answer")]
    return pending.select(*fresh.columns).unionByName(fresh).groupBy(*keys).agg(*sides).filter("not (has_wanted and has_answer)")


def number_in_order(sorted_rows: DataFrame, path: str, name: str = "row_index") -> DataFrame:
    """0-based index of rows in their global order, without a one-task window.

    ``sorted_rows`` is globally sorted. It is written to ``path`` (a shared
    folder) with each row's partition and offset, so the numbering cannot shift
    if tasks are re-run; the per-partition counts, one row per partition, then
    give every partition its starting index.
    """
    spark = sorted_rows.sparkSession
    row_id = F.monotonically_increasing_id()
    # The id packs the partition number above a 33-bit offset.
    tagged = sorted_rows.withColumn("_id", row_id)
    tagged.write.mode("errorifexists").parquet(path)
    stored = spark.read.parquet(path).select(
        *sorted_rows.columns,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND((1 << 33) - 1).alias("_offset"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    return stored.join(F.broadcast(starts), "_part").select(
        *sorted_rows.columns, (F.col("_start") + F.col("_offset")).alias(name)
    )


def fetch_batches(missing: DataFrame, path: str, key: str = "natural_key", size: int = DETAIL_BATCH_SIZE) -> DataFrame:
    """Missing keys in key order, cut into write batches of ``size``."""
    indexed = number_in_order(missing.orderBy(key), path)
    return indexed.withColumn("batch_no", F.floor(F.col("row_index") / size)).drop("row_index")
