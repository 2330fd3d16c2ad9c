"""Keyed, replay-safe upserts.

Storage is an append-only log of batches plus versioned snapshots; a row's
place in time is ``(extracted_at, batch_seq, revision, row_seq)``, so replaying a batch or
landing batches out of order cannot change the outcome.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.sources.envelope import BATCH_COLUMN, ENVELOPE_SCHEMA, ORDER_COLUMNS, REVISION_COLUMN, ROW_COLUMN, read_or_empty

DEFAULT_KEYS = ("natural_key",)
WRITER_COLUMN = "writer"
BUCKET_COLUMN = "bucket"
CHANGE_COLUMN = "change"
BUCKETS = 16
EMPTY_LOG = T.StructType(
    [
        *ENVELOPE_SCHEMA.fields,
        T.StructField(ROW_COLUMN, T.LongType()),
        T.StructField("rejected_text", T.StringType()),
        T.StructField(WRITER_COLUMN, T.StringType()),
        T.StructField(BATCH_COLUMN, T.LongType()),
        T.StructField(REVISION_COLUMN, T.LongType()),
        T.StructField("is_rejected", T.BooleanType()),
    ]
)
# A version's notes: a row for each batch it holds, and one for each key bucket.
MARKS = T.StructType(
    [
        T.StructField(WRITER_COLUMN, T.StringType()),
        T.StructField(BATCH_COLUMN, T.LongType()),
        T.StructField(REVISION_COLUMN, T.LongType()),
        T.StructField(BUCKET_COLUMN, T.StringType()),
        T.StructField("stored_in", T.LongType()),
        T.StructField("layout", T.StringType()),
    ]
)


def _position(df: DataFrame, order: Sequence[str] | None) -> Column:
    """A comparable struct that places a row in time; between writers at one time the name decides."""
    return F.struct(*[F.col(c) for c in order or [*ORDER_COLUMNS, WRITER_COLUMN] if order or c in df.columns])


def latest_by_key(
    log: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of every key.

    An aggregate, not a window: each task first keeps one row per key, so a key
    holding a third of the log sends one row per task and no task sees them all.
    """
    rest = [c for c in log.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), _position(log, order)).alias("_w")
    return log.groupBy(*keys).agg(winner).select(*keys, "_w.*").select(*log.columns)


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """``current`` (one row per key) after landing ``batch``.

    A batch row replaces the current one only if it is newer. ``current`` is
    read once with payloads and once for its keys; both joins are on unique
    keys, so neither can skew. A stored batch has a size Spark knows from its
    files: below the broadcast threshold it travels to the large table, which
    is then neither shuffled nor sorted; above it both sides meet by key.
    """
    keys = list(keys)
    rest = [c for c in current.columns if c not in keys]
    newest = latest_by_key(batch.select(*current.columns), keys, order)
    incoming = newest.select(
        *keys, F.struct(*rest).alias("_new"), _position(newest, order).alias("_new_at")
    )
    replaced = current.withColumn("_at", _position(current, order)).join(incoming, keys, "left")
    is_newer = F.col("_new_at").isNotNull() & (F.col("_new_at") > F.col("_at"))
    resolved = replaced.select(
        *keys, F.when(is_newer, F.col("_new")).otherwise(F.struct(*rest)).alias("_w")
    ).select(*keys, "_w.*")
    added = newest.join(current.select(*keys), keys, "left_anti")
    return resolved.unionByName(added).select(*current.columns)


def replace_keys(current: DataFrame, newest: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """:func:`upsert` of a stored batch that already has one row per key.

    The batch's keys are looked up in ``current`` by key and time alone; then ``current`` is read
    once with payloads, less the keys that are replaced. It meets nothing but these keys: below the
    broadcast threshold it is neither shuffled nor sorted, its keys no more than its payloads.
    """
    keys = list(keys)
    held = current.select(*keys, _position(current, order).alias("_at")).join(newest.select(*keys), keys)
    newer = F.col("_at").isNull() | (_position(newest, order) > F.col("_at"))
    winners = newest.join(held, keys, "left").filter(newer).select(*current.columns)
    untouched = current.join(winners.select(*keys), keys, "left_anti").select(*current.columns)
    return untouched.unionByName(winners)


def existing_keys(table: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Distinct keys already landed."""
    return table.select(*keys).distinct()


def change_feed(before: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Those of ``rows`` (one a key) that are new to ``before`` (one a key) or newer, with ``change``.

    ``inserted`` keys were not there, ``replaced`` ones were. ``before`` is read for its keys and
    times alone; both sides have unique keys, so the join cannot skew.
    """
    keys = list(keys)
    held = before.select(*keys, _position(before, order).alias("_at"))
    found = rows.withColumn("_new_at", _position(rows, order)).join(held, keys, "left")
    newer = found.filter(F.col("_at").isNull() | (F.col("_new_at") > F.col("_at")))
    change = F.when(F.col("_at").isNull(), "inserted").otherwise("replaced")
    return newer.select(*rows.columns, change.alias(CHANGE_COLUMN))


@dataclass(frozen=True)
class Version:
    """What a snapshot holds: batches as ``(writer, number, revision)``, and the version each bucket was last written in."""

    batches: frozenset[tuple[str, int, int]] = frozenset()
    buckets: dict[str, int] = field(default_factory=dict)
    layout: str | None = None


class LandedTable:
    """A landed table kept as ``log/writer=W/batch_seq=N/revision=R`` folders and versioned snapshots.

    ``append`` overwrites its own batch folder, so a retried batch replaces itself. Each writer (a
    run's collectors, its activities, a stream) numbers its own batches, so none can replace
    another's.

    ``compact`` makes a new version. Its rows lie in key buckets, ``snapshot/version=V/bucket=K``,
    and only buckets with keys of new batches are written; for the others the version names the one
    they were written in. No folder that is read is ever touched, and a version counts from the moment its
    notes are written, which is last. The notes list the batches it holds one by one, so a batch that
    lands late, whatever its number, is read on top of it; a batch the version holds already lands
    as a new revision, later than the first, and none of its rows is lost either.

    ``partition_by`` lays columns such as ``collector_name`` out as folders, so
    reading one collector reads only its files.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = DEFAULT_KEYS,
        partition_by: Sequence[str] = (),
        subject: str = "subject_id bigint",
        bucket_by: str | None = None,
    ):
        """``subject`` declares the subject column's type, for a table that holds nothing yet.

        ``bucket_by`` is a SQL expression over the keys that names a row's bucket; keys that change together
        belong together, such as the days of a month. Without one it is a hash into ``BUCKETS``. The
        first version fixes it.
        """
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partition_by = tuple(keys), tuple(partition_by)
        self.subject = dict([subject.split()])
        self.bucket_by = bucket_by or f"pmod(xxhash64({', '.join(keys)}), {BUCKETS})"
        self._versions: dict[int, Version] = {}

    # Folders

    def _folder(self, relative: str):
        """A path below the table's and its file system."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{relative}")
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _found(self, pattern: str) -> list[dict[str, str]]:
        """Names and values of the folders on the paths that match."""
        path, store = self._folder(pattern)
        paths = [f.getPath().toString() for f in store.globStatus(path) or []]
        return [dict(p.split("=", 1) for p in f.split("/") if "=" in p) for f in paths]

    def _delete(self, relative: str) -> None:
        path, store = self._folder(relative)
        store.delete(path, True)

    def batches(self) -> set[tuple[str, int, int]]:
        """``(writer, number, revision)`` of every finished batch folder, rows or not."""
        return {(f[WRITER_COLUMN], int(f[BATCH_COLUMN]), int(f[REVISION_COLUMN])) for f in self._found("log/*/*/*/_SUCCESS")}

    def versions(self) -> list[int]:
        """Finished snapshots, oldest first."""
        return sorted(int(f["version"]) for f in self._found("marks/version=*/_SUCCESS"))

    def _retired(self) -> list[int]:
        return [int(f["version"]) for f in self._found("retired/version=*")]

    def newest_version(self, before: int | None = None) -> int | None:
        """The latest finished snapshot, of those below ``before`` if given; None without one."""
        return max((v for v in self.versions() if before is None or v < before), default=None)

    def _version(self, version: int | None) -> Version:
        """A version's notes, which never change: a row a batch and a row a bucket."""
        if version is None:
            return Version()
        if version not in self._versions:
            notes = self.spark.read.schema(MARKS).parquet(f"{self.path}/marks/version={int(version)}").collect()
            self._versions[version] = Version(
                frozenset((n[WRITER_COLUMN], n[BATCH_COLUMN], n[REVISION_COLUMN]) for n in notes if n[BUCKET_COLUMN] is None),
                {n[BUCKET_COLUMN]: n["stored_in"] for n in notes if n[BUCKET_COLUMN] is not None},
                next((n["layout"] for n in notes if n["layout"]), None),
            )
        return self._versions[version]

    def _checked(self, version: int | None) -> Version:
        """A version's notes, if the log has all that it lacks."""
        found = self._version(version)
        for gone in self._retired():
            if not self._version(gone).batches <= found.batches:
                raise ValueError(f"version {version} lacks batches that were retired with version {gone}: start from that or a later one")
        return found

    # Landing

    def append(self, rows: DataFrame, batch_seq: int, writer: str = "main") -> int:
        """Write a batch of a writer and return the rows staged; leniently parsed rows put their rejects next to it.

        Rows of a partitioned table are rebalanced first: folders get few, even
        files, and a dominant collector is split over several tasks. The writing job counts the
        rows as it writes them; rejects are not staged.
        """
        return self._write(rows, batch_seq, writer, {"staged": ~F.col("is_rejected")})["staged"]

    def append_counted(self, rows: DataFrame, batch_seq: int, writer: str, column: str, values: Iterable[str]) -> dict[str, int]:
        """As :meth:`append`; the rows staged for each of the named values of a column, zeros among them."""
        return self._write(rows, batch_seq, writer, {v: (F.col(column) == v) & ~F.col("is_rejected") for v in values})

    def _write(self, rows: DataFrame, batch_seq: int, writer: str, counted: dict[str, Column]) -> dict[str, int]:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_.-]*", writer):
            raise ValueError(f"a writer's name is a letter, then letters, digits, _ . or -: {writer!r}")
        if self.partition_by:
            rows = rows.hint("rebalance", *self.partition_by)
        rejected = F.col("rejected_text") if "rejected_text" in rows.columns else F.lit(None).cast("string")
        rows = rows.drop(BATCH_COLUMN, REVISION_COLUMN).withColumn("rejected_text", rejected).withColumn("is_rejected", F.col("rejected_text").isNotNull())
        held = self._version(self.newest_version()).batches
        revision = max((r + 1 for w, n, r in held if (w, n) == (writer, int(batch_seq))), default=0)
        seen = Observation()
        names = {f"n{i}": name for i, name in enumerate(counted)}
        metrics = [F.count_if(F.coalesce(counted[name], F.lit(False))).alias(n) for n, name in names.items()]
        observed = rows.observe(seen, *metrics) if metrics else rows
        observed.write.mode("overwrite").partitionBy("is_rejected", *self.partition_by).parquet(
            f"{self.path}/log/{WRITER_COLUMN}={writer}/{BATCH_COLUMN}={int(batch_seq)}/{REVISION_COLUMN}={revision}"
        )
        found = seen.get if metrics else {}
        return {name: int(found.get(n) or 0) for n, name in names.items()}

    # Reading

    def _stored(self) -> DataFrame:
        kinds = T.StructType.fromDDL(", ".join(f"{k} {self.subject.get(k, 'string')}" for k in self.keys))
        extra = [f for f in kinds.fields if f.name not in EMPTY_LOG.fieldNames()]
        rows = read_or_empty(self.spark, f"{self.path}/log", T.StructType([*extra, *EMPTY_LOG.fields]))
        # Folder names come back as text or small numbers.
        numbers = {c: F.col(c).cast("bigint") for c in (BATCH_COLUMN, REVISION_COLUMN)}
        return rows.withColumns({**numbers, "is_rejected": F.col("is_rejected").cast("boolean")})

    def _landed(self, batches: Iterable[tuple[str, int, int]] | None = None) -> DataFrame:
        """Landed rows of all batches, or of the named ones, whose folders alone are read."""
        rows = self._stored().filter(~F.col("is_rejected")).drop("rejected_text", "is_rejected")
        if batches is None:
            return rows
        numbers: dict[tuple[str, int], list[int]] = {}
        for writer, n, revision in batches:
            numbers.setdefault((writer, revision), []).append(n)
        chosen = [(F.col(WRITER_COLUMN) == w) & (F.col(REVISION_COLUMN) == r) & F.col(BATCH_COLUMN).isin(sorted(n)) for (w, r), n in sorted(numbers.items())]
        return rows.filter(reduce(lambda a, b: a | b, chosen, F.lit(False)))

    def log(self, after: int | None = None, before: int | None = None) -> DataFrame:
        """Landed rows of all batches, or of those after or before a batch number.

        A job that appends batch ``n`` from what is known must read ``before=n``:
        a retry then sees the same rows and never the folder it replaces.
        """
        rows = self._landed().drop(WRITER_COLUMN)
        if after is not None:
            rows = rows.filter(F.col(BATCH_COLUMN) > after)
        return rows if before is None else rows.filter(F.col(BATCH_COLUMN) < before)

    def rejected(self) -> DataFrame:
        """Rows whose payload did not parse, with the batch they came in."""
        return self._stored().filter("is_rejected").drop("raw_data", "is_rejected")

    def quarantine(self) -> DataFrame:
        """Rows whose payload did not parse."""
        return self.rejected().drop(WRITER_COLUMN, REVISION_COLUMN)

    def redrive(self, mended: Column, run_seq: int) -> int:
        """Land quarantined payloads whose ``mended`` text parses, each at its original place in time; rows staged.

        A mended row keeps its extraction time, batch and row number, so whatever landed later than the
        broken one still wins. The rows are a writer of their own for each ``run_seq`` and writer they came from: a run
        that died is repeated under its number, and a later run that mends others takes nothing back.
        What does not parse stays where it is. One job for each batch with rejects.
        """
        broken = self.rejected().withColumn("raw_data", F.try_parse_json(mended))
        broken = broken.filter("raw_data is not null and writer not like 'redrive%'").drop("rejected_text")
        origins = broken.select(WRITER_COLUMN, BATCH_COLUMN).distinct().collect()  # a row a batch with rejects
        staged = 0
        for origin in sorted(origins):
            own = (F.col(WRITER_COLUMN) == origin[0]) & (F.col(BATCH_COLUMN) == origin[1])
            staged += self.append(broken.filter(own).drop(WRITER_COLUMN), origin[1], f"redrive{int(run_seq)}.{origin[0]}")
        return staged

    def still_rejected(self, keys: Sequence[str] = ()) -> DataFrame:
        """Rejects that no redrive has landed yet, by batch and row."""
        place = [*(keys or self.keys), BATCH_COLUMN, ROW_COLUMN]
        done = self._landed().filter(f"{WRITER_COLUMN} like 'redrive%'")
        done = done.select(F.regexp_replace(WRITER_COLUMN, r"^redrive\d+\.", "").alias(WRITER_COLUMN), *place)
        return self.rejected().join(done, [WRITER_COLUMN, *place], "left_anti").drop(WRITER_COLUMN, REVISION_COLUMN)

    def _bucket(self, layout: str | None) -> Column:
        """A row's bucket as a folder name."""
        return F.concat(F.lit("b"), F.coalesce(F.expr(layout or self.bucket_by).cast("string"), F.lit("null")))

    def _touched(self, rows: DataFrame, layout: str | None) -> set[str]:
        """Buckets of ``rows``: at most as many values as there are buckets."""
        return {r[0] for r in rows.select(self._bucket(layout)).distinct().collect()}

    def _rows_in(self, found: Version, buckets: Iterable[str]) -> DataFrame:
        """The version's rows of some buckets; no other folder is read."""
        homes: dict[int, list[str]] = {}
        for b in buckets:
            if b in found.buckets:
                homes.setdefault(found.buckets[b], []).append(b)
        if not homes:
            return self._landed([]).drop(WRITER_COLUMN)
        rows = self.spark.read.parquet(f"{self.path}/snapshot")
        chosen = [(F.col("version") == v) & F.col(BUCKET_COLUMN).isin(sorted(b)) for v, b in sorted(homes.items())]
        return rows.filter(reduce(lambda a, b: a | b, chosen)).drop("version", BUCKET_COLUMN)

    def _split(self, found: Version, touched: set[str]) -> tuple[DataFrame, DataFrame]:
        """The version's rows in the touched buckets, and the others."""
        return self._rows_in(found, touched), self._rows_in(found, set(found.buckets) - touched)

    def snapshot(self, version: int) -> DataFrame:
        found = self._version(version)
        return self._rows_in(found, found.buckets).drop(REVISION_COLUMN)

    def _tail(self, found: Version, through: int | None = None) -> set[tuple[str, int, int]]:
        """Batches that a version does not hold."""
        return {b for b in self.batches() - found.batches if through is None or b[1] <= through}

    def current(self, version: int | None = None) -> DataFrame:
        """Latest rows: snapshot ``version``, else the newest, plus the batches it does not hold.

        A table without a snapshot is read from its whole log. Buckets without keys of these batches
        are passed on as they are; in the others the keys are looked up.
        """
        version = self.newest_version() if version is None else version
        if version is None:
            return latest_by_key(self._landed(), self.keys).drop(WRITER_COLUMN, REVISION_COLUMN)
        found = self._checked(version)
        tail = self._tail(found)
        if not tail:
            return self.snapshot(version)
        return self._merged(found, self._landed(tail)).drop(REVISION_COLUMN)

    def _merged(self, found: Version, landed: DataFrame) -> DataFrame:
        touched, rest = self._split(found, self._touched(landed, found.layout))
        newest = latest_by_key(landed, self.keys).select(*touched.columns)
        return rest.unionByName(replace_keys(touched, newest, self.keys))

    def known_keys(self, where: Column | None = None, keys: Sequence[str] = (), before: int | None = None) -> DataFrame:
        """Distinct keys of the rows ``where`` holds, landed so far or before a batch number.

        Read from the newest snapshot below that number, which keeps one row a key, and the batches it lacks.
        """
        where, keys = F.lit(True) if where is None else where, list(keys or self.keys)
        version = self.newest_version(before)
        if version is None and not self._retired():
            rows = self._landed() if before is None else self._landed().filter(F.col(BATCH_COLUMN) < before)
            return existing_keys(rows.filter(where), keys)
        found = self._checked(version)
        tail = self._landed(self._tail(found, None if before is None else before - 1)).filter(where).select(*keys)
        return existing_keys(self._rows_in(found, found.buckets).filter(where).select(*keys).unionByName(tail), keys)

    def changes(self, after: int | None, upto: int | None = None) -> DataFrame:
        """Rows inserted or replaced since version ``after``, up to version ``upto`` or now, with ``change``.

        Up to now, only the batches that ``after`` lacks are read, with the keys of the buckets they
        touch; between versions, only the buckets written in between, so that retired batches are
        no loss. A key that changed several times comes once, as it is at the end. ``after=None`` is the empty table.
        """
        if upto is None:
            found = self._checked(after)
            rows = latest_by_key(self._landed(self._tail(found)), self.keys).drop(WRITER_COLUMN)
            touched = self._touched(rows, found.layout)
        else:
            found, end = self._version(after), self._version(upto)
            touched = {b for b, v in end.buckets.items() if found.buckets.get(b) != v}
            rows = self._rows_in(end, touched)
        before = self._rows_in(found, touched)
        return change_feed(before, rows.select(*before.columns), self.keys).drop(REVISION_COLUMN)

    # Snapshots

    def compact(self, through: int, base_version: int | None = None) -> DataFrame:
        """Write version ``through`` from the batches numbered up to it, on top of ``base_version`` or the newest one.

        A version that lacks batches whose rows were retired cannot be a base. Do not land a batch
        again while it is compacted.
        """
        base = self.newest_version() if base_version is None else base_version
        if base is not None and base > through:
            raise ValueError(f"version {base} is there already: versions go up")
        found = self._checked(base)
        tail = self._tail(found, through)  # fixed before rows are read
        landed = self._landed(tail)
        layout = found.layout or self.bucket_by
        touched = self._touched(landed, layout) if tail else set()
        target = f"{self.path}/snapshot/version={int(through)}"
        if touched:
            rows = self._rows_in(found, touched)
            newest = latest_by_key(landed, self.keys).select(*rows.columns)
            merged = replace_keys(rows, newest, self.keys) if found.buckets else newest
            # What a compaction that died left here counts for nothing.
            mode = "errorifexists" if through in self.versions() else "overwrite"
            folders = [BUCKET_COLUMN, *self.partition_by]
            merged.withColumn(BUCKET_COLUMN, self._bucket(layout)).hint("rebalance", *folders).write.mode(mode).partitionBy(*folders).parquet(target)
        batches = [(w, n, r, None, None, None) for w, n, r in sorted(found.batches | tail)]
        homes = {**found.buckets, **dict.fromkeys(touched, int(through))}
        buckets = [(None, None, None, b, v, layout) for b, v in sorted(homes.items())]
        notes = self.spark.createDataFrame([*batches, *buckets], MARKS)
        notes.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/marks/version={int(through)}")
        return self.snapshot(through)

    def retire(self, version: int) -> None:
        """Delete the landed rows of the batches that snapshot ``version`` holds; the quarantine stays.

        ``log`` then has only what came after them. Versions that lack any of these batches can no
        longer be read with what came later. Call it when no job reads them any more.
        """
        note, store = self._folder(f"retired/version={int(version)}")
        store.mkdirs(note)  # first, so no reader trusts a half-deleted log
        for writer, n, revision in self._version(version).batches:
            self._delete(f"log/{WRITER_COLUMN}={writer}/{BATCH_COLUMN}={n}/{REVISION_COLUMN}={revision}/is_rejected=false")

    def expire(self, before: int) -> None:
        """Delete the versions below ``before`` and the buckets that no later version uses."""
        kept = [self._version(v) for v in self.versions() if v >= before]
        if not kept:
            raise ValueError(f"no version from {before} on would be left")
        used = {(v, b) for k in kept for b, v in k.buckets.items()}
        for old in [v for v in self.versions() if v < before]:
            homes = {b for b, v in self._version(old).buckets.items() if v == old}
            self._delete(f"marks/version={old}")  # first, so nobody starts from it
            for b in homes:
                if (old, b) not in used:
                    self._delete(f"snapshot/version={old}/{BUCKET_COLUMN}={b}")
