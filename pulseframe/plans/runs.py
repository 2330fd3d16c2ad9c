"""A whole extraction run: plan, land, move the watermarks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import paths
from pulseframe.operators.discovery import missing_keys, new_until_known, new_until_known_by, new_until_stop
from pulseframe.operators.normalize import normalize_daily, normalize_keyed, normalize_range
from pulseframe.operators.upsert import LandedTable
from pulseframe.operators.watermarks import StateLog, daily_requests, fetch_windows, range_requests
from pulseframe.sources.envelope import to_envelope
from pulseframe.sources.registry import COLLECTORS, KEYED_METHODS, select_collectors, selected_tables


def land_run(
    table: LandedTable,
    state: StateLog,
    windows: DataFrame,
    fetched_range: DataFrame,
    fetched_daily: DataFrame,
    run_date: str,
    extracted_at: str,
    run_seq: int,
) -> dict[str, int]:
    """Land what the requests of ``windows`` returned, for all collectors in one job; rows staged by collector.

    Payloads that do not parse go to the table's quarantine and the rest lands.
    Rows are written before the watermarks, and both under the run's number: a
    run that dies anywhere is simply repeated, given windows planned from
    ``state.current(before=run_seq)``. Runs of one number for other sets of collectors are other writers.
    """
    names = sorted(r[0] for r in windows.select("collector_name").distinct().collect())  # 20 at most
    rows = normalize_range(fetched_range, strict=False).unionByName(normalize_daily(fetched_daily, strict=False))
    landed = to_envelope(rows, extracted_at=extracted_at, batch_seq=run_seq)
    counts = table.append_counted(landed, run_seq, _writer_of(names), "collector_name", names)
    state.append(windows, run_date, paths.iso_instant_to_utc_ntz(F.lit(extracted_at)), run_seq)
    return counts


def _writer_of(names: list[str]) -> str:
    """The writer of a set of collectors; all of them are ``collectors``."""
    if len(names) == len(COLLECTORS):
        return "collectors"
    return f"collectors-{hashlib.md5(','.join(names).encode()).hexdigest()[:16]}"


def _keys_of(table: LandedTable, name: str, before: int | None) -> DataFrame:
    """Keys of one landed table: the natural key, led by the subject if there are many."""
    keys = [k for k in table.keys if k != "collector_name"]
    return table.known_keys(F.col("collector_name") == name, keys, before)


def _land_keyed(table: LandedTable, name: str, fetched: DataFrame, extracted_at: str, run_seq: int) -> int:
    labelled = fetched.withColumns(
        {"collector_name": F.lit(name), "source_method": F.lit(KEYED_METHODS[name])}
    )
    rows = normalize_keyed(labelled, F.col("natural_key"), strict=False)
    return table.append(to_envelope(rows, extracted_at=extracted_at, batch_seq=run_seq), run_seq, name.lower())


def land_new_activities(
    table: LandedTable, feed: DataFrame, newest_first: str, extracted_at: str, run_seq: int, page: str | None = None
) -> int:
    """Land the feed's newest activities up to the first one that is known, for every subject by itself; rows staged.

    ``feed`` has ``natural_key``, ``payload`` and the position column ``newest_first``; with a
    ``subject_id`` each subject has its own cut, and an id is known only under its subject. With the
    number of the ``page`` an entry came on, entries behind the first page that is not full are not reached.
    """
    known = _keys_of(table, "ACTIVITIES", before=run_seq)
    subject = "subject_id" if "subject_id" in table.keys else None
    if page is not None:
        fresh = new_until_stop(feed, known, "natural_key", newest_first, page, subject)
    elif subject:
        fresh = new_until_known_by(feed, known, "natural_key", newest_first, subject)
    else:
        fresh = new_until_known(feed, known, "natural_key", newest_first)
    return _land_keyed(table, "ACTIVITIES", fresh, extracted_at, run_seq)


def details_to_fetch(table: LandedTable, before: int | None = None, details_before: int | None = None) -> DataFrame:
    """Activities, with their subject, that were landed without their details so far.

    Runs numbered ``before`` count, for the details those ``details_before`` if it is given.
    """
    keys = [k for k in table.keys if k != "collector_name"]
    have = _keys_of(table, "ACTIVITY_DETAILS", before if details_before is None else details_before)
    return missing_keys(_keys_of(table, "ACTIVITIES", before), have, keys)


def land_details(table: LandedTable, fetched: DataFrame, extracted_at: str, run_seq: int) -> int:
    """Land fetched details; an empty answer lands nothing and stays missing, a broken one is quarantined. Rows staged."""
    return _land_keyed(table, "ACTIVITY_DETAILS", fetched, extracted_at, run_seq)


def full_run(
    table: LandedTable,
    state: StateLog,
    subjects: DataFrame,
    fetch: Mapping[str, Callable[..., DataFrame]],
    run_date: str,
    extracted_at: str,
    run_seq: int,
    newest_first: str = "recency",
    only: str | None = None,
    since: str | None = None,
    page: str | None = None,
) -> dict[str, int]:
    """One whole run under one number: activities, their details, then all collectors; rows staged by table.

    ``fetch`` answers requests: ``activities()`` with the feed, ``details(missing)``,
    ``range(requests)`` and ``daily(requests)`` with payloads. ``only`` names any of the landed
    tables; ``since`` moves the collectors' windows and leaves activities alone. A run that died
    is repeated with its number; runs of one number for other tables leave its rows and marks alone.
    """
    names = selected_tables(only)
    counts = dict.fromkeys(sorted(names), 0)
    if "ACTIVITIES" in names:
        counts["ACTIVITIES"] = land_new_activities(table, fetch["activities"](), newest_first, extracted_at, run_seq, page)
    if "ACTIVITY_DETAILS" in names:
        missing = details_to_fetch(table, before=run_seq + 1, details_before=run_seq)
        counts["ACTIVITY_DETAILS"] = land_details(table, fetch["details"](missing), extracted_at, run_seq)
    if select_collectors(only):
        windows = fetch_windows(subjects, state.current(before=run_seq), run_date, since, only)
        ranged, daily = fetch["range"](range_requests(windows)), fetch["daily"](daily_requests(windows))
        counts |= land_run(table, state, windows, ranged, daily, run_date, extracted_at, run_seq)
    return counts
