"""Independent SQL for the registered queries, written over the driver tables.

The SQL never sees a payload: it states what the result must be from the rows
the payloads were made of.
"""

from __future__ import annotations

TODAY = "2024-02-01"
ORACLES: dict[str, str] = {}

_EV = """ev AS (
  SELECT event_id, user_id, event_type, value, ts,
         epoch_us(ts) // 1000 AS ms,
         CAST(ts AS DATE) AS day,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)"""

_LANDED = "TIMESTAMP '2024-02-01 02:00:00' AS extracted_at"


def _ms(expr: str) -> str:
    return f"make_timestamp(({expr}) * 1000)"


# Landing

ORACLES["land_envelope"] = f"""
WITH {_EV}
SELECT CAST(event_id AS VARCHAR) AS natural_key, value, k,
       TIMESTAMP '2024-02-01 10:00:00' AS extracted_at, 'get_events' AS source_method
FROM ev
"""

ORACLES["quarantine_split"] = f"""
WITH {_EV}
SELECT CAST(event_id AS VARCHAR) AS natural_key,
       event_type = 'error' AS is_quarantined,
       CASE WHEN event_type <> 'error' THEN k END AS k,
       CASE WHEN event_type = 'error'
            THEN '{{{{"value":' || CAST(value AS VARCHAR) || ',"k":' || CAST(k AS VARCHAR) || '}}' END AS rejected_text
FROM ev
"""

_UD = """ud AS (
  SELECT user_id AS subject_id, day, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
         CAST(sum(k) AS BIGINT) AS sum_k, max(value) AS max_value, min(value) AS min_value,
         min(ms) AS first_ms, max(ms) AS last_ms
  FROM ev GROUP BY user_id, day
)"""
_DAYS = f"{_EV}, {_UD}"

_CHUNKS = f"""{_DAYS}, chunked AS (
  SELECT *, DATE '2024-01-01' + CAST((day - DATE '2024-01-01') // 27 * 27 AS INTEGER) AS chunk_start FROM ud
), items AS (
  SELECT *, row_number() OVER (PARTITION BY subject_id, chunk_start ORDER BY day) - 1 AS pos
  FROM chunked
)"""

ORACLES["normalize_range_payload"] = f"""
WITH {_CHUNKS}
SELECT subject_id,
       CASE WHEN n > 1 THEN CAST(day AS VARCHAR) ELSE CAST(chunk_start AS VARCHAR) || '_' || pos END AS natural_key,
       sum_k AS total_steps, 'get_daily_steps' AS source_method
FROM items
"""

ORACLES["derive_row_key"] = f"""
WITH {_CHUNKS}
SELECT subject_id, chunk_start, CAST(pos AS INTEGER) AS position,
       CASE WHEN n > 1 THEN CAST(day AS VARCHAR) END AS date_key
FROM items
"""

_SYNCED = """sync AS (
  SELECT event_id // 48 AS subject_id, CAST(day AS VARCHAR) AS natural_key, day, event_id, event_type, value, k, ms,
         count(*) OVER (PARTITION BY event_id // 48, day) AS n,
         row_number() OVER (PARTITION BY event_id // 48, day ORDER BY event_id DESC) AS newest
  FROM ev
)"""
_SYNC = f"{_EV}, {_SYNCED}"

ORACLES["normalize_daily_payload"] = f"""
WITH {_SYNC}
SELECT subject_id, natural_key, n AS num_items, event_type AS first_event_type,
       'get_body_battery_events' AS source_method
FROM sync WHERE newest = 1
"""

# Collectors as they must be: landed table, source method, kind.
_COLLECTOR_VALUES = """
  ('STEPS', 'get_daily_steps', 'range'), ('BODY_BATTERY', 'get_body_battery', 'range'),
  ('BODY_COMPOSITION', 'get_body_composition', 'range'), ('WEIGH_INS', 'get_weigh_ins', 'range'),
  ('ENDURANCE_SCORE', 'get_endurance_score', 'range'), ('HILL_SCORE', 'get_hill_score', 'range'),
  ('STATS', 'get_stats', 'daily'), ('RESTING_HEART_RATE', 'get_rhr_day', 'daily'),
  ('SLEEP', 'get_sleep_data', 'daily'), ('HRV', 'get_hrv_data', 'daily'),
  ('BODY_BATTERY_EVENTS', 'get_body_battery_events', 'daily'), ('ALL_DAY_STRESS', 'get_all_day_stress', 'daily'),
  ('TRAINING_READINESS', 'get_training_readiness', 'daily'), ('TRAINING_STATUS', 'get_training_status', 'daily'),
  ('FLOORS', 'get_floors', 'daily'), ('RESPIRATION', 'get_respiration_data', 'daily'),
  ('SPO2', 'get_spo2_data', 'daily'), ('INTENSITY_MINUTES', 'get_intensity_minutes_data', 'daily'),
  ('MAX_METRICS', 'get_max_metrics', 'daily'), ('HYDRATION', 'get_hydration_data', 'daily')"""
_REG = f"reg(collector_name, source_method, kind) AS (VALUES {_COLLECTOR_VALUES})"

ORACLES["landed_tables"] = f"""
WITH {_DAYS}, {_REG}
SELECT collector_name, count(*) AS num_rows, min(day) AS first_day, max(day) AS last_day,
       CAST(sum(sum_k) AS BIGINT) AS total_k
FROM ud, reg GROUP BY collector_name
"""

# Incremental load

ORACLES["upsert_latest"] = ORACLES["upsert_merge"] = ORACLES["snapshot_upsert"] = f"""
WITH {_EV}
SELECT user_id AS subject_id, event_type AS natural_key, arg_max(value, event_id) AS value, arg_max(k, event_id) AS k,
       CASE WHEN max(ts) < TIMESTAMP '2024-01-16' THEN TIMESTAMP '2024-01-16 02:00:00'
            ELSE TIMESTAMP '2024-02-01 02:00:00' END AS extracted_at,
       'get_events' AS source_method
FROM ev GROUP BY user_id, event_type
"""

ORACLES["stream_land"] = f"""
WITH {_EV}
SELECT user_id AS subject_id, event_type AS natural_key, arg_max(value, ts) AS value, arg_max(k, ts) AS k,
       max(ts) AS extracted_at, 'get_events' AS source_method
FROM ev GROUP BY user_id, event_type
"""

ORACLES["existing_keys_orders"] = "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS natural_key FROM lineitem"

_MISSING = """missing AS (
  SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS natural_key FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
)"""

ORACLES["missing_details_anti"] = f"WITH {_MISSING} SELECT natural_key FROM missing ORDER BY natural_key"

ORACLES["fetch_batches"] = f"""
WITH {_MISSING}
SELECT natural_key, (row_number() OVER (ORDER BY natural_key) - 1) // 20 AS batch_no FROM missing
"""

_KNOWN = "event_type = 'error' AND ts < TIMESTAMP '2024-01-28'"

ORACLES["new_until_known"] = f"""
SELECT CAST(event_id AS VARCHAR) AS activity_id, user_id, event_id AS recency
FROM events WHERE event_id > coalesce((SELECT max(event_id) FROM events WHERE {_KNOWN}), -1)
"""

ORACLES["new_until_known_by_subject"] = f"""
WITH cut AS (SELECT user_id, max(event_id) AS c FROM events WHERE {_KNOWN} GROUP BY user_id)
SELECT CAST(event_id AS VARCHAR) AS activity_id, e.user_id, event_id AS recency
FROM events e LEFT JOIN cut ON e.user_id = cut.user_id
WHERE c IS NULL OR event_id > c
"""

ORACLES["activity_runs"] = f"""
WITH fresh AS (
  SELECT CAST(event_id AS VARCHAR) AS natural_key FROM events
  WHERE event_type IN ('signup', 'click')
    AND event_id > coalesce((SELECT max(event_id) FROM events WHERE {_KNOWN}), -1)
)
SELECT natural_key, (row_number() OVER (ORDER BY natural_key) - 1) // 20 AS batch_no FROM fresh
"""

ORACLES["activity_runs_by_subject"] = f"""
WITH cut AS (SELECT user_id, max(event_id) AS c FROM events WHERE {_KNOWN} GROUP BY user_id)
SELECT e.user_id AS subject_id, CAST(event_id AS VARCHAR) AS natural_key
FROM events e LEFT JOIN cut ON e.user_id = cut.user_id
WHERE (c IS NULL OR event_id > c) AND event_type IN ('signup', 'click')
"""


_DAY_COUNTS = "SELECT count(*) AS num_rows, count(DISTINCT subject_id) AS num_subjects FROM ud"
_KEYED_COUNTS = "SELECT name AS collector_name, count(*) AS num_rows, count(DISTINCT user_id) AS num_subjects FROM events, (VALUES ('ACTIVITIES'), ('ACTIVITY_DETAILS')) t(name) GROUP BY name"

ORACLES["full_run"] = f"""
WITH {_DAYS}, {_REG}
SELECT collector_name, d.* FROM reg, ({_DAY_COUNTS}) d UNION ALL {_KEYED_COUNTS}
"""
ORACLES["mixed_writers"] = f"""
WITH {_DAYS}, {_REG}
SELECT collector_name, d.* FROM reg, ({_DAY_COUNTS}) d WHERE collector_name IN ('SLEEP', 'STEPS', 'HRV', 'FLOORS', 'WEIGH_INS')
UNION ALL {_KEYED_COUNTS}
"""

# Empty lists are no rows, so a range payload that comes twice stages its days once.
ORACLES["staged_counts"] = f"""
WITH {_DAYS}, {_REG}
SELECT CAST(1 AS INTEGER) AS run, collector_name, (SELECT count(*) FROM ud) AS rows_staged FROM reg
UNION ALL SELECT 1, 'ACTIVITIES', count(*) FROM events
UNION ALL SELECT 1, 'ACTIVITY_DETAILS', count(*) FILTER (event_type <> 'click') FROM events
UNION ALL SELECT 2, collector_name, (SELECT count(*) FROM ud) FROM reg WHERE collector_name IN ('SLEEP', 'STEPS')
UNION ALL SELECT 2, 'ACTIVITIES', 0
UNION ALL SELECT 3, collector_name, 0 FROM reg WHERE collector_name IN ('HRV', 'STEPS')
"""

ORACLES["retired_snapshot"] = """
WITH landed AS (
  SELECT user_id AS subject_id, event_type AS natural_key, value, event_id AS row_seq,
         CASE event_id % 4 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 5 END AS batch_seq,
         event_id % 4 < 2 OR event_id % 4 = 2 AND event_id % 3 = 0 AS landed_again
  FROM events
)
SELECT subject_id, natural_key, arg_max(value, (batch_seq, landed_again, row_seq)) AS value,
       CAST(max(batch_seq) AS BIGINT) AS batch_seq, arg_max(row_seq, (batch_seq, landed_again, row_seq)) AS row_seq
FROM landed GROUP BY subject_id, natural_key
"""

ORACLES["bucket_upsert"] = ORACLES["upsert_latest"]

ORACLES["change_feed"] = """
WITH part AS (
  SELECT user_id AS subject_id, event_type AS natural_key, event_id,
         CASE WHEN ts < TIMESTAMP '2024-01-08' THEN 1 WHEN ts < TIMESTAMP '2024-01-24' THEN 2 ELSE 3 END AS n
  FROM events
), latest AS (
  SELECT subject_id, natural_key, n, max(event_id) AS event_id, min(n) OVER (PARTITION BY subject_id, natural_key) AS first_n
  FROM part GROUP BY subject_id, natural_key, n
)
SELECT CASE n WHEN 2 THEN 'between' ELSE 'since' END AS span, subject_id, natural_key,
       CASE WHEN first_n < n THEN 'replaced' ELSE 'inserted' END AS change, event_id
FROM latest WHERE n > 1
"""

ORACLES["pending_details"] = """
WITH cut AS (SELECT user_id, max(event_id) AS c FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-28' GROUP BY user_id)
SELECT e.user_id AS subject_id, CAST(event_id AS VARCHAR) AS natural_key
FROM events e LEFT JOIN cut ON e.user_id = cut.user_id
WHERE (c IS NULL OR event_id > c) AND event_type IN ('signup', 'click')
"""

ORACLES["new_until_short_page"] = f"""
WITH paged AS (
  SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1) // 10 AS page FROM events
), shown AS (SELECT * FROM paged WHERE event_id % 97 <> 0 AND (user_id + page) % 9 <> 8),
sizes AS (
  SELECT u.user_id, p.page, count(s.event_id) AS n
  FROM (SELECT user_id, max(page) AS pages FROM paged GROUP BY user_id) u
  JOIN (SELECT unnest(range(0, 1 + (SELECT max(page) + 1 FROM paged))) AS page) p ON p.page <= u.pages + 1
  LEFT JOIN shown s ON s.user_id = u.user_id AND s.page = p.page GROUP BY ALL
), stop AS (SELECT user_id, min(page) AS last_page FROM sizes WHERE n < 10 GROUP BY user_id),
cut AS (SELECT user_id, max(event_id) AS c FROM shown WHERE {_KNOWN} AND event_id % 4 = 0 GROUP BY user_id)
SELECT CAST(event_id AS VARCHAR) AS activity_id, s.user_id, event_id AS recency, s.page
FROM shown s JOIN stop USING (user_id) LEFT JOIN cut ON cut.user_id = s.user_id
WHERE s.page <= last_page AND (c IS NULL OR event_id > c)
"""

ORACLES["stream_dedupe"] = """
SELECT user_id AS subject_id, event_type AS natural_key, count(*) AS rows_landed, max(event_id) AS last_event FROM events GROUP BY user_id, event_type
"""

# Odd ids landed in the later batch.
ORACLES["quarantine_redrive"] = """
WITH good AS (SELECT * FROM events WHERE event_type <> 'error' OR event_id % 5 <> 0)
SELECT 'current' AS part, user_id AS subject_id, arg_max(event_type, (event_id % 2, event_id)) AS natural_key,
       arg_max(value, (event_id % 2, event_id)) AS value, arg_max(event_id, (event_id % 2, event_id)) AS event_id
FROM good GROUP BY user_id
UNION ALL
SELECT 'broken', user_id, event_type, NULL, event_id FROM events WHERE event_type = 'error' AND event_id % 5 = 0
"""

# Which fields the payload recipes fill, and as what, beside what staging reads.
ORACLES["payload_drift"] = """
WITH found(collector_name, path, finding, expected, found, seen) AS (
  VALUES ('ACTIVITIES', '$.deviceId', 'changed', 'string', 'number', (SELECT count(*) FROM orders)),
         ('ACTIVITIES', '$.maxHR', 'changed', 'number', 'string', (SELECT count(*) FROM orders)),
         ('SLEEP', '$.dailySleepDTO.sleepWindowConfirmed', 'changed', 'boolean', 'string', (SELECT count(*) FROM events)),
         ('BODY_BATTERY', '$.date', 'unknown', NULL, 'string', (SELECT count(*) FROM events)),
         ('STEPS', '$.calendarDate', 'unknown', NULL, 'string', (SELECT count(*) FROM events)),
         ('STEPS', '$.pushes', 'unknown', NULL, 'object', (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20')),
         ('STEPS', '$.totalSteps', 'changed', 'number',
          CASE WHEN (SELECT min(ts) FROM events) < TIMESTAMP '2024-01-20' THEN 'mixed' ELSE 'string' END,
          (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20')),
         ('BODY_BATTERY_EVENTS', '$[*]', 'unknown', NULL, 'object', (SELECT count(*) FROM events)),
         ('TRAINING_READINESS', '$[*].event_id', 'unknown', NULL, 'number', (SELECT count(*) FROM events))
)
SELECT collector_name, path, finding, expected, found FROM found WHERE seen > 0
"""

ORACLES["import_models_join"] = """
SELECT c_nationkey, count(*) AS num_orders, min(o_orderkey) AS first_order
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
"""

# January: the zones are 8 hours behind and 5:30 ahead of UTC.
ORACLES["today_in_zone"] = """
SELECT event_id, CAST(ts - INTERVAL 8 HOUR AS DATE) AS los_angeles,
       CAST(ts + INTERVAL 330 MINUTE AS DATE) AS kolkata, CAST(ts AS DATE) AS utc
FROM events
"""

_STATE_CASES = "WHEN 'click' THEN 'STEPS' WHEN 'view' THEN 'SLEEP' WHEN 'signup' THEN 'HRV' WHEN 'error' THEN 'BODY_BATTERY'"
_STATE = f"""{_EV}, {_REG}, subjects AS (SELECT DISTINCT user_id AS subject_id FROM ev), state AS (
  SELECT user_id AS subject_id, CASE event_type {_STATE_CASES} END AS collector_name,
         max(day) AS last_extracted_date, {_ms('max(ms)')} AS updated_at
  FROM ev WHERE event_type <> 'purchase' GROUP BY user_id, event_type
), windows AS (
  SELECT s.subject_id, r.collector_name, r.source_method, r.kind,
         CAST(coalesce(st.last_extracted_date - 3, DATE '{TODAY}' - 30) AS DATE) AS start_date,
         DATE '{TODAY}' AS end_date
  FROM subjects s CROSS JOIN reg r
  LEFT JOIN state st ON st.subject_id = s.subject_id AND st.collector_name = r.collector_name
)"""

ORACLES["watermark_start"] = f"""
WITH {_STATE}
SELECT 'incremental' AS run, * FROM windows
UNION ALL
SELECT 'backfill', subject_id, collector_name, source_method, kind, DATE '2023-08-09', end_date
FROM windows WHERE collector_name IN ('STEPS', 'SLEEP')
"""

ORACLES["daily_fetch_plan"] = f"""
WITH {_STATE}
SELECT subject_id, collector_name, source_method,
       CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS requested
FROM windows WHERE kind = 'daily'
"""

ORACLES["range_fetch_plan"] = f"""
WITH {_STATE}, starts AS (
  SELECT subject_id, collector_name, source_method, end_date,
         CAST(unnest(generate_series(DATE '2023-08-09', end_date, INTERVAL 27 DAY)) AS DATE) AS chunk_start
  FROM windows WHERE kind = 'range'
)
SELECT subject_id, collector_name, source_method, chunk_start,
       CAST(least(chunk_start + 26, end_date) AS DATE) AS chunk_end
FROM starts
"""

ORACLES["chunk_date_ranges"] = """
WITH spans AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
  FROM orders GROUP BY o_custkey
), starts AS (
  SELECT o_custkey, hi, CAST(unnest(generate_series(lo, hi, INTERVAL 27 DAY)) AS DATE) AS chunk_start FROM spans
)
SELECT o_custkey, chunk_start, CAST(least(chunk_start + 26, hi) AS DATE) AS chunk_end FROM starts
"""

ORACLES["watermark_advance"] = f"""
WITH {_STATE}
SELECT * FROM state WHERE collector_name NOT IN ('STEPS', 'STATS')
UNION ALL
SELECT subject_id, collector_name, DATE '{TODAY}', TIMESTAMP '2024-02-01 10:00:00'
FROM windows WHERE collector_name IN ('STEPS', 'STATS')
"""

ORACLES["late_refetch_upsert"] = f"""
WITH {_EV}, early AS (
  SELECT user_id AS subject_id, day, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM ev
  WHERE event_type <> 'error' AND day < DATE '2024-01-13' GROUP BY user_id, day
), late AS (
  SELECT user_id AS subject_id, day, count(*) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM ev
  WHERE day BETWEEN DATE '2024-01-13' AND DATE '{TODAY}' GROUP BY user_id, day
)
SELECT subject_id, CAST(day AS VARCHAR) AS natural_key, n, sum_k, TIMESTAMP '2024-01-16 10:00:00' AS extracted_at FROM early
UNION ALL
SELECT subject_id, CAST(day AS VARCHAR), n, sum_k, TIMESTAMP '2024-02-01 10:00:00' FROM late
"""

ORACLES["collector_runs"] = f"""
WITH landed AS ({ORACLES["late_refetch_upsert"]}), {_REG}
SELECT collector_name, landed.*, source_method
FROM landed, reg WHERE collector_name IN ('SLEEP', 'HRV', 'STEPS')
"""

# Semi-structured projections

ORACLES["json_paths_typed"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS natural_key, 'Order ' || o_orderkey AS top_level, o_orderpriority AS nested,
       CASE WHEN o_orderstatus <> 'P' THEN 'Site ' || o_custkey END AS sometimes_missing,
       CAST(NULL AS VARCHAR) AS never_there,
       CAST(round(o_totalprice) AS BIGINT) AS rounded_number,
       CAST(round(o_orderkey / 2.0) AS BIGINT) AS rounded_text,
       o_totalprice AS number, o_orderstatus = 'F' AS flag,
       CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) AS moment
FROM orders
"""

ORACLES["array_first_snapshot"] = f"""
WITH {_SYNC}
SELECT a.subject_id, a.natural_key, a.event_type AS newest_level, CAST(round(a.value) AS BIGINT) AS newest_score,
       b.event_type AS sixth_level
FROM sync a LEFT JOIN sync b ON a.subject_id = b.subject_id AND a.day = b.day AND b.newest = 6
WHERE a.newest = 1
"""

ORACLES["nested_map_first"] = f"""
WITH {_DAYS}
SELECT subject_id, CAST(day AS VARCHAR) AS natural_key, CASE WHEN n > 1 THEN n + 40 END AS resting_heart_rate FROM ud
"""

ORACLES["array_size_daily"] = f"""
WITH {_SYNC}
SELECT subject_id, natural_key, n AS num_events, CAST(NULL AS BIGINT) AS size_of_object FROM sync WHERE newest = 1
"""

ORACLES["epoch_ms_ntz"] = f"""
WITH {_DAYS}
SELECT subject_id, CAST(day AS VARCHAR) AS natural_key, {_ms('first_ms')} AS started_at,
       CASE WHEN n > 1 THEN {_ms('last_ms')} END AS ended_at
FROM ud
"""

# Staging models

ORACLES["stg_activities"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS activity_id, CAST(o_custkey AS VARCHAR) AS device_id,
       'Order ' || o_orderkey AS activity_name, o_orderpriority AS activity_type, o_orderstatus AS event_type,
       CASE WHEN o_orderstatus <> 'P' THEN 'Site ' || o_custkey END AS location_name,
       o_totalprice AS distance_meters, o_totalprice / 10 AS duration_seconds,
       o_totalprice / 8 AS elapsed_duration_seconds,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice / 16 END AS moving_duration_seconds,
       CAST(round(o_totalprice) AS BIGINT) AS calories, 60 + o_orderkey % 100 AS average_heart_rate,
       CAST(round(o_orderkey / 2.0) AS BIGINT) AS max_heart_rate,
       o_totalprice / 1000 AS average_speed_mps, o_totalprice / 500 AS max_speed_mps,
       CAST(o_orderkey AS DOUBLE) * 0.5 AS elevation_gain_meters, CAST(o_orderkey AS DOUBLE) * -0.25 AS elevation_loss_meters,
       o_orderstatus = 'F' AS is_favorite, CAST(o_orderdate AS DATE) AS activity_date,
       CAST(o_orderdate AS TIMESTAMP) AS started_at, {_LANDED}, 'get_activities' AS source_method
FROM orders
"""

ORACLES["stg_activity_details"] = f"""
SELECT CAST(event_id // 100 AS VARCHAR) AS activity_id,
       CAST(CASE event_id // 100 % 3 WHEN 0 THEN 3 WHEN 1 THEN 7 ELSE 8 END AS BIGINT) AS measurement_count,
       count(*) AS metrics_count, count(*) + event_id // 100 % 3 AS total_metrics_count, count(*) AS num_samples,
       event_id // 100 % 3 = 0 AS has_pending_data, true AS is_details_available,
       {_LANDED}, 'get_activity_details' AS source_method
FROM events GROUP BY event_id // 100
"""

_DAY = "CAST(day AS VARCHAR)"

ORACLES["stg_body_battery"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS body_battery_id, CAST(round(sum_k / 2.0) AS BIGINT) AS charged_points,
       CAST(round(sum_k / -2.0) AS BIGINT) AS drained_points, day AS body_battery_date,
       {_ms('first_ms')} AS started_at, {_ms('last_ms')} AS ended_at, {_LANDED}, 'get_body_battery' AS source_method
FROM ud
"""

ORACLES["stg_body_battery_events"] = f"""
WITH {_SYNC}
SELECT subject_id, natural_key AS body_battery_event_id, n AS num_events, day AS body_battery_event_date,
       {_LANDED}, 'get_body_battery_events' AS source_method
FROM sync WHERE newest = 1
"""

ORACLES["stg_hrv"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS hrv_id, CASE WHEN n > 2 THEN 'BALANCED' ELSE 'LOW' END AS hrv_status,
       n + 20 AS last_night_avg_hrv, CASE WHEN n > 1 THEN sum_k END AS weekly_avg_hrv,
       CAST(round(max_value) AS BIGINT) AS last_night_5min_high_hrv, day AS hrv_date,
       {_ms('first_ms')} AS started_at, {_ms('last_ms')} AS ended_at, {_LANDED}, 'get_hrv_data' AS source_method
FROM ud
"""

ORACLES["stg_resting_heart_rate"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS resting_heart_rate_id, CASE WHEN n > 1 THEN n + 40 END AS resting_heart_rate,
       day AS resting_heart_rate_date, {_LANDED}, 'get_rhr_day' AS source_method
FROM ud
"""

ORACLES["stg_sleep"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS sleep_id, CAST(round((last_ms - first_ms) / 1000.0) AS BIGINT) AS sleep_time_seconds,
       n * 60 AS deep_sleep_seconds, CASE WHEN n_purchase > 0 THEN n_purchase * 90 END AS light_sleep_seconds,
       sum_k AS rem_sleep_seconds, CAST(round(min_value) AS BIGINT) AS awake_sleep_seconds,
       CAST(0 AS BIGINT) AS nap_time_seconds, n > 2 AS is_retro, n > 1 AS is_sleep_window_confirmed, day AS sleep_date,
       {_ms('first_ms')} AS sleep_started_at, CASE WHEN n > 1 THEN {_ms('last_ms')} END AS sleep_ended_at,
       {_LANDED}, 'get_sleep_data' AS source_method
FROM ud
"""

ORACLES["stg_steps"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS steps_id, n + 1 AS step_goal, CAST(sum_k AS DOUBLE) * 1.25 AS total_distance_meters,
       sum_k AS total_steps, day AS steps_date, {_LANDED}, 'get_daily_steps' AS source_method
FROM ud
"""

ORACLES["stg_steps_current"] = f"""
WITH {_DAYS}
SELECT subject_id, {_DAY} AS steps_id, CASE WHEN day < DATE '2024-01-13' THEN 1 ELSE n + 1 END AS step_goal,
       CASE WHEN day >= DATE '2024-01-13' THEN CAST(sum_k AS DOUBLE) * 1.25 END AS total_distance_meters,
       CASE WHEN day < DATE '2024-01-13' THEN 1 ELSE sum_k END AS total_steps, day AS steps_date,
       CASE WHEN day < DATE '2024-01-13' THEN TIMESTAMP '2024-01-16 10:00:00' ELSE TIMESTAMP '2024-02-01 10:00:00' END AS extracted_at,
       'get_daily_steps' AS source_method
FROM ud
"""

ORACLES["stg_training_readiness"] = f"""
WITH {_SYNC}
SELECT subject_id, natural_key AS training_readiness_id, event_type AS readiness_level,
       CASE WHEN k >= 10 THEN 'short ' || k END AS feedback_short, 'long ' || k AS feedback_long,
       CAST(round(value) AS BIGINT) AS readiness_score, k * 3 AS acute_load,
       CAST(round(k / 2.0) AS BIGINT) AS recovery_time_minutes, CASE WHEN k < 90 THEN k END AS sleep_score,
       k + 1 AS hrv_weekly_average, n AS num_readiness_snapshots, k > 50 AS is_valid_sleep,
       day AS training_readiness_date, {_ms('ms')} AS recorded_at, {_LANDED}, 'get_training_readiness' AS source_method
FROM sync WHERE newest = 1
"""

# Sample time series

_SAMPLES = f"""{_EV}, smp AS (
  SELECT CAST(event_id // 100 AS VARCHAR) AS activity_id, event_id // 100 % 3 AS layout,
         CAST(row_number() OVER w - 1 AS INTEGER) AS sample_index,
         CAST(ms AS DOUBLE) AS ms, CAST(k AS DOUBLE) AS k,
         CASE WHEN event_type <> 'error' THEN value END AS hr,
         CAST(ms - first_value(ms) OVER w AS DOUBLE) / 1000 AS elapsed,
         CAST(event_id % 100 AS DOUBLE) * 12.5 AS distance
  FROM ev WINDOW w AS (PARTITION BY event_id // 100 ORDER BY event_id)
)"""

_LAYOUTS = {
    0: [("directHeartRate", "bpm", "hr"), ("directTimestamp", "gmt", "ms"), ("sumElapsedDuration", "second", "elapsed")],
    1: [
        ("directTimestamp", "gmt", "ms"),
        ("directLatitude", "dd", "k - 50"),
        ("directHeartRate", "bpm", "hr"),
        ("sumElapsedDuration", "second", "elapsed"),
        ("directLongitude", "dd", "k * 1.5"),
        ("directSpeed", "mps", "hr / 10"),
        ("sumDistance", "meter", "distance"),
    ],
    2: [
        ("sumElapsedDuration", "second", "elapsed"),
        ("directLatitude", "dd", "k - 50"),
        ("directElevation", "meter", "k * 2"),
        ("directTimestamp", "gmt", "ms"),
        ("directHeartRate", "bpm", "hr"),
        ("directVerticalSpeed", "mps", "k / 4"),
        ("sumMovingDuration", "second", "elapsed"),
        ("directBodyBattery", "dimensionless", "NULL"),
    ],
}
_LONG_PARTS = "\n  UNION ALL\n".join(
    f"  SELECT activity_id, sample_index, '{key}' AS metric_key, '{unit}' AS metric_unit, CAST({value} AS DOUBLE) AS metric_value"
    f" FROM smp WHERE layout = {layout}"
    for layout, metrics in _LAYOUTS.items()
    for key, unit, value in metrics
)
_LONG = f"""{_SAMPLES}, long AS (
  SELECT md5(activity_id || '-' || sample_index || '-' || metric_key) AS sk, * FROM (
{_LONG_PARTS}
  )
)"""

_DESCRIPTOR_VALUES = ", ".join(
    f"({layout}, {99 if key == 'directBodyBattery' else i}, '{key}', '{unit}')"
    for layout, metrics in _LAYOUTS.items()
    for i, (key, unit, _) in enumerate(metrics)
)

ORACLES["explode_descriptors"] = f"""
WITH acts AS (SELECT DISTINCT event_id // 100 AS block FROM events),
     declared(layout, metrics_index, metric_key, metric_unit) AS (VALUES {_DESCRIPTOR_VALUES})
SELECT CAST(block AS VARCHAR) AS activity_id, metrics_index, metric_key, metric_unit
FROM acts JOIN declared ON block % 3 = layout
"""

ORACLES["subtree_passthrough"] = f"""
WITH {_SAMPLES}, declared(layout, metrics_index, metric_key, metric_unit) AS (VALUES {_DESCRIPTOR_VALUES}),
texts AS (
  SELECT layout, '[' || string_agg('{{"key":"' || metric_key || '","metricsIndex":' || metrics_index || ',"unit":{{"key":"' || metric_unit || '"}}}}', ',' ORDER BY metrics_index) || ']' AS t
  FROM declared GROUP BY layout
)
SELECT activity_id, any_value(t) AS metric_descriptors,
       max(CASE WHEN sample_index = 0 THEN CASE layout WHEN 0 THEN hr WHEN 1 THEN ms ELSE elapsed END END) AS first_value,
       count(*) AS num_samples
FROM smp JOIN texts USING (layout) GROUP BY activity_id
"""

ORACLES["explode_samples"] = f"""
WITH {_SAMPLES}
SELECT activity_id, sample_index, CASE layout WHEN 0 THEN 3 ELSE 7 END AS num_metrics,
       CASE layout WHEN 0 THEN hr WHEN 1 THEN ms ELSE elapsed END AS first_metric
FROM smp
"""

ORACLES["samples_unpivoted"] = ORACLES["samples_unpivoted_join"] = f"WITH {_LONG} SELECT * FROM long"

ORACLES["surrogate_key"] = """
SELECT o_orderkey,
       md5(o_orderkey || '-' || CASE WHEN o_orderstatus = 'P' THEN '_dbt_utils_surrogate_key_null_' ELSE o_orderstatus END
           || '-' || o_orderpriority) AS sk
FROM orders
"""

_SAMPLE_SK = "md5(activity_id || '-' || sample_index) AS sk"
_RECORDED = _ms("CAST(ms AS BIGINT)") + " AS recorded_at"

ORACLES["cardio_pivot"] = ORACLES["cardio_pivot_long"] = f"""
WITH {_SAMPLES}
SELECT {_SAMPLE_SK}, activity_id, sample_index, elapsed AS elapsed_seconds,
       CASE WHEN layout = 2 THEN elapsed END AS moving_seconds,
       CASE WHEN layout = 1 THEN distance END AS distance_meters,
       hr AS heart_rate_bpm, CAST(NULL AS DOUBLE) AS body_battery, {_RECORDED}
FROM smp
"""

ORACLES["gps_capable"] = """
SELECT DISTINCT CAST(event_id // 100 AS VARCHAR) AS activity_id FROM events WHERE event_id // 100 % 3 <> 0
"""

ORACLES["gps_semi_join"] = f"""
WITH {_LONG}
SELECT * FROM long WHERE CAST(activity_id AS BIGINT) % 3 <> 0 AND metric_key IN
  ('directTimestamp', 'directLatitude', 'directLongitude', 'directElevation', 'directSpeed', 'directVerticalSpeed')
"""

ORACLES["cardio_refreshed"] = ORACLES["cardio_pivot"]

ORACLES["gps_pivot"] = ORACLES["gps_pivot_long"] = f"""
WITH {_SAMPLES}
SELECT {_SAMPLE_SK}, activity_id, sample_index, k - 50 AS latitude,
       CASE WHEN layout = 1 THEN k * 1.5 END AS longitude, CASE WHEN layout = 2 THEN k * 2 END AS elevation_meters,
       CASE WHEN layout = 1 THEN hr / 10 END AS speed_mps, CASE WHEN layout = 2 THEN k / 4 END AS vertical_speed_mps,
       {_RECORDED}
FROM smp WHERE layout <> 0
"""

ORACLES["hr_by_minute"] = f"""
WITH {_SAMPLES}
SELECT activity_id, CAST(floor(elapsed / 60) AS BIGINT) AS minute, count(*) AS num_samples,
       CAST(sum(CAST(hr AS DECIMAL(18, 4))) AS DOUBLE) / count(*) AS avg_heart_rate, max(hr) AS max_heart_rate
FROM smp WHERE hr IS NOT NULL GROUP BY 1, 2
"""

# Calendar

_SPINE = """spine AS (
  SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE) + 364, INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders
)"""

ORACLES["date_spine"] = f"WITH {_SPINE} SELECT d AS date_day FROM spine"

_DAY_COLUMNS = """d AS date_day, CAST(d - 1 AS DATE) AS prior_date_day, CAST(d + 1 AS DATE) AS next_date_day,
       CAST(d - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day, CAST(d - 364 AS DATE) AS prior_year_over_year_date_day,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(isodow(d) AS INTEGER) AS day_of_week_iso,
       strftime(d, '%A') AS day_of_week_name, strftime(d, '%a') AS day_of_week_name_short,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
       CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS week_start_date,
       CAST(d - CAST(dayofweek(d) AS INTEGER) + 6 AS DATE) AS week_end_date, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(month(d) AS INTEGER) AS month_of_year, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
       CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
       CAST(quarter(d) AS INTEGER) AS quarter_of_year, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
       CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
       CAST(year(d) AS INTEGER) AS year_number, CAST(date_trunc('year', d) AS DATE) AS year_start_date,
       make_date(year(d), 12, 31) AS year_end_date"""

ORACLES["dim_dates"] = f"""
WITH {_SPINE}
SELECT {_DAY_COLUMNS},
       isodow(d) >= 6 AS is_weekend, d = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) AS is_current_date,
       day(d) = 1 AS is_first_day_of_month, d = last_day(d) AS is_last_day_of_month
FROM spine
"""

ORACLES["dates_spine_full"] = f"""
WITH {_SPINE}, days AS (SELECT d, CAST(d - 364 AS DATE) AS p, CAST(d - INTERVAL 1 YEAR AS DATE) AS y FROM spine)
SELECT {_DAY_COLUMNS},
       CAST(p - CAST(dayofweek(p) AS INTEGER) AS DATE) AS prior_year_week_start_date,
       CAST(p - CAST(dayofweek(p) AS INTEGER) + 6 AS DATE) AS prior_year_week_end_date,
       CAST(d - CAST(isodow(d) AS INTEGER) + 1 AS DATE) AS iso_week_start_date,
       CAST(d - CAST(isodow(d) AS INTEGER) + 7 AS DATE) AS iso_week_end_date,
       CAST(p - CAST(isodow(p) AS INTEGER) + 1 AS DATE) AS prior_year_iso_week_start_date,
       CAST(p - CAST(isodow(p) AS INTEGER) + 7 AS DATE) AS prior_year_iso_week_end_date,
       CAST(weekofyear(d) AS INTEGER) AS iso_week_of_year, CAST(weekofyear(p) AS INTEGER) AS prior_year_week_of_year,
       CAST(weekofyear(p) AS INTEGER) AS prior_year_iso_week_of_year,
       CAST(date_trunc('month', y) AS DATE) AS prior_year_month_start_date, last_day(y) AS prior_year_month_end_date
FROM days
"""

ORACLES["calendar_gap_days"] = f"""
WITH {_EV}, expected AS (
  SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS d FROM ev GROUP BY user_id
)
SELECT user_id, d AS date_day, strftime(d, '%a') AS day_of_week_name_short,
       CAST(d - CAST(dayofweek(d) AS INTEGER) AS DATE) AS week_start_date, isodow(d) >= 6 AS is_weekend
FROM expected WHERE (user_id, d) NOT IN (SELECT user_id, day FROM ev)
"""

_ISLANDS = """numbered AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM (SELECT DISTINCT user_id, day FROM ev)),
islands AS (SELECT user_id, min(day) AS start_date, max(day) AS end_date, count(*) AS num_days FROM numbered GROUP BY user_id, run)"""

ORACLES["coverage_islands"] = f"""
WITH {_EV}, {_ISLANDS}
SELECT user_id, start_date, end_date, num_days,
       CAST(lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) - end_date - 1 AS INTEGER) AS gap_days
FROM islands
"""

ORACLES["open_intervals"] = f"""
WITH {_EV}, bounds AS (SELECT min(day) AS lo, max(day) AS hi FROM ev),
asked AS (
  SELECT user_id, name, CAST(d AS DATE) AS day
  FROM (SELECT DISTINCT user_id FROM ev), (VALUES ('STEPS'), ('SLEEP')) t(name),
       (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds)
), left_over AS (
  SELECT user_id, name, day FROM asked
  EXCEPT SELECT user_id, CASE WHEN event_type = 'error' THEN 'STEPS' ELSE 'SLEEP' END, day FROM ev
), runs AS (
  SELECT *, day - CAST(row_number() OVER (PARTITION BY user_id, name ORDER BY day) AS INTEGER) AS run FROM left_over
), spans AS (SELECT user_id, name, min(day) AS lo, max(day) AS hi FROM runs GROUP BY user_id, name, run),
starts AS (SELECT *, CAST(unnest(generate_series(lo, hi, INTERVAL 27 DAY)) AS DATE) AS chunk_start FROM spans)
SELECT user_id AS subject_id, name AS collector_name, chunk_start, CAST(least(chunk_start + 26, hi) AS DATE) AS chunk_end FROM starts
"""

# Data tests

ORACLES["test_unique_failures"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
"""

ORACLES["test_not_null_failures"] = f"WITH {_LONG} SELECT * FROM long WHERE metric_value IS NULL"

_MODEL_ROWS = {
    ("stg_activities", "activity_id"): "SELECT count(*) FROM orders",
    ("stg_activity_details", "activity_id"): "SELECT count(DISTINCT event_id // 100) FROM events",
    ("stg_body_battery", "subject_id,body_battery_id"): "SELECT count(*) FROM ud",
    ("stg_hrv", "subject_id,hrv_id"): "SELECT count(*) FROM ud",
    ("stg_resting_heart_rate", "subject_id,resting_heart_rate_id"): "SELECT count(*) FROM ud",
    ("stg_sleep", "subject_id,sleep_id"): "SELECT count(*) FROM ud",
    ("stg_steps", "subject_id,steps_id"): "SELECT count(*) FROM ud",
    ("stg_body_battery_events", "subject_id,body_battery_event_id"): "SELECT count(*) FROM sync WHERE newest = 1",
    ("stg_training_readiness", "subject_id,training_readiness_id"): "SELECT count(*) FROM sync WHERE newest = 1",
    ("int_activity_samples_unpivoted", "sk"): "SELECT count(*) FROM long",
    ("int_activities_cardio_samples_pivoted", "sk"): "SELECT count(*) FROM events",
    ("int_activities_gps_samples_pivoted", "sk"): "SELECT count(*) FROM smp WHERE layout <> 0",
    ("int_dates_spine", "date_day"): "SELECT count(*) FROM spine",
    ("dim_dates", "date_day"): "SELECT count(*) FROM spine",
    ("lineitem", "l_orderkey,l_linenumber"): "SELECT count(*) FROM lineitem",
}
_REPEATED = "(SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))"
_REPORT = " UNION ALL ".join(
    f"SELECT '{model}' AS model, '{key}' AS key_columns, '{test}' AS test, ({rows}) AS num_rows, "
    + (_REPEATED if (model, test) == ("lineitem", "unique") else "CAST(0 AS BIGINT)")
    + " AS failures"
    for (model, key), rows in _MODEL_ROWS.items()
    for test in ("unique", "not_null")
)
ORACLES["data_test_report"] = f"WITH {_LONG}, {_UD}, {_SYNCED}, {_SPINE} {_REPORT}"

ORACLES["steps_by_weekday"] = f"""
WITH {_DAYS}
SELECT strftime(day, '%B') AS month_name, strftime(day, '%A') AS day_of_week_name, isodow(day) >= 6 AS is_weekend,
       count(*) AS num_days, CAST(sum(sum_k) AS BIGINT) AS total_steps, max(n) + 1 AS top_goal
FROM ud GROUP BY 1, 2, 3
"""
