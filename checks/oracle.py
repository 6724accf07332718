"""The same answers in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

# The derived table, flat.
FEED = """
f AS (
  SELECT
    event_id AS seq,
    CASE WHEN event_id % 101 = 0 THEN NULL
         WHEN event_id % 14 = 0 THEN concat('e', event_id // 2)
         WHEN event_id % 3 = 1 THEN concat('e', event_id - 1)
         ELSE concat('e', event_id) END AS id,
    CASE WHEN event_id % 103 = 0 THEN '' ELSE concat('s', user_id) END AS session_id,
    concat('u', user_id) AS username,
    (['iPhone 15', 'Pixel 8', ' Samsung S23 ', 'iPad', 'MacBook Pro', 'Windows Laptop',
      'old mac mini', NULL])[1 + event_id % 8] AS device,
    (['iOS', 'Android', 'macOS', 'Windows', 'Linux'])[1 + event_id % 5] AS os,
    (['Alberta', 'British Columbia', 'Manitoba', 'New Brunswick', 'Newfoundland and Labrador',
      'Nova Scotia', 'Ontario', 'Prince Edward Island', 'Quebec', 'Saskatchewan',
      ' Ontario ', 'quebec', NULL])[1 + event_id % 13] AS geo,
    CASE WHEN event_id % 107 = 0 THEN NULL
         WHEN event_id % 17 = 0 THEN 'other_thing'
         WHEN event_type = 'click' THEN ' Clicks '
         WHEN event_type = 'view' THEN 'PageView'
         WHEN event_type = 'signup' THEN 'signups'
         WHEN event_type = 'purchase' THEN 'delete_account'
         WHEN event_type = 'error' THEN 'log_in'
         ELSE event_type END AS event_type,
    CASE WHEN event_id % 127 = 0 THEN NULL
         WHEN event_id % 113 = 0 THEN 'WEB'
         WHEN event_id % 109 = 0 THEN 'tv'
         WHEN event_id % 2 = 0 THEN 'web'
         ELSE 'mobile' END AS platform,
    CASE WHEN event_id % 131 = 0 THEN 'not-a-ts'
         WHEN event_id % 137 = 0 THEN '2024-03-01T00:00:00.000Z'
         WHEN event_id % 179 = 0 THEN strftime(ts, '%Y%m%dT%H%M%S.%gZ')
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS event_timestamp,
    CASE WHEN event_id % 139 = 0 THEN 'bad-date'
         WHEN event_id % 149 = 0 THEN NULL
         WHEN event_id % 151 = 0 THEN strftime(ts - INTERVAL 10 DAYS, '%Y-%m-%d')
         WHEN event_id % 181 = 0 THEN strftime(ts, '%G-W%V-%u')
         WHEN event_id % 197 = 0 THEN strftime(ts, '%Y%m%d')
         ELSE strftime(ts, '%Y-%m-%d') END AS dt,
    CASE WHEN event_id % 2 = 0 THEN concat('https://example.com/', event_id % 8) END AS url,
    CASE WHEN event_id % 2 = 0 THEN concat('Chrome/', 90 + event_id % 40, '.0') END AS browser_version,
    CASE WHEN event_id % 2 = 1 THEN 'Home' END AS screen,
    CASE WHEN event_id % 2 = 1 THEN '1080x2400' END AS screen_size,
    CASE WHEN event_id % 2 = 1 THEN concat(1 + event_id % 5, '.', event_id % 21, '.0') END AS app_version,
    CASE WHEN event_id % 157 <> 0 THEN concat('b', event_id % 5) END AS landed_batch,
    coalesce(landed_batch, 'unknown') AS batch_id,
    CASE WHEN event_id % 163 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS landed_dt,
    coalesce(landed_dt, '2024-01-31') AS envelope_dt,
    ts AS landed_ts
  FROM events
)"""

# Verdicts.
CHECKED = """
typed AS (
  SELECT *,
    coalesce(try_strptime(event_timestamp, '%Y%m%dT%H%M%S.%gZ'),
      TRY_CAST(replace(replace(event_timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP)) AS parsed_ts,
    CASE WHEN dt LIKE '%W%' OR regexp_matches(dt, '^[0-9]{8}$') THEN CAST(landed_ts AS DATE)
         ELSE TRY_CAST(coalesce(dt, envelope_dt) AS DATE) END AS parsed_date
  FROM f
),
schema_checked AS (
  SELECT *,
    CASE WHEN seq % 167 = 0 THEN 'unexpected_normalize_error'
         WHEN coalesce(id, '') = '' THEN 'missing_id'
         WHEN coalesce(session_id, '') = '' THEN 'missing_session_id'
         WHEN coalesce(event_type, '') = '' THEN 'missing_event_type'
         WHEN coalesce(platform, '') = '' THEN 'missing_platform'
         WHEN parsed_ts IS NULL THEN 'invalid_event_timestamp'
         WHEN parsed_date IS NULL THEN 'invalid_dt'
         WHEN seq % 173 = 0 THEN 'unexpected_normalize_error' END AS schema_reason
  FROM typed
),
checked AS (
  SELECT *,
    CASE WHEN schema_reason IS NOT NULL THEN NULL
         WHEN platform NOT IN ('web', 'mobile') THEN 'invalid_platform'
         WHEN parsed_ts > TIMESTAMP '2024-01-31 00:05:00' THEN 'event_ts_in_future' END AS rule_reason
  FROM schema_checked
),
bad AS (
  SELECT *, CASE WHEN schema_reason IS NULL THEN 'dq' ELSE 'schema' END AS dq_stage,
    coalesce(schema_reason, rule_reason) AS dq_reason
  FROM checked WHERE coalesce(schema_reason, rule_reason) IS NOT NULL
)"""

RAW_COLUMNS = """id AS event_id, session_id, username, event_type, platform,
    parsed_ts AS event_ts, parsed_date AS event_date, batch_id,
    TIMESTAMP '2024-01-31 00:00:00' AS ingested_at, device, os, geo AS country,
    url, browser_version, screen, screen_size, app_version"""

GOOD = f"""
good AS (
  SELECT seq, {RAW_COLUMNS.replace("parsed_date AS", "CAST(envelope_dt AS DATE) AS")}
  FROM checked WHERE schema_reason IS NULL AND rule_reason IS NULL
)"""

MARK = "TIMESTAMP '2024-01-15 00:00:00'"

# Keep-latest order: time, ingest time, batch, then the remaining columns by name.
_REST = (
    "app_version browser_version country device event_date event_type os platform "
    "screen screen_size session_id url username"
).split()
_REST_WITH_SEQ = sorted([*_REST, "seq"])


_REST_NARROW = [c for c in _REST if c not in ("country", "device", "event_type")]


def latest(table: str, rest=_REST, first=("event_ts", "ingested_at", "batch_id")) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [*first, *rest])
    return (
        f"SELECT * FROM {table} "
        f"QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {order}) = 1"
    )


def ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


TEXT = f"""REPLACE ({ts_text('event_ts')} AS event_ts, strftime(event_date, '%Y-%m-%d') AS event_date,
    {ts_text('ingested_at')} AS ingested_at)"""

NORMALIZED = """REPLACE (lower(trim(platform)) AS platform, lower(trim(event_type)) AS event_type,
    trim(device) AS device, trim(country) AS country)"""

FAMILY = r"""CASE WHEN regexp_matches(device, 'iphone|ipad', 'i') THEN 'apple_mobile'
         WHEN regexp_matches(device, 'pixel|samsung|android', 'i') THEN 'android_mobile'
         WHEN regexp_matches(device, 'macbook|\bmac\b', 'i') THEN 'apple_desktop'
         WHEN regexp_matches(device, 'windows', 'i') THEN 'windows_desktop'
         ELSE 'other' END"""

REGION = """CASE WHEN country IN ('Nova Scotia', 'New Brunswick', 'Prince Edward Island',
                          'Newfoundland and Labrador') THEN 'atlantic'
         WHEN country IN ('Alberta', 'Saskatchewan', 'Manitoba') THEN 'prairies'
         WHEN country = 'Ontario' THEN 'ontario'
         WHEN country = 'Quebec' THEN 'quebec'
         WHEN country = 'British Columbia' THEN 'bc'
         ELSE 'unknown' END"""

CATEGORY = """CASE WHEN event_type IN ('pageview', 'clicks', 'referral') THEN 'engagement'
         WHEN event_type IN ('log_in', 'log_off', 'signups') THEN 'account'
         WHEN event_type = 'delete_account' THEN 'churn_signal'
         ELSE 'other' END"""

HOUR = "CAST(extract(hour FROM event_ts) AS INTEGER)"


def silver(name: str, table: str) -> str:
    """CTEs that end in ``name``: ``table`` (deduplicated) with normalized strings and features."""
    return f"""{name}_n AS (SELECT * {NORMALIZED} FROM {table}),
{name} AS (
  SELECT * EXCLUDE (seq), {HOUR} AS event_hour, {FAMILY} AS device_family,
    {REGION} AS geo_region, {CATEGORY} AS event_category
  FROM {name}_n
)"""


def query(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([FEED, CHECKED, GOOD, *ctes]) + "\n" + body


LATEST = f"latest AS ({latest('good')})"
FEATURES = [silver("featured", "good")]
SILVER = [LATEST, silver("silver", "latest")]

SUMMARY_BODY = """
  SELECT batch_id, envelope_dt AS event_date,
    count(*) AS received,
    count(*) FILTER (WHERE schema_reason IS NULL AND rule_reason IS NULL) AS good,
    count(*) FILTER (WHERE schema_reason IS NOT NULL) AS bad_schema,
    count(*) FILTER (WHERE rule_reason IS NOT NULL) AS bad_dq,
    0 AS bad_envelope,
    count(*) FILTER (WHERE rule_reason = 'invalid_platform') AS n_platform,
    count(*) FILTER (WHERE rule_reason = 'event_ts_in_future') AS n_future
  FROM checked GROUP BY batch_id, envelope_dt
"""
SUMMARY = f"summary AS ({SUMMARY_BODY})"
SUMMARY_OUT = """
SELECT batch_id, event_date, received, good, bad_schema, bad_dq, CAST(bad_envelope AS BIGINT) AS bad_envelope,
  concat('{', concat_ws(',',
    CASE WHEN n_platform > 0 THEN concat('"invalid_platform":', n_platform) END,
    CASE WHEN n_future > 0 THEN concat('"event_ts_in_future":', n_future) END), '}') AS dq_reasons
FROM summary
"""
# What lands beside the events: lines that are no single envelope, envelopes without events.
ODD_LINES = """
broken AS (
  SELECT CASE (seq // 191) % 3
    WHEN 0 THEN concat('{"dt": "2024-01-05", "events": [{"id": "x', seq, '"')
    WHEN 1 THEN concat('{"dt": "2024-01-05", "batch_id": "two", "events": [{"id": "', seq, '"}]}{"events": []}')
    ELSE concat('{"dt": "2024-01-05", "events": []} tail', seq) END AS raw
  FROM f WHERE seq % 191 = 0
),
empty AS (
  SELECT DISTINCT concat('empty', seq % 7) AS batch_id, landed_dt AS event_date
  FROM f WHERE seq % 193 = 0 AND landed_dt IS NOT NULL
)"""
JOB_SUMMARY = f"""per_batch AS ({SUMMARY_BODY}),
summary AS (
  SELECT batch_id, event_date, CAST(sum(received) AS BIGINT) AS received, CAST(sum(good) AS BIGINT) AS good,
    CAST(sum(bad_schema) AS BIGINT) AS bad_schema, CAST(sum(bad_dq) AS BIGINT) AS bad_dq,
    sum(bad_envelope) AS bad_envelope, CAST(sum(n_platform) AS BIGINT) AS n_platform, CAST(sum(n_future) AS BIGINT) AS n_future
  FROM (SELECT * FROM per_batch
    UNION ALL BY NAME SELECT batch_id, event_date, 0 AS received, 0 AS good, 0 AS bad_schema, 0 AS bad_dq,
      0 AS bad_envelope, 0 AS n_platform, 0 AS n_future FROM empty
    UNION ALL BY NAME SELECT 'unknown' AS batch_id, '2024-01-31' AS event_date, 0 AS received, 0 AS good,
      0 AS bad_schema, 0 AS bad_dq, 1 AS bad_envelope, 0 AS n_platform, 0 AS n_future FROM broken)
  GROUP BY batch_id, event_date
)"""

# Upsert fixture: old rows as target, corrected old rows plus new rows as source.
SIDES = [
    f"old_rows AS (SELECT * FROM good WHERE event_ts <= {MARK})",
    f"target AS ({latest('old_rows', _REST_WITH_SEQ)})",
    f"""offered AS (
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS os) FROM target WHERE seq % 10 = 0
  UNION ALL SELECT * FROM good WHERE event_ts > {MARK}
)""",
    f"source AS ({latest('offered', _REST_WITH_SEQ)})",
]

_ALL = (
    "seq session_id username event_type platform event_ts event_date batch_id ingested_at "
    "device os country url browser_version screen screen_size app_version"
).split()


def full_outer(target: str, source: str, guard: str = "TRUE", extra: str = "") -> str:
    hit = f"s.event_id IS NOT NULL AND (t.event_id IS NULL OR {guard})"
    columns = ", ".join(f"CASE WHEN {hit} THEN s.{c} ELSE t.{c} END AS {c}" for c in _ALL)
    return (
        f"SELECT coalesce(t.event_id, s.event_id) AS event_id, {columns}{extra} "
        f"FROM {target} t FULL OUTER JOIN {source} s ON t.event_id = s.event_id"
    )


# Two increments, each deduplicated on its own; the later one wins.
TWO_RUNS = [
    f"first_in AS (SELECT * FROM good WHERE event_ts <= {MARK})",
    f"second_in AS (SELECT * FROM good WHERE event_ts > {MARK})",
    f"first_run AS ({latest('first_in')})",
    f"second_run AS ({latest('second_in')})",
    """merged AS (
  SELECT * FROM second_run
  UNION ALL
  SELECT * FROM first_run
  WHERE NOT EXISTS (SELECT 1 FROM second_run s WHERE s.event_id = first_run.event_id)
)""",
    silver("silver", "merged"),
]

# Late rows in the second run, which reads ten days back from the first one's latest time.
LATE_RUNS = [
    f"""first_in AS (SELECT * FROM good WHERE event_ts <= {MARK}
    AND NOT (seq % 11 = 0 AND event_ts > TIMESTAMP '2024-01-07 00:00:00'))""",
    "second_in AS (SELECT * FROM good WHERE event_ts > (SELECT max(event_ts) FROM first_in) - INTERVAL 10 DAYS)",
    f"first_run AS ({latest('first_in')})",
    f"second_run AS ({latest('second_in')})",
    """merged AS (
  SELECT s.* FROM second_run s LEFT JOIN first_run t ON s.event_id = t.event_id
  WHERE t.event_id IS NULL OR s.event_ts >= t.event_ts
  UNION ALL
  SELECT t.* FROM first_run t LEFT JOIN second_run s ON s.event_id = t.event_id
  WHERE s.event_id IS NULL OR s.event_ts < t.event_ts
)""",
    silver("silver", "merged"),
]

MARK_TEXT = """CASE WHEN strftime(max(event_ts), '%f') = '000000'
    THEN strftime(max(event_ts), '%Y-%m-%dT%H:%M:%SZ')
    ELSE strftime(max(event_ts), '%Y-%m-%dT%H:%M:%S.%fZ') END"""


def counts(column: str) -> str:
    return query(f"SELECT {column}, count(*) AS n FROM featured GROUP BY {column}", *FEATURES)


ORACLE = {
    "envelope_scan": query(
        """SELECT batch_id, envelope_dt, count(seq) AS events FROM (
  SELECT landed_batch AS batch_id, landed_dt AS envelope_dt, seq FROM f
  UNION ALL SELECT NULL, NULL, NULL FROM broken
  UNION ALL SELECT batch_id, event_date, NULL FROM empty) GROUP BY batch_id, envelope_dt""",
        ODD_LINES,
    ),
    "normalize_flatten": query(
        f"SELECT * {TEXT} FROM (SELECT {RAW_COLUMNS} FROM checked WHERE schema_reason IS NULL)"
    ),
    "validate_reasons": query("SELECT seq, schema_reason AS dq_reason FROM checked"),
    "dq_reasons": query("SELECT seq, dq_stage, dq_reason FROM bad"),
    "dq_reason_histogram": query(
        "SELECT dq_stage, dq_reason, count(*) AS n FROM bad GROUP BY dq_stage, dq_reason"
    ),
    "batch_summary": query(SUMMARY_OUT, SUMMARY),
    "ingest_totals": query(
        "SELECT CAST(sum(good) AS BIGINT) AS total_good, "
        "CAST(sum(bad_schema + bad_dq) AS BIGINT) AS total_bad, "
        "CAST(sum(bad_envelope) AS BIGINT) AS total_bad_envelope FROM summary",
        SUMMARY,
    ),
    "quarantine_union": query(
        "SELECT seq, dq_stage, dq_reason FROM bad WHERE dq_stage = 'dq' "
        "UNION ALL SELECT seq, dq_stage, dq_reason FROM bad WHERE dq_stage = 'schema'"
    ),
    "quarantine_table": query(
        "SELECT envelope_dt AS event_date, batch_id, dq_stage, dq_reason, "
        "CASE WHEN seq % 167 <> 0 THEN id END AS payload_id, "
        "CASE WHEN seq % 167 <> 0 AND seq % 173 <> 0 THEN username END AS payload_username FROM bad"
    ),
    "ingest_job": query(SUMMARY_OUT, ODD_LINES, JOB_SUMMARY),
    "ingest_job_raw": query(f"SELECT * EXCLUDE (seq) {TEXT} FROM good"),
    "ingest_job_quarantine": query(
        "SELECT envelope_dt AS event_date, batch_id, dq_stage, dq_reason, "
        "CASE WHEN seq % 167 <> 0 AND seq % 173 <> 0 THEN username END AS username, "
        "CASE WHEN seq % 167 <> 0 THEN id END AS payload_id FROM bad "
        "UNION ALL SELECT '2024-01-31', 'unknown', 'envelope', 'malformed_envelope', NULL, NULL FROM broken",
        ODD_LINES,
    ),
    "malformed_lines": query(
        "SELECT '2024-01-31' AS event_date, 'unknown' AS batch_id, 'malformed_envelope' AS dq_reason, raw FROM broken",
        ODD_LINES,
    ),
    "malformed_events": query(
        "SELECT seq, 'schema' AS dq_stage, seq % 167 = 0 AS no_id FROM checked "
        "WHERE schema_reason = 'unexpected_normalize_error'"
    ),
    "envelope_defaults": query(
        "SELECT seq, batch_id, envelope_dt AS envelope_date FROM checked "
        "WHERE schema_reason IS NULL AND rule_reason IS NULL AND (batch_id = 'unknown' OR envelope_dt = '2024-01-31')"
    ),
    "empty_batches": query(
        "SELECT batch_id, event_date, CAST(0 AS BIGINT) AS received FROM empty "
        "WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.batch_id = empty.batch_id)",
        ODD_LINES,
    ),
    "ingest_repeated": query(f"SELECT * EXCLUDE (seq) {TEXT} FROM good"),
    "running_totals": query(
        """SELECT (SELECT count(*) FROM checked) AS received, sum(good)::BIGINT AS good, sum(bad_schema)::BIGINT AS bad_schema,
  sum(bad_dq)::BIGINT AS bad_dq, (SELECT count(*) FROM broken) AS bad_envelope,
  concat('{"event_ts_in_future":', sum(n_future)::BIGINT, ',"invalid_platform":', sum(n_platform)::BIGINT, '}') AS dq_reasons,
  CAST(2 AS BIGINT) AS runs FROM summary""",
        ODD_LINES,
        SUMMARY,
    ),
    "compacted_raw": query(f"SELECT * EXCLUDE (seq) {TEXT}, TRUE AS few_files FROM good"),
    "quarantine_replay": query(
        f"""SELECT * {TEXT}, CAST(0 AS BIGINT) AS moved_again
FROM (SELECT {RAW_COLUMNS.replace("parsed_date AS", "CAST(envelope_dt AS DATE) AS")} FROM bad
  WHERE dq_stage = 'dq' AND platform IN ('web', 'mobile', 'tv'))"""
    ),
    "upsert_random_keys": query(
        f"""SELECT * REPLACE (md5(event_id) AS event_id, CASE WHEN seq % 97 = 0 THEN 'corrected' ELSE os END AS os,
  {ts_text('event_ts')} AS event_ts, strftime(event_date, '%Y-%m-%d') AS event_date, {ts_text('ingested_at')} AS ingested_at)
FROM ({latest('good', _REST_WITH_SEQ)})"""
    ),
    "target_names": query(
        """SELECT 'as given' AS asked, '`db`.`events`' AS found, count(*) AS n FROM good WHERE seq % 2 = 0
UNION ALL SELECT 'without its catalog', '`db`.`events`', count(*) FROM good WHERE seq % 2 = 0
UNION ALL SELECT 'with a catalog', '`spark_catalog`.`db`.`odd_events`', count(*) FROM good WHERE seq % 2 = 1"""
    ),
    "late_rows": query(
        """SELECT 'late table' AS went_to, strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS n
FROM scanned WHERE part = 2 AND event_ts <= mark GROUP BY ALL
UNION ALL SELECT 'scanned', NULL, count(*) FROM scanned
UNION ALL SELECT 'increment', NULL, count(*) FROM scanned WHERE event_ts > mark
UNION ALL SELECT 'late', NULL, count(*) FROM scanned WHERE part = 2 AND event_ts <= mark
UNION ALL SELECT 'seen', NULL, count(*) FROM scanned WHERE part = 1 AND event_ts <= mark
UNION ALL SELECT 'untimed', NULL, CAST(0 AS BIGINT)""",
        f"parts AS (SELECT *, CASE WHEN event_ts <= {MARK} AND seq % 11 <> 0 THEN 1 ELSE 2 END AS part FROM good)",
        "marked AS (SELECT *, (SELECT max(event_ts) FROM parts WHERE part = 1) AS mark FROM parts)",
        "scanned AS (SELECT * FROM marked WHERE event_date >= CAST(mark - INTERVAL 3 DAYS AS DATE))",
    ),
    "guarded_mark": query(
        f"SELECT {MARK_TEXT} AS last_processed_event_ts, 2 AS generation, TRUE AS refused FROM good"
    ),
    "stream_deduplicated": query(
        f"SELECT * EXCLUDE (seq) {TEXT} FROM ({latest('good', _REST_WITH_SEQ)})"
    ),
    "null_filters": query(
        f"SELECT event_id, {ts_text('event_ts')} AS event_ts FROM kept_latest",
        f"""kept AS (SELECT * FROM good WHERE seq % 10 NOT IN (0, 1))""",
        f"kept_latest AS ({latest('kept', _REST_WITH_SEQ)})",
    ),
    "run_batch_default": query(
        "SELECT TRUE AS from_time, count(DISTINCT event_id) AS n, CAST(1 AS BIGINT) AS ids FROM good"
    ),
    "partition_pruned_scan": query(
        "SELECT strftime(event_date, '%Y-%m-%d') AS event_date, count(*) AS n FROM good "
        "WHERE event_date >= DATE '2024-01-12' GROUP BY ALL"
    ),
    "incremental_filter": query(
        f"SELECT seq, event_id, {ts_text('event_ts')} AS event_ts FROM good WHERE event_ts > {MARK}"
    ),
    "next_watermark": query(
        f"SELECT {MARK_TEXT} AS last_processed_event_ts FROM latest WHERE event_ts > {MARK}", LATEST
    ),
    "run_stats": query(
        f"""SELECT count(*) AS rows_raw_scanned,
  count(*) FILTER (WHERE event_ts > {MARK}) AS rows_new,
  CASE WHEN strftime(max(event_ts), '%f') = '000000' THEN strftime(max(event_ts), '%Y-%m-%d %H:%M:%S')
    ELSE strftime(max(event_ts), '%Y-%m-%d %H:%M:%S.%f') END AS max_event_ts_new
FROM good WHERE event_date >= DATE '2024-01-12'"""
    ),
    "silver_dedupe": query(f"SELECT * EXCLUDE (seq) {TEXT} FROM latest", LATEST),
    "string_normalize": query(
        f"SELECT seq, platform, event_type, device, country FROM (SELECT * {NORMALIZED} FROM good)"
    ),
    "event_hour_counts": counts("event_hour"),
    "device_family_counts": counts("device_family"),
    "geo_region_counts": counts("geo_region"),
    "event_category_counts": counts("event_category"),
    "silver_features": query(f"SELECT * {TEXT} FROM silver", *SILVER),
    "silver_counts": query(
        "SELECT geo_region, device_family, event_category, count(*) AS n FROM silver GROUP BY ALL",
        *SILVER,
    ),
    "missing_column_defaults": query(
        f"""SELECT * EXCLUDE (seq, device, country, event_type)
    REPLACE ('run_fixed' AS batch_id, lower(trim(platform)) AS platform,
      {ts_text('event_ts')} AS event_ts, strftime(event_date, '%Y-%m-%d') AS event_date,
      {ts_text('ingested_at')} AS ingested_at),
  {HOUR} AS event_hour, 'unknown' AS device_family, 'unknown' AS geo_region, 'other' AS event_category
FROM latest_narrow""",
        # All batch ids are equal here, and the dropped columns cannot decide a tie.
        f"latest_narrow AS ({latest('good', _REST_NARROW, ['event_ts', 'ingested_at'])})",
    ),
    "sample_rows": query(
        "SELECT event_id, event_type, platform, country, geo_region, device_family, event_hour, "
        "event_category FROM silver ORDER BY event_id LIMIT 5",
        *SILVER,
    ),
    "upsert_rows": query(
        f"SELECT * {TEXT} FROM ({full_outer('target', 'source')})", *SIDES
    ),
    "upsert_target_only_columns": query(
        "SELECT event_id, os, note FROM ("
        + full_outer(
            "target", "source", extra=", CASE WHEN t.event_id IS NOT NULL THEN 'kept' END AS note"
        )
        + ")",
        *SIDES,
    ),
    "upsert_older_rows_ignored": query(
        f"SELECT * {TEXT} FROM ({full_outer('source', 'target', 's.event_ts >= t.event_ts')})", *SIDES
    ),
    "upsert_parquet_table": query(
        f"SELECT * {TEXT} FROM ("
        + full_outer(
            "target", "source", extra=", CASE WHEN t.event_id IS NOT NULL THEN 'kept' END AS note"
        )
        + ")",
        *SIDES,
    ),
    "incremental_two_runs": query(f"SELECT * {TEXT} FROM silver", *TWO_RUNS),
    "late_rows_tolerated": query(f"SELECT * {TEXT} FROM silver", *LATE_RUNS),
    "stored_mark": query(
        f"SELECT {MARK_TEXT} AS last_processed_event_ts, {MARK_TEXT} AS parsed_back FROM good"
    ),
    "stream_available_now": query(f"SELECT * {TEXT} FROM silver", *SILVER),
}
