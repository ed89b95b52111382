"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The events -> vectors mapping reuses the very same slot SQL text as the Spark
side (:data:`aerolake.sources.fixtures.SLOT_SQL`); only the list syntax
differs. The oracle computes everything directly from ``events`` with plain
window functions, joins and CASE expressions - no shared code path with the
Spark operators beyond the fixed slot text.
"""

from __future__ import annotations

from aerolake.plans import queries as Q
from aerolake.schema import LIGHT_SLOT_NAMES, PAYLOAD_HASH_COLUMNS, RECORD_KEY_COLUMNS, STATE_SLOTS
from aerolake.sources.fixtures import (
    EXTRA_SLOT_VALUE,
    LONG_VECTOR_MOD,
    MAX_STATES_PER_PAYLOAD,
    NULL_VECTOR_MOD,
    SHORT_VECTOR_MOD,
    SLOT_SQL,
)

_DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "array<int>": "INTEGER[]",
}


def _vec_ctes(name: str, value_sql: str = "value") -> str:
    slots = ",\n        ".join(SLOT_SQL)
    return f"""{name}_ev AS (
    SELECT event_id, user_id, event_type, {value_sql} AS value,
           CAST(floor(epoch(ts)) AS BIGINT) AS ep
    FROM events
), {name}_rn AS (
    SELECT *, row_number() OVER (PARTITION BY ep // 3600 ORDER BY event_id) - 1 AS rn
    FROM {name}_ev
), {name}_pos AS (
    SELECT *, (ep // 3600 + 1) * 3600 + rn // {MAX_STATES_PER_PAYLOAD} AS source_response_time,
           CAST(rn % {MAX_STATES_PER_PAYLOAD} AS INTEGER) AS state_position
    FROM {name}_rn
), {name}_full AS (
    SELECT event_id, source_response_time, state_position, [
        {slots}
    ] AS full_state
    FROM {name}_pos
), {name}_st AS (
    SELECT event_id, source_response_time, state_position,
           CASE WHEN event_id % {NULL_VECTOR_MOD} = 0 THEN NULL
                WHEN event_id % {SHORT_VECTOR_MOD} = 0 THEN full_state[1:16]
                WHEN event_id % {LONG_VECTOR_MOD} = 0 THEN list_append(full_state, '{EXTRA_SLOT_VALUE}')
                ELSE full_state END AS state
    FROM {name}_full
), {name} AS (
    SELECT *, CAST(CASE WHEN state IS NULL THEN -1 ELSE len(state) END AS INTEGER) AS field_count
    FROM {name}_st
)"""


def _source_file_sql(prefix: str) -> str:
    return (
        f"'{prefix}/' || CAST(source_response_time AS VARCHAR) || '-' || "
        f"CAST(state_position // {MAX_STATES_PER_PAYLOAD} AS VARCHAR) || '.json'"
    )


def _hash_sql(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


def _curated_ctes(name: str, vec: str, prefix: str, run_id: str) -> str:
    typed = []
    failures = []
    for index, col, type_name in STATE_SLOTS:
        raw = f"state[{index + 1}]"
        if type_name == "string":
            expr = f"trim({raw})" if col == "callsign" else raw
        else:
            expr = f"try_cast({raw} AS {_DUCK_TYPES[type_name]})"
            failures.append(f"CASE WHEN {raw} IS NOT NULL AND {expr} IS NULL THEN 1 ELSE 0 END")
        typed.append(f"{expr} AS {col}")
    typed_sql = ",\n        ".join(typed)
    failures_sql = f"({' + '.join(failures)}) AS n_cast_failures"
    return f"""{name}_typed AS (
    SELECT event_id, {typed_sql},
        {failures_sql},
        source_response_time, {_source_file_sql(prefix)} AS source_file, state_position,
        'opensky' AS source, '{run_id}' AS processing_run_id
    FROM {vec}
    WHERE state IS NOT NULL AND len(state) = 17
), {name}_time AS (
    SELECT *, coalesce(time_position, last_contact, source_response_time) AS event_timestamp_epoch
    FROM {name}_typed
), {name}_derived AS (
    SELECT *, make_timestamp(event_timestamp_epoch * 1000000) AS event_timestamp,
        CAST(make_timestamp(event_timestamp_epoch * 1000000) AS DATE) AS event_date,
        round(velocity_m_s * CAST(3.6 AS DOUBLE), 2) AS velocity_kmh,
        round(barometric_altitude_m * CAST(3.28084 AS DOUBLE), 2) AS barometric_altitude_ft,
        round(geometric_altitude_m * CAST(3.28084 AS DOUBLE), 2) AS geometric_altitude_ft
    FROM {name}_time
), {name} AS (
    SELECT *, {_hash_sql(RECORD_KEY_COLUMNS)} AS record_key,
        {_hash_sql(PAYLOAD_HASH_COLUMNS)} AS payload_hash
    FROM {name}_derived
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = _with(_vec_ctes("vec"))
CURATED = _with(_vec_ctes("vec"), _curated_ctes("cur", "vec", "events/payload", Q.RUN_ID))

_MERGE_CTES = _with(
    _vec_ctes("vec"),
    _vec_ctes("vec2", Q.EDITED_VALUE_SQL),
    "tvec AS (SELECT * FROM vec WHERE " + Q.TARGET_SPLIT_SQL + ")",
    "svec AS (SELECT * FROM vec2 WHERE " + Q.SOURCE_SPLIT_SQL + ")",
    _curated_ctes("tgt", "tvec", "events/payload", Q.RUN_ID),
    _curated_ctes("src", "svec", Q.RELANDED_PREFIX, Q.RERUN_ID),
    """j AS (
    SELECT t.record_key AS t_key, s.record_key AS s_key,
           t.payload_hash AS t_hash, s.payload_hash AS s_hash,
           t.source_file AS t_file, s.source_file AS s_file,
           t.processing_run_id AS t_run, s.processing_run_id AS s_run,
           t.velocity_m_s AS t_vel, s.velocity_m_s AS s_vel,
           t.event_date AS t_day, s.event_date AS s_day,
           t.origin_country AS t_country, s.origin_country AS s_country,
           CASE WHEN t.record_key IS NULL THEN 'insert'
                WHEN s.record_key IS NULL THEN 'keep'
                WHEN t.payload_hash IS NOT DISTINCT FROM s.payload_hash THEN 'noop'
                ELSE 'update' END AS action
    FROM tgt t FULL OUTER JOIN src s ON t.record_key = s.record_key
)""",
    """merged AS (
    SELECT coalesce(t_key, s_key) AS record_key,
           CASE WHEN action IN ('insert', 'update') THEN s_hash ELSE t_hash END AS payload_hash,
           CASE WHEN action IN ('insert', 'update') THEN s_file ELSE t_file END AS source_file,
           CASE WHEN action IN ('insert', 'update') THEN s_run ELSE t_run END AS processing_run_id,
           CASE WHEN action IN ('insert', 'update') THEN s_vel ELSE t_vel END AS velocity_m_s,
           CASE WHEN action IN ('insert', 'update') THEN s_day ELSE t_day END AS event_date,
           CASE WHEN action IN ('insert', 'update') THEN s_country ELSE t_country END AS origin_country
    FROM j
)""",
)

_DAY = f"DATE '{Q.QUERY_DAY.isoformat()}'"
_LANDING_TS = f"make_timestamp((source_response_time + {Q.LANDING_DELAY_S}) * 1000000)"

_DQ_RULES = [
    ("ICAO24_MISSING", "icao24 IS NULL"),
    ("LAST_CONTACT_MISSING", "last_contact IS NULL"),
    ("LATITUDE_OUT_OF_RANGE", "NOT (latitude BETWEEN -90 AND 90)"),
    ("LONGITUDE_OUT_OF_RANGE", "NOT (longitude BETWEEN -180 AND 180)"),
    ("VELOCITY_NEGATIVE", "velocity_m_s < 0"),
    ("TRUE_TRACK_OUT_OF_RANGE", "NOT (true_track_degrees BETWEEN 0 AND 360)"),
    ("LAST_CONTACT_AFTER_RESPONSE", "last_contact > source_response_time + 0"),
    ("EVENT_TIME_MISSING", "event_timestamp_epoch IS NULL"),
    ("TYPE_CONVERSION_FAILED", "n_cast_failures > 0"),
]


def _dq_list() -> str:
    parts = ", ".join(f"CASE WHEN coalesce({p}, false) THEN '{n}' END" for n, p in _DQ_RULES)
    return f"concat_ws(',', {parts})"


def _dq_summary() -> str:
    unions = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE coalesce({p}, false)) AS n FROM cur" for n, p in _DQ_RULES
    )
    return CURATED + unions


_REASON = """CASE WHEN state IS NULL THEN 'STATE_ARRAY_IS_NULL'
            ELSE 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_' || CAST(field_count AS VARCHAR) END"""
_OK = "(state IS NOT NULL AND field_count = 17)"
_KEY = f"""'raw/opensky/states/year=' || strftime({_LANDING_TS}, '%Y') || '/month=' || strftime({_LANDING_TS}, '%m')
       || '/day=' || strftime({_LANDING_TS}, '%d') || '/hour=' || strftime({_LANDING_TS}, '%H')
       || '/' || strftime({_LANDING_TS}, '%Y%m%dT%H%M%SZ') || '.json'"""
# What the seeded landing makes of a document, by its landing hour.
_SEEDED = f"""CASE hour({_LANDING_TS}) WHEN 0 THEN 'INVALID_JSON' WHEN 1 THEN 'EMPTY_OBJECT' WHEN 2 THEN 'INVALID_UTF8'
       WHEN 3 THEN 'STATES_NOT_LIST' WHEN 4 THEN 'NO_STATES' WHEN 5 THEN 'STATES_NOT_LIST' WHEN 6 THEN 'STATES_NOT_LIST' ELSE 'OK' END"""
_SEEDED_DOCS = BASE.rstrip("\n") + f""",
docs AS (
    SELECT source_response_time, {_SEEDED} AS code FROM (SELECT DISTINCT source_response_time FROM vec)
    UNION ALL SELECT max(source_response_time) + 86400, 'OK' FROM vec
)
"""
_SEEDED_VECTORS = BASE.rstrip("\n") + f""",
seeded AS (SELECT *, {_SEEDED} AS code FROM vec)
"""


def _held_sql() -> str:
    held = ["LAST_CONTACT_MISSING", "LATITUDE_OUT_OF_RANGE"]  # in the order of the rules
    parts = ", ".join(f"CASE WHEN coalesce({dict(_DQ_RULES)[r]}, false) THEN '{r}' END" for r in held)
    return f"concat_ws('+', {parts})"


_LIGHT = ", ".join(
    f"state[{i + 1}] AS {name}" if name != "callsign" else
    "CASE WHEN state[2] IS NULL OR state[2] = '' THEN state[2] ELSE regexp_replace(state[2], '^\\s+|\\s+$', '', 'g') END AS callsign"
    for i, name in enumerate(LIGHT_SLOT_NAMES))

ORACLE_SQL: dict[str, str] = {
    "landing_validation": _SEEDED_DOCS + f"""SELECT regexp_extract({_KEY}, 'year=[0-9]+/month=[0-9]+/day=[0-9]+') AS landing_day, code, count(*) AS n
FROM docs GROUP BY ALL""",
    "landed_object_keys": _SEEDED_DOCS + f"SELECT {_KEY} AS landing_key, code = 'EMPTY_OBJECT' AS is_empty FROM docs",
    "latest_landed_object": _SEEDED_DOCS + f"""SELECT substr({_KEY}, strpos({_KEY}, 'year=')) AS key, CAST({len(Q.LAST_BODY)} AS BIGINT) AS length, code
FROM docs ORDER BY source_response_time DESC LIMIT 1""",
    "json_lines_landing": BASE + f"""SELECT source_response_time, count(*) AS n_states, count(*) FILTER (WHERE {_OK}) AS n_valid
FROM vec GROUP BY source_response_time""",
    "string_states_rejected": BASE + f"""SELECT source_response_time,
       CASE WHEN hour({_LANDING_TS}) = 0 THEN 0 ELSE count(*) FILTER (WHERE {_OK}) END AS n_valid,
       CASE WHEN hour({_LANDING_TS}) = 0 THEN 1 ELSE count(*) FILTER (WHERE NOT {_OK}) END AS n_rejected
FROM vec GROUP BY source_response_time""",
    "nested_missing_states": BASE + f"""SELECT source_response_time,
       CASE WHEN hour({_LANDING_TS}) = 6 THEN 'MISSING_STATES' END AS error,
       CAST(CASE WHEN hour({_LANDING_TS}) != 6 THEN count(*) FILTER (WHERE {_OK}) END AS INTEGER) AS record_count,
       CAST(CASE WHEN hour({_LANDING_TS}) != 6 THEN count(*) FILTER (WHERE NOT {_OK}) END AS INTEGER) AS skipped_count
FROM vec GROUP BY source_response_time""",
    "nested_light_fields": BASE + f"""SELECT {_LIGHT}, 'opensky' AS source, source_response_time,
       '{Q.RUN_TS.strftime("%Y-%m-%dT%H:%M:%S.%f")}Z' AS ingestion_timestamp
FROM vec WHERE {_OK}""",
    "processed_job_rejects": BASE + f"""SELECT source_response_time, state_position, field_count, {_REASON} AS rejection_reason,
       'OK' AS payload_status, DATE '{Q.RUN_TS.date().isoformat()}' AS ingestion_date
FROM vec WHERE NOT {_OK}""",
    "empty_batch_guard": BASE + f"""SELECT {_REASON} AS rejection_reason, count(*) AS n, 'NO_VALID_VECTORS' AS outcome
FROM vec WHERE NOT {_OK} GROUP BY ALL""",
    "curated_job_dq": CURATED.rstrip("\n") + f""",
checked AS (SELECT *, {_held_sql()} AS held FROM cur)
SELECT 'loaded' AS outcome, '' AS reason, count(*) AS n FROM checked WHERE held = ''
UNION ALL SELECT 'held', 'DQ_' || held, count(*) FROM checked WHERE held != '' GROUP BY held
UNION ALL SELECT 'held', {_REASON}, count(*) FROM vec WHERE NOT {_OK} GROUP BY ALL
UNION ALL SELECT 'raw', '', count(*) FROM vec
UNION ALL SELECT 'balanced', '', 1
UNION ALL SELECT 'flagged', 'TRUE_TRACK_OUT_OF_RANGE', count(*) FROM checked
          WHERE held = '' AND coalesce({dict(_DQ_RULES)["TRUE_TRACK_OUT_OF_RANGE"]}, false)""",
    "latest_object_job": _with(
        _vec_ctes("all_vec"),
        """vec AS (
    SELECT * REPLACE (source_response_time + 86400 AS source_response_time) FROM all_vec
    WHERE source_response_time = (SELECT max(source_response_time) FROM all_vec)
)""",
        _curated_ctes("cur", "vec", "x", Q.RUN_ID),
    ) + "SELECT record_key, payload_hash, state_position, source_response_time FROM cur",
    "gated_ingest": _SEEDED_VECTORS + f"""SELECT 'quarantined' AS outcome, code AS reason, count(DISTINCT source_response_time) AS n FROM seeded WHERE code != 'OK' GROUP BY code
UNION ALL SELECT 'merged', 'opensky', count(*) FROM seeded WHERE code = 'OK' AND {_OK}
UNION ALL SELECT 'rejected', reason, count(*) FROM (
    SELECT {_REASON} AS reason FROM seeded WHERE code = 'OK' AND NOT {_OK}
    UNION ALL SELECT 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_1') GROUP BY reason""",
    "explode_payloads": BASE + "SELECT source_response_time, state_position, field_count FROM vec",
    "raw_json_scan": BASE
    + """SELECT source_response_time, count(*) AS n_states,
       count(*) FILTER (WHERE field_count = 17) AS n_valid,
       count(DISTINCT state_position // """
    + str(MAX_STATES_PER_PAYLOAD)
    + """) AS n_files
FROM vec GROUP BY source_response_time""",
    "raw_day_partition_read": BASE
    + f"""SELECT source_response_time, count(*) AS n_states, count(*) FILTER (WHERE field_count = 17) AS n_valid
FROM vec WHERE CAST({_LANDING_TS} AS DATE) = {_DAY} GROUP BY source_response_time""",
    "validate_split_valid": BASE
    + "SELECT source_response_time, state_position, field_count FROM vec "
    "WHERE state IS NOT NULL AND field_count = 17",
    "validate_split_rejected": BASE
    + """SELECT source_response_time, state_position, field_count,
       CASE WHEN state IS NULL THEN 'STATE_ARRAY_IS_NULL'
            ELSE 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_' || CAST(field_count AS VARCHAR) END AS rejection_reason
FROM vec WHERE NOT (state IS NOT NULL AND field_count = 17)""",
    "reject_audit": BASE
    + f"""SELECT source_response_time, state_position, field_count,
       CASE WHEN state IS NULL THEN 'STATE_ARRAY_IS_NULL'
            ELSE 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_' || CAST(field_count AS VARCHAR) END AS rejection_reason,
       '{Q.RUN_ID}' AS processing_run_id,
       CAST({int(Q.RUN_TS.timestamp())} AS BIGINT) AS rejection_epoch,
       DATE '{Q.RUN_TS.date().isoformat()}' AS ingestion_date
FROM vec WHERE NOT (state IS NOT NULL AND field_count = 17)""",
    "project_state_vector": CURATED
    + "SELECT "
    + ", ".join(
        ("CAST(sensors AS VARCHAR) AS sensors" if c == "sensors" else c) for _, c, _t in STATE_SLOTS
    )
    + ", source_response_time, state_position, source FROM cur",
    "derive_event_time": CURATED
    + """SELECT source_response_time, state_position, event_timestamp_epoch,
       CAST(event_timestamp AS VARCHAR) AS event_timestamp, event_date FROM cur""",
    "derive_units": CURATED
    + """SELECT source_response_time, state_position, velocity_kmh, barometric_altitude_ft,
       geometric_altitude_ft FROM cur""",
    "record_key_hash": CURATED + "SELECT source_response_time, state_position, record_key FROM cur",
    "payload_hash": CURATED + "SELECT source_response_time, state_position, payload_hash FROM cur",
    "dedupe_record_key": _with(
        _vec_ctes("vec"),
        _vec_ctes("vec2", Q.EDITED_VALUE_SQL),
        _curated_ctes("a", "vec", "events/payload", Q.RUN_ID),
        _curated_ctes("b", "vec2", Q.RELANDED_PREFIX, Q.RERUN_ID),
        """u AS (
    SELECT record_key, payload_hash, source_file, velocity_m_s FROM a
    UNION ALL
    SELECT record_key, payload_hash, source_file, velocity_m_s FROM b
), r AS (
    SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY payload_hash, source_file) AS rn FROM u
)""",
    )
    + "SELECT record_key, payload_hash, source_file, velocity_m_s FROM r WHERE rn = 1",
    "merge_classify": _MERGE_CTES + "SELECT coalesce(t_key, s_key) AS record_key, action FROM j",
    "merge_action_summary": _MERGE_CTES + "SELECT action, count(*) AS n FROM j GROUP BY action",
    "merge_upsert": _MERGE_CTES
    + "SELECT record_key, payload_hash, source_file, processing_run_id, velocity_m_s, event_date FROM merged",
    "merge_insert_only": _MERGE_CTES + "SELECT s_key AS record_key, s_hash AS payload_hash FROM j WHERE action = 'insert'",
    "merge_changed_only": _MERGE_CTES
    + "SELECT s_key AS record_key, t_hash AS target_hash, s_hash AS payload_hash FROM j WHERE action = 'update'",
    "merge_idempotent_rerun": _MERGE_CTES
    + "SELECT record_key, payload_hash, source_file, processing_run_id, velocity_m_s, event_date FROM merged",
    "reconcile_counts": BASE
    + """SELECT count(*) AS raw_count,
       count(*) FILTER (WHERE state IS NOT NULL AND field_count = 17) AS valid_count,
       count(*) FILTER (WHERE NOT (state IS NOT NULL AND field_count = 17)) AS rejected_count,
       count(*) = count(*) FILTER (WHERE state IS NOT NULL AND field_count = 17)
                + count(*) FILTER (WHERE NOT (state IS NOT NULL AND field_count = 17)) AS balanced
FROM vec""",
    "processed_parquet_roundtrip": CURATED + "SELECT event_date, count(*) AS n FROM cur GROUP BY event_date",
    "dynamic_partition_overwrite": CURATED
    + """SELECT event_date,
       CASE WHEN event_date <= (SELECT min(event_date) FROM cur) + 1 THEN 'opensky-rerun' ELSE 'opensky' END AS source,
       count(*) AS n
FROM cur GROUP BY ALL""",
    "processed_table_discovery": CURATED + "SELECT event_date, count(*) AS n FROM cur GROUP BY event_date",
    "pruned_day_projection": CURATED + f"SELECT icao24, callsign, velocity_m_s FROM cur WHERE event_date = {_DAY}",
    "country_counts_for_day": CURATED
    + f"SELECT origin_country, count(*) AS n FROM cur WHERE event_date = {_DAY} GROUP BY origin_country",
    "country_counts_sql": CURATED
    + f"SELECT origin_country, count(*) AS n FROM cur WHERE event_date = {_DAY} GROUP BY origin_country",
    "preview_top20": CURATED
    + """SELECT record_key, icao24, callsign, origin_country, longitude, latitude, velocity_kmh,
       CAST(event_timestamp AS VARCHAR) AS event_timestamp, event_date
FROM cur ORDER BY record_key LIMIT 20""",
    "nested_light_transform": BASE
    + f"""SELECT source_response_time,
       CAST((state_position // {MAX_STATES_PER_PAYLOAD}) * {MAX_STATES_PER_PAYLOAD} AS INTEGER) AS base_position,
       CAST(count(*) FILTER (WHERE field_count = 17) AS INTEGER) AS record_count,
       CAST(count(*) FILTER (WHERE field_count <> 17) AS INTEGER) AS skipped_count,
       (list(CASE WHEN state[2] IS NULL OR state[2] = '' THEN state[2]
                  ELSE regexp_replace(state[2], '^\\s+|\\s+$', '', 'g') END
             ORDER BY state_position) FILTER (WHERE field_count = 17))[1] AS first_callsign,
       (list(CASE WHEN state[2] IS NULL OR state[2] = '' THEN state[2]
                  ELSE regexp_replace(state[2], '^\\s+|\\s+$', '', 'g') END
             ORDER BY state_position) FILTER (WHERE field_count = 17))[-1] AS last_callsign
FROM vec GROUP BY ALL""",
    "landing_key": BASE
    + f"""SELECT DISTINCT source_response_time,
       CAST((state_position // {MAX_STATES_PER_PAYLOAD}) * {MAX_STATES_PER_PAYLOAD} AS INTEGER) AS base_position,
       'raw/opensky/states/year=' || strftime({_LANDING_TS}, '%Y') || '/month=' || strftime({_LANDING_TS}, '%m')
       || '/day=' || strftime({_LANDING_TS}, '%d') || '/hour=' || strftime({_LANDING_TS}, '%H')
       || '/' || strftime({_LANDING_TS}, '%Y%m%dT%H%M%SZ') || '.json' AS landing_key
FROM vec""",
    "corrupt_document_rejects": BASE.rstrip("\n")
    + f""",
docs AS (
    SELECT DISTINCT source_response_time, state_position // {MAX_STATES_PER_PAYLOAD} AS chunk FROM vec
), rej AS (
    SELECT CASE WHEN state IS NULL THEN 'STATE_ARRAY_IS_NULL'
                ELSE 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_' || CAST(field_count AS VARCHAR) END AS rejection_reason,
           'OK' AS payload_status, source_response_time
    FROM vec WHERE hour({_LANDING_TS}) <> 0 AND NOT (state IS NOT NULL AND field_count = 17)
    UNION ALL
    SELECT 'STATE_ARRAY_IS_NULL', 'CORRUPT_DOCUMENT', CAST(NULL AS BIGINT) FROM docs WHERE hour({_LANDING_TS}) = 0
)
SELECT rejection_reason, payload_status, count(*) AS n,
       count(*) FILTER (WHERE source_response_time IS NULL) AS n_no_time
FROM rej GROUP BY rejection_reason, payload_status""",
    "curated_create_or_merge": _MERGE_CTES
    + "SELECT record_key, payload_hash, source_file, processing_run_id, velocity_m_s, event_date FROM merged",
    "unpartitioned_table_create": CURATED
    + "SELECT origin_country, count(*) AS n, count(callsign) AS n_callsign FROM cur GROUP BY origin_country",
    "curated_job_two_runs": _MERGE_CTES
    + "SELECT record_key, payload_hash, processing_run_id, velocity_m_s, event_date FROM merged",
    "processed_job": CURATED
    + "SELECT event_date, count(*) AS n, count(callsign) AS n_callsign FROM cur GROUP BY event_date",
    "dq_rules": CURATED + f"SELECT record_key, {_dq_list()} AS violations FROM cur",
    "dq_violation_summary": _dq_summary(),
    "incremental_ingest": BASE + """SELECT source_response_time,
       count(*) FILTER (WHERE state IS NOT NULL AND field_count = 17) AS n,
       count(*) FILTER (WHERE NOT (state IS NOT NULL AND field_count = 17)) AS n_rejected
FROM vec GROUP BY source_response_time""",
    "incremental_rejects": BASE + f"""SELECT source_response_time, state_position, field_count,
       CASE WHEN state IS NULL THEN 'STATE_ARRAY_IS_NULL'
            ELSE 'INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_' || CAST(field_count AS VARCHAR) END AS rejection_reason,
       'OK' AS payload_status, '{Q.RUN_ID}' AS processing_run_id, CAST({int(Q.RUN_TS.timestamp())} AS BIGINT) AS rejection_epoch
FROM vec WHERE NOT (state IS NOT NULL AND field_count = 17)""",
    "end_to_end_day_counts": _MERGE_CTES
    + f"SELECT origin_country, count(*) AS n FROM merged WHERE event_date = {_DAY} GROUP BY origin_country",
}
