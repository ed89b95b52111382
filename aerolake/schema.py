"""Schemas, column orders and contract constants.

Everything in the "fixed values" block below is part of the data contract:
curated column names and order, the text used for rejection reasons, the
hash separator and NULL marker, and the column order of the two SHA-256
digests. Changing any of them changes stored keys/hashes, so they are kept
together and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay byte-identical for key / hash compatibility)
# ---------------------------------------------------------------------------

EXPECTED_STATE_FIELDS = 17
SOURCE_NAME = "opensky"
HASH_SEPARATOR = "||"
NULL_TOKEN = "NULL"
REASON_NULL_STATE = "STATE_ARRAY_IS_NULL"
REASON_FIELD_COUNT_PREFIX = "INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_"
RAW_PREFIX = "raw/opensky/states"

# Positional slots of one state vector: (index, curated name, spark type).
STATE_SLOTS: list[tuple[int, str, str]] = [
    (0, "icao24", "string"),
    (1, "callsign", "string"),
    (2, "origin_country", "string"),
    (3, "time_position", "bigint"),
    (4, "last_contact", "bigint"),
    (5, "longitude", "double"),
    (6, "latitude", "double"),
    (7, "barometric_altitude_m", "double"),
    (8, "on_ground", "boolean"),
    (9, "velocity_m_s", "double"),
    (10, "true_track_degrees", "double"),
    (11, "vertical_rate_m_s", "double"),
    (12, "sensors", "array<int>"),
    (13, "geometric_altitude_m", "double"),
    (14, "squawk", "string"),
    (15, "special_purpose_indicator", "boolean"),
    (16, "position_source", "int"),
]

# Names used by the nested "light" document transform (un-suffixed names).
LIGHT_SLOT_NAMES: list[str] = [
    "icao24",
    "callsign",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "barometric_altitude",
    "on_ground",
    "velocity",
    "true_track",
    "vertical_rate",
    "sensors",
    "geometric_altitude",
    "squawk",
    "spi",
    "position_source",
]

# Curated table: 31 columns in insert-list order.
CURATED_COLUMNS: list[str] = [
    "icao24",
    "callsign",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "barometric_altitude_m",
    "on_ground",
    "velocity_m_s",
    "true_track_degrees",
    "vertical_rate_m_s",
    "sensors",
    "geometric_altitude_m",
    "squawk",
    "special_purpose_indicator",
    "position_source",
    "source_response_time",
    "source_file",
    "state_position",
    "source",
    "processing_run_id",
    "ingestion_timestamp",
    "event_timestamp_epoch",
    "event_timestamp",
    "event_date",
    "velocity_kmh",
    "barometric_altitude_ft",
    "geometric_altitude_ft",
    "record_key",
    "payload_hash",
]

# Processed (plain Parquet) layer: curated minus the three merge columns.
PROCESSED_COLUMNS: list[str] = [
    c for c in CURATED_COLUMNS if c not in ("processing_run_id", "record_key", "payload_hash")
]

# record_key digest input, in order.
RECORD_KEY_COLUMNS: list[str] = [
    "icao24",
    "last_contact",
    "source_response_time",
    "state_position",
]

# payload_hash digest input, in order (run id, ingestion time, source_file excluded).
PAYLOAD_HASH_COLUMNS: list[str] = [
    "icao24",
    "callsign",
    "origin_country",
    "time_position",
    "last_contact",
    "longitude",
    "latitude",
    "barometric_altitude_m",
    "on_ground",
    "velocity_m_s",
    "true_track_degrees",
    "vertical_rate_m_s",
    "sensors",
    "geometric_altitude_m",
    "squawk",
    "special_purpose_indicator",
    "position_source",
    "source_response_time",
    "state_position",
    "source",
    "event_timestamp_epoch",
    "event_timestamp",
    "event_date",
    "velocity_kmh",
    "barometric_altitude_ft",
    "geometric_altitude_ft",
]

# Unit conversion factors.
MS_TO_KMH = 3.6
M_TO_FT = 3.28084

# Preview projection (8 columns).
PREVIEW_COLUMNS: list[str] = [
    "icao24",
    "callsign",
    "origin_country",
    "longitude",
    "latitude",
    "velocity_kmh",
    "event_timestamp",
    "event_date",
]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

# Raw landing document. `states` is read as a VARIANT: one malformed element cannot change the type of the whole
# column (explicit schema instead of inference), the value is read once, and a JSON string that holds array
# text stays a string.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("time", T.LongType(), True),
        T.StructField("states", T.VariantType(), True),
        T.StructField("_corrupt_record", T.StringType(), True),
    ]
)
