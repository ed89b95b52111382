"""Positional projection, event time, units, record key, payload hash."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.functions.casts import cast_slot_sql
from aerolake.functions.hashing import sha256_concat
from aerolake.operators.literals import to_micros
from aerolake.schema import (
    CURATED_COLUMNS,
    M_TO_FT,
    MS_TO_KMH,
    PAYLOAD_HASH_COLUMNS,
    PREVIEW_COLUMNS,
    PROCESSED_COLUMNS,
    RECORD_KEY_COLUMNS,
    SOURCE_NAME,
    STATE_SLOTS,
)


def project_state_vector(
    valid: DataFrame,
    run_id: str | None,
    run_ts: datetime | None,
    source: str = SOURCE_NAME,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """17 typed columns from the positional slots + carried metadata + run literals
    (+ any ``keep`` columns, e.g. ``cast_failures``, appended at the end).

    Casts are ANSI-independent (``get`` + ``try_cast``): junk text gives NULL,
    it never fails the job. ``callsign`` is trimmed of spaces.
    """
    typed = []
    for index, name, type_name in STATE_SLOTS:
        text = cast_slot_sql("state", index, type_name)
        if name == "callsign":
            text = f"trim({text})"
        typed.append(f"{text} AS `{name}`")
    carried = [c for c in ("source_response_time", "source_file", "state_position") if c in valid.columns]
    run_ts_sql = (
        f"timestamp_micros({to_micros(run_ts)})" if run_ts is not None else "cast(null as timestamp)"
    )
    run_id_sql = "cast(null as string)" if run_id is None else _sql_str(run_id)
    return valid.selectExpr(
        *typed,
        *[f"`{c}`" for c in carried],
        f"{_sql_str(source)} AS source",
        f"{run_id_sql} AS processing_run_id",
        f"{run_ts_sql} AS ingestion_timestamp",
        *[f"`{c}`" for c in keep],
    )


def _sql_str(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _event_time_columns() -> dict[str, F.Column]:
    epoch = F.coalesce("time_position", "last_contact", "source_response_time")
    ts = F.timestamp_seconds(epoch)
    return {"event_timestamp_epoch": epoch, "event_timestamp": ts, "event_date": F.to_date(ts)}


def _unit_columns() -> dict[str, F.Column]:
    return {
        "velocity_kmh": F.round(F.col("velocity_m_s") * F.lit(MS_TO_KMH), 2),
        "barometric_altitude_ft": F.round(F.col("barometric_altitude_m") * F.lit(M_TO_FT), 2),
        "geometric_altitude_ft": F.round(F.col("geometric_altitude_m") * F.lit(M_TO_FT), 2),
    }


def derive_event_time(df: DataFrame) -> DataFrame:
    """P5: first non-null of (time_position, last_contact, source_response_time)."""
    return df.withColumns(_event_time_columns())


def derive_units(df: DataFrame) -> DataFrame:
    """km/h and feet, rounded to 2 decimals (HALF_UP)."""
    return df.withColumns(_unit_columns())


def with_record_key(df: DataFrame) -> DataFrame:
    """SHA-256 of icao24||last_contact||source_response_time||state_position."""
    return df.withColumn("record_key", sha256_concat(RECORD_KEY_COLUMNS))


def with_payload_hash(df: DataFrame) -> DataFrame:
    """SHA-256 over the 26 content columns (run id, ingestion time, file excluded)."""
    return df.withColumn("payload_hash", sha256_concat(PAYLOAD_HASH_COLUMNS))


def curate(
    valid: DataFrame,
    run_id: str | None,
    run_ts: datetime | None,
    source: str = SOURCE_NAME,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Valid exploded rows -> the 31-column curated schema, in contract order
    (+ ``keep`` columns carried through after them)."""
    df = project_state_vector(valid, run_id, run_ts, source, keep)
    derived = {**_event_time_columns(), **_unit_columns()}
    if "source_file" not in df.columns:
        derived["source_file"] = F.lit(None).cast("string")
    df = df.withColumns(derived)
    df = df.withColumns(
        {"record_key": sha256_concat(RECORD_KEY_COLUMNS), "payload_hash": sha256_concat(PAYLOAD_HASH_COLUMNS)}
    )
    return df.select(*CURATED_COLUMNS, *keep)


def processed_projection(curated: DataFrame) -> DataFrame:
    """Processed (plain Parquet) layer: curated minus merge-only columns."""
    return curated.select(*PROCESSED_COLUMNS)


def preview(curated: DataFrame, n: int = 20) -> DataFrame:
    """Reproducible first-``n`` preview (ordered by record_key, a top-k)."""
    cols = PREVIEW_COLUMNS + (["record_key"] if "record_key" in curated.columns else [])
    order = "record_key" if "record_key" in curated.columns else "icao24"
    return curated.select(*cols).orderBy(order).limit(n)


def narrow_projection(df: DataFrame) -> DataFrame:
    """P10: the analyst's narrow read (column pruning reaches the scan)."""
    return df.select("icao24", "callsign", "velocity_m_s")
