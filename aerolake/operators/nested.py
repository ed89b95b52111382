"""Per-document "light" transform with higher-order functions.

Each response document stays one row: vectors with exactly 17 fields become
structs with un-suffixed names (callsign stripped of all surrounding
whitespace when non-empty), others are skipped and counted. No explode and no
shuffle - the work is linear in the document and runs where it is read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.casts import slot, strip_whitespace
from aerolake.operators.literals import run_timestamp_literal
from aerolake.schema import EXPECTED_STATE_FIELDS, LIGHT_SLOT_NAMES, SOURCE_NAME

MISSING_STATES = "MISSING_STATES"


def _light_struct(x: Column, response_time: Column, ingestion_ts: Column) -> Column:
    fields = []
    for i, name in enumerate(LIGHT_SLOT_NAMES):
        v = slot(x, i)
        if name == "callsign":
            v = F.when((v.isNotNull()) & (v != F.lit("")), strip_whitespace(v)).otherwise(v)
        fields.append(v.alias(name))
    fields += [
        F.lit(SOURCE_NAME).alias("source"),
        response_time.alias("source_response_time"),
        ingestion_ts.alias("ingestion_timestamp"),
    ]
    return F.struct(*fields)


def light_transform(
    payloads: DataFrame,
    run_ts: datetime | None = None,
    time_col: str = "time",
    states_col: str = "states",
    fail_on_missing: bool = False,
) -> DataFrame:
    """One output row per document.

    Columns: ``source, source_response_time, ingestion_timestamp, record_count,
    skipped_count, states`` (array of structs) and ``error`` (``MISSING_STATES``
    when the document has no ``states``; an empty list is fine). With
    ``fail_on_missing`` a missing ``states`` raises at run time.
    """
    ts_text = (
        F.date_format(run_timestamp_literal(run_ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        if run_ts is not None
        else F.lit(None).cast("string")
    )
    states = F.col(states_col)
    rt = F.col(time_col)
    ok = F.filter(states, lambda x: x.isNotNull() & (F.size(x) == F.lit(EXPECTED_STATE_FIELDS)))
    records = F.transform(ok, lambda x: _light_struct(x, rt, ts_text))
    error = F.when(states.isNull(), F.lit(MISSING_STATES))
    if fail_on_missing:
        error = F.when(states.isNull(), F.raise_error(F.lit(MISSING_STATES)))
    return payloads.select(
        F.lit(SOURCE_NAME).alias("source"),
        rt.alias("source_response_time"),
        ts_text.alias("ingestion_timestamp"),
        # NULL (not size(NULL), which is -1 with ANSI off) when the document has no states.
        F.when(states.isNotNull(), F.size(ok)).alias("record_count"),
        F.when(states.isNotNull(), F.size(states) - F.size(ok)).alias("skipped_count"),
        records.alias("states"),
        error.cast("string").alias("error"),
        *[F.col(c) for c in payloads.columns if c in ("base_position", "source_file")],
    )
