"""Golden record and golden landing key from the reference's documentation/tests."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aerolake.jobs import validated_rows
from aerolake.operators.project import curate
from aerolake.operators.validate import split_valid_rejected
from aerolake.functions.timefmt import landing_key
from support import write_file

GOLDEN_DOC = {
    "time": 1784188215,
    "states": [
        ["39de4f", "TVF686M ", "France", 1784188214, 1784188214, 0.2578, 46.3459, 10172.7, False,
         237.89, 26.73, -8.45, None, 10622.28, "1000", False, 0]
    ],
}


def test_golden_record(spark, ansi, tmp_dir):
    path = write_file(os.path.join(tmp_dir, "doc.json"), json.dumps(GOLDEN_DOC))
    valid, rejected = split_valid_rejected(validated_rows(spark, path))
    assert rejected.count() == 0
    row = curate(valid, "r1", dt.datetime(2026, 7, 16, 8, tzinfo=dt.timezone.utc)).first()
    assert row.icao24 == "39de4f"
    assert row.callsign == "TVF686M"
    assert row.origin_country == "France"
    assert row.time_position == 1784188214 and row.last_contact == 1784188214
    assert row.longitude == 0.2578 and row.latitude == 46.3459
    assert row.barometric_altitude_m == 10172.7
    assert row.on_ground is False and row.special_purpose_indicator is False
    assert row.velocity_m_s == 237.89 and row.velocity_kmh == 856.4
    assert row.sensors is None and row.squawk == "1000" and row.position_source == 0
    assert row.event_timestamp_epoch == 1784188214
    assert row.event_timestamp == dt.datetime(2026, 7, 16, 7, 50, 14)
    assert row.event_date == dt.date(2026, 7, 16)
    assert row.source == "opensky" and row.state_position == 0
    assert row.source_response_time == 1784188215
    assert row.source_file.endswith("doc.json")
    assert len(row.record_key) == 64 and len(row.payload_hash) == 64
    assert row.barometric_altitude_ft == round(10172.7 * 3.28084, 2)


def test_golden_landing_key(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 7, 21, 10, 30, 45),)], "ts timestamp")
    key = df.select(landing_key(F.col("ts")).alias("k")).first().k
    assert key == "raw/opensky/states/year=2026/month=07/day=21/hour=10/20260721T103045Z.json"


def test_record_key_text(spark):
    """record_key = sha256('icao||last_contact||response||position') with NULL as 'NULL'."""
    import hashlib

    from aerolake.operators.project import with_record_key

    df = spark.createDataFrame(
        [("abc123", None, 1750000000, 3)],
        "icao24 string, last_contact bigint, source_response_time bigint, state_position int",
    )
    got = with_record_key(df).first().record_key
    assert got == hashlib.sha256(b"abc123||NULL||1750000000||3").hexdigest()
