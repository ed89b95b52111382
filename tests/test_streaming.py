"""availableNow incremental ingest processes each landed file once and upserts."""

from __future__ import annotations

import json
import os

from aerolake.streaming.incremental import run_incremental
from support import write_file


def vector(icao, t, vel=10.0):
    return [icao, "CS1 ", "X", t, t, 1.0, 2.0, 100.0, False, vel, 90.0, 0.0, None, 110.0, "0001", False, 0]


def test_incremental_once_and_upsert(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "out")
    ckpt = os.path.join(tmp_dir, "ckpt")
    write_file(os.path.join(raw, "a.json"), json.dumps({"time": 1784188215, "states": [vector("aaa", 1784188214)]}))
    run_incremental(spark, raw, "t_incremental", out, ckpt, "r1", None, out + "-rej")
    assert spark.table("t_incremental").count() == 1
    # nothing new: no batch, nothing changes
    run_incremental(spark, raw, "t_incremental", out, ckpt, "r2", None, out + "-rej")
    assert {r.processing_run_id for r in spark.table("t_incremental").collect()} == {"r1"}
    # a new file with one new and one edited key
    write_file(os.path.join(raw, "b.json"), json.dumps(
        {"time": 1784188215, "states": [vector("aaa", 1784188214, vel=99.0), vector("bbb", 1784188214)]}))
    # same response time and position 0 -> same key as aaa? No: icao differs, so key differs; aaa edited in place
    run_incremental(spark, raw, "t_incremental", out, ckpt, "r3", None, out + "-rej")
    rows = {r.icao24: (r.velocity_m_s, r.processing_run_id) for r in spark.table("t_incremental").collect()}
    assert rows == {"aaa": (99.0, "r3"), "bbb": (10.0, "r3")}


def test_replayed_first_batch_after_failed_write_creates(spark, tmp_dir):
    """A first batch that died mid-write leaves only ``_temporary``; the replay creates the data."""
    from aerolake.sources.raw_json import read_raw
    from aerolake.streaming.incremental import upsert_batch

    raw = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "out")
    os.makedirs(os.path.join(out, "_temporary", "0"))
    write_file(os.path.join(raw, "a.json"), json.dumps({"time": 1784188215, "states": [vector("aaa", 1784188214)]}))
    counts = upsert_batch(spark, read_raw(spark, raw), "t_replayed", out, "r1", None, out + "-rej")
    assert counts == {"insert": 1}
    assert spark.table("t_replayed").count() == 1
    # the next batch merges into what is now there
    assert upsert_batch(spark, read_raw(spark, raw), "t_replayed", out, "r2", None, out + "-rej") == {"noop": 1}


def test_rejects_and_corrupt_documents_are_kept_once(spark, tmp_dir):
    """One good, one NULL and one short vector and an unreadable document: a replay replaces its own audit rows."""
    from aerolake.sources.raw_json import read_raw
    from aerolake.streaming.incremental import upsert_batch

    raw, out, rej = (os.path.join(tmp_dir, x) for x in ("raw", "out", "rej"))
    write_file(os.path.join(raw, "a.json"), json.dumps({"time": 1784188215, "states": [vector("aaa", 1784188214), None, ["x"]]}))
    write_file(os.path.join(raw, "b.json"), '{"time": 1784188216, "states": [[')
    for _ in range(2):
        upsert_batch(spark, read_raw(spark, raw), "t_batch_rejects", out, "r1", None, rej, 4)
        audit = spark.read.parquet(rej).collect()
        assert sorted(r.rejection_reason for r in audit) == [
            "INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_1", "STATE_ARRAY_IS_NULL", "STATE_ARRAY_IS_NULL"]
        corrupt = [r for r in audit if r.payload_status == "CORRUPT_DOCUMENT"]
        assert len(corrupt) == 1 and corrupt[0].document_text.startswith('{"time": 1784188216')
        assert {r.batch_id for r in audit} == {4} and spark.table("t_batch_rejects").count() == 1
