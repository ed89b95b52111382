"""End-to-end job wrappers on file-landed documents (first run, rerun, empty batch)."""

from __future__ import annotations

import json
import os

import pytest

from aerolake.jobs import run_curated, run_processed
from support import write_file


def vector(icao, t, vel=10.0):
    return [icao, "CS1 ", "X", t, t, 1.0, 2.0, 100.0, False, vel, 90.0, 0.0, None, 110.0, "0001", False, 0]


def land(base, name, time_, states):
    return write_file(os.path.join(base, "year=2026/month=07/day=16/hour=07", name),
                      json.dumps({"time": time_, "states": states}))


def test_curated_create_then_idempotent_rerun_then_update(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    rej = os.path.join(tmp_dir, "rejected")
    name = "curated_job_t1"
    tpath = os.path.join(tmp_dir, "curated")
    land(raw, "a.json", 1784188215, [vector("aaa", 1784188214), vector("bbb", 1784188200), None, ["short"]])
    s1 = run_curated(spark, raw, name, rej, tpath, run_id="run1")
    assert (s1.raw_count, s1.valid_count, s1.rejected_count, s1.balanced) == (4, 2, 2, True)
    assert spark.table(name).count() == 2
    assert spark.read.parquet(rej).count() == 2
    # same payload landed twice (another file): one curated row per key, all no-op
    land(raw, "a_copy.json", 1784188215, [vector("aaa", 1784188214), vector("bbb", 1784188200), None, ["short"]])
    s2 = run_curated(spark, raw, name, rej, run_id="run2")
    assert s2.actions.get("noop") == 2 and "update" not in s2.actions and "insert" not in s2.actions
    rows = spark.table(name).collect()
    assert len(rows) == 2 and {r.processing_run_id for r in rows} == {"run1"}
    # reject audit is append-only: every run adds its audit rows
    assert spark.read.parquet(rej).count() == 2 + 4


def test_changed_payload_updates(spark, tmp_dir):
    raw1 = os.path.join(tmp_dir, "raw1")
    raw2 = os.path.join(tmp_dir, "raw2")
    name = "curated_job_t2"
    land(raw1, "a.json", 1784188215, [vector("aaa", 1784188214, vel=10.0)])
    run_curated(spark, raw1, name, os.path.join(tmp_dir, "rej"), os.path.join(tmp_dir, "cur"), run_id="r1")
    h1 = spark.table(name).first().payload_hash
    land(raw2, "a.json", 1784188215, [vector("aaa", 1784188214, vel=11.0)])
    s = run_curated(spark, raw2, name, os.path.join(tmp_dir, "rej"), run_id="r2")
    assert s.actions == {"update": 1}
    row = spark.table(name).first()
    assert row.velocity_m_s == 11.0 and row.payload_hash != h1 and row.processing_run_id == "r2"


def test_no_valid_rows_raises_after_writing_rejects(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    rej = os.path.join(tmp_dir, "rejected")
    land(raw, "bad.json", 1784188215, [None, ["x"]])
    with pytest.raises(RuntimeError, match="NO_VALID_VECTORS"):
        run_curated(spark, raw, "curated_job_t3", rej, os.path.join(tmp_dir, "cur"))
    assert spark.read.parquet(rej).count() == 2


def test_processed_job(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    land(raw, "a.json", 1784188215, [vector("aaa", 1784188214), vector("bbb", 1784100000), None])
    out = os.path.join(tmp_dir, "processed")
    s = run_processed(spark, raw, out, os.path.join(tmp_dir, "rej"))
    assert (s.valid_count, s.rejected_count) == (2, 1)
    days = sorted(str(r.event_date) for r in spark.read.parquet(out).select("event_date").collect())
    assert days == ["2026-07-15", "2026-07-16"]
    assert "record_key" not in spark.read.parquet(out).columns


def test_lost_catalog_entry_reregisters_and_merges(spark, tmp_dir):
    """The table folder outlives its catalog entry: the next run registers it again and merges."""
    raw1 = os.path.join(tmp_dir, "raw1")
    raw2 = os.path.join(tmp_dir, "raw2")
    name = "curated_job_t5"
    tpath = os.path.join(tmp_dir, "cur")
    land(raw1, "a.json", 1784188215, [vector("aaa", 1784188214), vector("bbb", 1784188214)])
    run_curated(spark, raw1, name, os.path.join(tmp_dir, "rej"), tpath, run_id="r1")
    spark.sql(f"DROP TABLE {name}")  # external table: the files stay
    land(raw2, "a.json", 1784188215, [vector("aaa", 1784188214, vel=11.0)])
    s = run_curated(spark, raw2, name, os.path.join(tmp_dir, "rej"), tpath, run_id="r2")
    assert s.actions == {"update": 1, "keep": 1}
    rows = {r.icao24: (r.velocity_m_s, r.processing_run_id) for r in spark.table(name).collect()}
    assert rows == {"aaa": (11.0, "r2"), "bbb": (10.0, "r1")}
