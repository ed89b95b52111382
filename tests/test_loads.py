"""Checks around a load, the zone map, staged scratch data, the admission gate and incremental discovery."""

from __future__ import annotations

import datetime as dt
import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from aerolake.jobs import run_curated, run_latest, run_processed
from aerolake.operators.dedupe import dedupe_by_key, dedupe_repeated
from aerolake.plans.inspect import partition_filters, plan_text
from aerolake.session import checkpoint_root, scratch_path, scratch_scope, staged
from aerolake.sinks import curated
from aerolake.sinks.landing import land_documents
from aerolake.sources.landing import list_files
from aerolake.sources.tables import listed_partitions, register_parquet_table, sync_partitions
from aerolake.streaming.incremental import run_incremental
from support import write_file

T0 = 1784188215
HOUR = "year=2026/month=07/day=16/hour=07"


def vector(icao, t, vel=10.0, lat=2.0):
    return [icao, "CS1 ", "X", t, t, 1.0, lat, 100.0, False, vel, 90.0, 0.0, None, 110.0, "0001", False, 0]


def land(base, name, time_, states):
    return write_file(os.path.join(base, HOUR, name), json.dumps({"time": time_, "states": states}))


def scratch_content(spark):
    root = pathlib.Path(checkpoint_root(spark).replace("file:", ""))
    return {str(p) for p in root.rglob("*")}


def test_jobs_leave_no_scratch_data(spark, tmp_dir):
    """Checkpoint and scratch folders are as before after each job, also after one that fails."""
    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    land(raw, "a.json", T0, [vector("aaa", T0), vector("bbb", T0), None])
    before = scratch_content(spark)
    for _ in range(2):  # create, then merge
        run_curated(spark, raw, "loads_scratch", rej, os.path.join(tmp_dir, "cur"), dq={"VELOCITY_NEGATIVE": "quarantine"})
    run_processed(spark, raw, os.path.join(tmp_dir, "processed"), rej + "2")
    run_incremental(spark, raw, "loads_scratch_inc", os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "ck"), "r", None, rej + "3")
    run_latest(spark, raw, "loads_scratch_latest", rej, os.path.join(tmp_dir, "cur2"))
    land(raw + "x", "a.json", T0, [None])
    with pytest.raises(RuntimeError, match="NO_VALID_VECTORS"):
        run_curated(spark, raw + "x", "loads_scratch_none", rej, os.path.join(tmp_dir, "cur3"))
    left = {p for p in scratch_content(spark) - before if os.path.isfile(p) and "file-log" not in p}
    assert left == set()


def test_scratch_scope_deletes_on_error(spark):
    with pytest.raises(ValueError):
        with scratch_scope(spark) as paths:
            spark.range(3).write.parquet(scratch_path(spark, "t"))
            raise ValueError
    assert paths and not os.path.exists(paths[0].replace("file:", ""))


def test_data_quality_actions(spark, tmp_dir):
    raw, rej = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "rej")
    land(raw, "a.json", T0, [vector("aaa", T0), vector("bbb", T0, vel=-1.0), vector("ccc", T0, lat=95.0), vector(None, T0), ["x"]])
    run = run_curated(spark, raw, "loads_dq", rej, os.path.join(tmp_dir, "cur"), run_id="r",
                      dq={"LATITUDE_OUT_OF_RANGE": "quarantine", "ICAO24_MISSING": "quarantine", "VELOCITY_NEGATIVE": "flag"})
    assert (run.raw_count, run.valid_count, run.rejected_count, run.quarantined_count, run.balanced) == (5, 2, 1, 2, True)
    assert run.flagged == {"VELOCITY_NEGATIVE": 1} and {r.icao24 for r in spark.table("loads_dq").collect()} == {"aaa", "bbb"}
    audit = {r.rejection_reason: r.state_raw for r in spark.read.parquet(rej).collect()}
    assert set(audit) == {"DQ_LATITUDE_OUT_OF_RANGE", "DQ_ICAO24_MISSING", "INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_1"}
    assert json.loads(audit["DQ_LATITUDE_OUT_OF_RANGE"])[0] == "ccc"
    with pytest.raises(ValueError, match="DQ_ACTIONS"):
        run_curated(spark, raw, "loads_dq", rej, dq={"LATITUDE_OUT_OF_RANGE": "drop"})


def test_preflight(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    land(raw, "a.json", T0, [vector("aaa", T0)])
    with pytest.raises(RuntimeError, match="NAMESPACE_MISSING"):
        run_curated(spark, raw, "no_such_space.t", os.path.join(tmp_dir, "rej"))
    spark.range(1).write.format("parquet").option("path", os.path.join(tmp_dir, "other")).saveAsTable("loads_other")
    with pytest.raises(RuntimeError, match="TABLE_NOT_MERGEABLE"):
        run_curated(spark, raw, "loads_other", os.path.join(tmp_dir, "rej"))
    assert not os.path.exists(os.path.join(tmp_dir, "rej"))


def test_post_load_finds_each_broken_condition(spark, tmp_dir):
    raw, name, path = os.path.join(tmp_dir, "raw"), "loads_verify", os.path.join(tmp_dir, "cur")
    land(raw, "a.json", T0, [vector("aaa", T0), vector("bbb", T0)])
    run_curated(spark, raw, name, os.path.join(tmp_dir, "rej"), path, run_id="r1")
    land(raw, "b.json", T0, [vector("aaa", T0, vel=11.0), vector("ccc", T0 - 86400)])
    run_curated(spark, raw, name, os.path.join(tmp_dir, "rej"), run_id="r2")
    # what is still the first writer's row counts for it, the merged ones for the second
    rows = spark.table(name).where("processing_run_id = 'r2'").count()
    curated.verify_load(spark, name, "r2", rows)
    with pytest.raises(RuntimeError, match="ROWS_MISSING"):
        curated.verify_load(spark, name, "r2", rows + 1)
    with pytest.raises(RuntimeError, match="TABLE_MISSING"):
        curated.verify_load(spark, "loads_nothing", "r2", 0)
    day = curated.DayPointers(spark, curated.table_location(spark, name)).switch[0]
    spec = curated.partition_spec(day)
    place = curated.partition_location(spark, name, day)
    spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{path}/elsewhere'")
    with pytest.raises(RuntimeError, match="PARTITIONS_DIFFER"):
        curated.verify_load(spark, name, "r2", 0)
    spark.sql(f"ALTER TABLE {name} DROP {spec}")
    with pytest.raises(RuntimeError, match="PARTITIONS_DIFFER"):
        curated.verify_load(spark, name, "r2", 0)
    spark.sql(f"ALTER TABLE {name} ADD {spec} LOCATION '{place}'")
    curated.verify_load(spark, name, "r2", rows)
    pointers = curated.DayPointers(spark, curated.table_location(spark, name))
    pointers._rename(pointers._file(pointers.name), f"{pointers.number}.pending")
    with pytest.raises(RuntimeError, match="LOAD_NOT_FINISHED"):
        curated.verify_load(spark, name, "r2", 0)


ZONED = "record_key string, payload_hash string, source_response_time bigint, event_date date"


def zoned_rows(n, start=0):
    day = dt.date(2023, 11, 14)
    return [(f"k{i}", f"h{i}", 1_699_920_000 + i * 3600, day + dt.timedelta(days=i // 24)) for i in range(start, start + n)]


def test_zone_map_prunes_the_moved_key_probe(spark, tmp_dir):
    """The probe opens only days whose zones meet the batch; a key moved by 20 days is found; a lost map is rebuilt."""
    name, path = "loads_zones", os.path.join(tmp_dir, "t")
    curated.write_curated(spark, spark.createDataFrame(zoned_rows(24 * 40), ZONED), name, path)
    far = dt.date(2023, 12, 4)
    curated.merge_into_table(spark, name, spark.createDataFrame([("k5", "moved", 1_699_920_000 + 5 * 3600, far)], ZONED))
    pointers = curated.DayPointers(spark, curated.table_location(spark, name))
    zones = curated.zone_map(spark, name, pointers)
    first = 1_699_920_000 // 86400
    assert sorted(zones[f"event_date={far}"]) == [first, first + 20] and zones["event_date=2023-11-20"] == [first + 6]
    assert set(pointers.zones) == set(zones)
    # the moved row comes back to its old day: only the two days of its response day are probed
    back = spark.createDataFrame([("k5", "back", 1_699_920_000 + 5 * 3600, dt.date(2023, 11, 14))], ZONED)
    probe = curated.touched_days_frame(spark.table(name), back, zones=zones)
    pruned = " ".join(partition_filters(probe))
    assert str(far) in pruned or str((far - dt.date(1970, 1, 1)).days) in pruned
    assert "2023-11-20" not in pruned and str((dt.date(2023, 11, 20) - dt.date(1970, 1, 1)).days) not in pruned
    for lost in (False, True):
        if lost:
            files = list(pathlib.Path(path, curated.POINTERS).glob("*.done"))
            state = json.loads(files[0].read_text())
            files[0].write_text(json.dumps({k: v for k, v in state.items() if k != "zones"}))
            for crc in pathlib.Path(path, curated.POINTERS).glob(".*.crc"):
                crc.rename(crc.with_suffix(".old"))
        counts = curated.merge_into_table(spark, name, back)
        assert counts.get("update", 0) == (0 if lost else 1)
        assert [r.event_date for r in spark.table(name).where("record_key = 'k5'").collect()] == [dt.date(2023, 11, 14)]
        assert set(curated.DayPointers(spark, curated.table_location(spark, name)).zones) == listed_partitions(spark, name)


def test_dedupe_in_two_phases(spark):
    """The same rows as the single aggregate; unique rows are neither sorted nor aggregated at full width."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("record_key"),
        F.concat(F.lit("h"), (F.col("id") % 7).cast("string")).alias("payload_hash"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("source_file"), F.col("id").alias("v")).repartition(8)
    want, got = dedupe_by_key(df), dedupe_repeated(df)
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    once = plan_text(got, "simple").split("Union", 1)[1].split("SortAggregate", 1)[0]
    assert "LeftAnti" in once and "HashAggregate" in once


def test_dedupe_shuffles_whole_rows_of_repeated_keys_alone(spark):
    """However many keys there are: the joins go by the repeated ones, once those are written."""
    rows = [(f"k{i % 29990}", f"h{i % 7}", f"f{i}", f"wide{i}") for i in range(30000)]
    df = staged(spark.createDataFrame(rows, "record_key string, payload_hash string, source_file string, wide string"), "wide-rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4kb")  # 30000 keys are too many to broadcast, 10 are not
    try:
        want, got = dedupe_by_key(df), dedupe_repeated(df, written=lambda keys: staged(keys, "repeated-keys"))
        assert got.count() == 29990 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        plan = plan_text(got, "simple")
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
        assert "SortMergeJoin" in plan_text(dedupe_repeated(df), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_gate_quarantines_and_merges_once(spark, tmp_dir):
    raw, held, ck = (os.path.join(tmp_dir, x) for x in ("raw", "held", "ck"))
    land(raw, "ok.json", T0, [vector("aaa", T0), None])
    write_file(os.path.join(raw, HOUR, "empty.json"), b"")
    write_file(os.path.join(raw, HOUR, "cut.json"), '{"time": 1, "sta')
    args = ("loads_gate", os.path.join(tmp_dir, "out"), ck, "r", None, os.path.join(tmp_dir, "rej"))
    run_incremental(spark, raw, *args, quarantine_path=held)
    land(raw, "late.json", T0, [vector("bbb", T0)])
    write_file(os.path.join(raw, HOUR, "late_empty.json"), b"")
    run_incremental(spark, raw, *args, quarantine_path=held)
    found = {(r.batch_id, os.path.basename(r.uri), r.code, r.length) for r in spark.read.parquet(held).collect()}
    assert found == {(0, "empty.json", "EMPTY_OBJECT", 0), (0, "cut.json", "INVALID_JSON", 16), (1, "late_empty.json", "EMPTY_OBJECT", 0)}
    assert {r.icao24 for r in spark.table("loads_gate").collect()} == {"aaa", "bbb"}


def test_latest_object_is_loaded_alone(spark, tmp_dir):
    import time

    raw = os.path.join(tmp_dir, "raw")
    land(raw, "a.json", T0, [vector("aaa", T0)])
    newest = land(raw, "b.json", T0 + 60, [vector("bbb", T0)])
    os.utime(newest, (time.time() + 50,) * 2)
    run = run_latest(spark, raw, "loads_latest", os.path.join(tmp_dir, "rej"), os.path.join(tmp_dir, "cur"))
    assert run.valid_count == 1 and [r.icao24 for r in spark.table("loads_latest").collect()] == ["bbb"]
    write_file(newest, "{")
    os.utime(newest, (time.time() + 90,) * 2)
    with pytest.raises(RuntimeError, match="LATEST_NOT_ADMITTED .INVALID_JSON."):
        run_latest(spark, raw, "loads_latest", os.path.join(tmp_dir, "rej"))


def test_objects_land_under_their_keys_unchanged(spark, tmp_dir):
    base = os.path.join(tmp_dir, "bucket")
    docs = spark.createDataFrame([(T0, '{"a": 1}'), (T0 + 3600, ""), (T0 + 7200, None), (T0 + 10800, "é\n")], "t long, body string")
    for _ in range(2):  # a replay lands the same bytes again
        land_documents(docs.repartition(3), base, F.timestamp_seconds("t"), F.col("body"))
    found = {p.relative_to(base).as_posix(): p.read_bytes() for p in pathlib.Path(base).rglob("*") if p.is_file()}
    assert found == {
        "raw/opensky/states/year=2026/month=07/day=16/hour=07/20260716T075015Z.json": b'{"a": 1}',
        "raw/opensky/states/year=2026/month=07/day=16/hour=08/20260716T085015Z.json": b"",
        "raw/opensky/states/year=2026/month=07/day=16/hour=09/20260716T095015Z.json": b"",
        "raw/opensky/states/year=2026/month=07/day=16/hour=10/20260716T105015Z.json": "é\n".encode()}
    assert sorted(r.length for r in list_files(spark, base).collect()) == [0, 0, 3, 8]
    with pytest.raises(Exception, match="LANDING_KEY_CLASH"):
        land_documents(docs.withColumn("body", F.lit("other")), base, F.timestamp_seconds("t"), F.col("body"))


def test_odd_file_names_are_listed(spark, tmp_dir):
    for name in ("a b.json", "c%20+d.json", "é.json"):
        write_file(os.path.join(tmp_dir, "raw", name), "{}")
        write_file(os.path.join(tmp_dir, "raw", "zero " + name), b"")
    got = {(os.path.basename(r.path), r.length) for r in list_files(spark, os.path.join(tmp_dir, "raw")).collect()}
    assert got == {(n, 2) for n in ("a b.json", "c%20+d.json", "é.json")} | {("zero " + n, 0) for n in ("a b.json", "c%20+d.json", "é.json")}


def test_discovery_touches_new_and_vanished_days_only(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(6).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("event_date"), F.lit("a b/c'd").alias("tag"))
    rows.where("id < 3").write.partitionBy("event_date", "tag").parquet(path)
    assert register_parquet_table(spark, "loads_found", path).count() == 3
    said = []
    run = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), run(self, text, *a, **k))[1])
    assert sync_partitions(spark, "loads_found", path) == ([], []) and not any("ALTER" in t or "MSCK" in t for t in said)
    rows.where("id >= 3").write.mode("append").partitionBy("event_date", "tag").parquet(path)
    gone = os.path.join(path, "event_date=2024-01-02")
    os.rename(gone, os.path.join(tmp_dir, "moved"))
    new, dropped = sync_partitions(spark, "loads_found", path)
    assert [n[:21] for n in new] == [f"event_date=2024-01-0{d}" for d in (4, 5, 6)] and [d[:21] for d in dropped] == ["event_date=2024-01-02"]
    altered = " ".join(t for t in said if "ALTER" in t)
    assert "2024-01-01" not in altered and "2024-01-03" not in altered and not any("MSCK" in t for t in said)
    assert sorted(r.id for r in spark.table("loads_found").collect()) == [0, 2, 3, 4, 5]


def test_no_path_list_in_python():
    """The landing check never brings the listed or scanned paths into Python, and nothing repairs whole tables."""
    root = pathlib.Path(__file__).resolve().parent.parent / "aerolake"
    for module in ("sources/landing.py", "sources/tables.py", "sinks/curated.py", "streaming/incremental.py"):
        text = (root / module).read_text()
        assert "inputFiles(" not in text and "MSCK" not in text
        assert module != "sources/landing.py" or ".collect()" not in text
