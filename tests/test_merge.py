"""Merge rules, idempotence and the table-backed upsert (days can move)."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from aerolake.operators.dedupe import dedupe_by_key
from aerolake.operators.merge import classify_merge, merge_frames, merge_inserts, merge_changed
from aerolake.sinks.curated import create_curated_table, merge_into_table, check_table, table_exists, table_location
from aerolake.sinks.writers import create_table

SCHEMA = "record_key string, payload_hash string, v int, event_date date, processing_run_id string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_merge_rules(spark):
    target = frame(spark, [("k1", "h1", 1, D1, "r1"), ("k2", "h2", 2, D1, "r1"), ("k3", None, 3, D1, "r1")])
    source = frame(spark, [("k1", "h1", 10, D1, "r2"), ("k2", "h2x", 20, D1, "r2"),
                           ("k3", None, 30, D1, "r2"), ("k4", "h4", 40, D2, "r2")])
    actions = {r.record_key: r.action for r in classify_merge(target, source).collect()}
    assert actions == {"k1": "noop", "k2": "update", "k3": "noop", "k4": "insert"}
    merged = {r.record_key: (r.v, r.processing_run_id) for r in merge_frames(target, source).collect()}
    # no-op keeps the first writer's values and run id
    assert merged == {"k1": (1, "r1"), "k2": (20, "r2"), "k3": (3, "r1"), "k4": (40, "r2")}
    assert [r.record_key for r in merge_inserts(target, source).collect()] == ["k4"]
    assert [r.record_key for r in merge_changed(target, source).collect()] == ["k2"]


def test_keep_unmatched_target(spark):
    target = frame(spark, [("k1", "h1", 1, D1, "r1"), ("k9", "h9", 9, D3, "r1")])
    source = frame(spark, [("k1", "h1", 1, D1, "r2")])
    keys = sorted(r.record_key for r in merge_frames(target, source).collect())
    assert keys == ["k1", "k9"]


def test_idempotent_and_union_of_keys(spark):
    a = frame(spark, [(f"a{i}", f"h{i}", i, D1, "r1") for i in range(20)])
    b = frame(spark, [(f"a{i}", f"h{i}x" if i % 3 == 0 else f"h{i}", i, D2, "r2") for i in range(10, 30)])
    once = merge_frames(a, b)
    twice = merge_frames(once, b)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    keys = {r.record_key for r in once.collect()}
    assert keys == {f"a{i}" for i in range(30)}


def test_dedupe_deterministic(spark):
    rows = [("k", "hb", 1, D1, "f2"), ("k", "ha", 2, D1, "f9"), ("k", "ha", 3, D1, "f1"), ("j", None, 4, D1, "x")]
    df = spark.createDataFrame(rows, "record_key string, payload_hash string, v int, event_date date, source_file string")
    for parts in (1, 3, 8):
        out = {r.record_key: (r.payload_hash, r.source_file, r.v) for r in dedupe_by_key(df.repartition(parts)).collect()}
        assert out == {"k": ("ha", "f1", 3), "j": (None, "x", 4)}


def test_table_merge_moves_day_and_drops_emptied(spark, tmp_dir):
    name = "t_merge_move"
    path = os.path.join(tmp_dir, "curated")
    target = frame(spark, [("k1", "h1", 1, D1, "r1"), ("k2", "h2", 2, D2, "r1"), ("k3", "h3", 3, None, "r1")])
    create_curated_table(target, name, path)
    assert table_exists(spark, name)
    check_table(spark, name, "parquet")
    # k1 moves from D1 to D3 (time_position changed); D1 is left empty and must disappear.
    source = frame(spark, [("k1", "h1moved", 1, D3, "r2"), ("k4", "h4", 4, D2, "r2")])
    counts = merge_into_table(spark, name, source)
    # k2 shares the touched day D2, so it is carried through as "keep"
    assert counts == {"update": 1, "insert": 1, "keep": 1}
    rows = {r.record_key: r.event_date for r in spark.table(name).collect()}
    assert rows == {"k1": D3, "k2": D2, "k3": None, "k4": D2}
    assert not os.path.exists(os.path.join(path, "event_date=2024-01-01"))
    # only the touched days were re-synced: D3 registered, emptied D1 unregistered
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    assert parts == {"event_date=2024-01-02", "event_date=2024-01-03", "event_date=__HIVE_DEFAULT_PARTITION__"}
    # identical rerun is all no-op and leaves the table unchanged
    before = spark.table(name).collect()
    counts = merge_into_table(spark, name, source)
    assert counts == {"noop": 2, "keep": 1}
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == sorted(map(tuple, before), key=str)
    # null-day rows survive a merge that touches the null day
    merge_into_table(spark, name, frame(spark, [("k3", "h3", 3, None, "r3")]))
    assert spark.table(name).where(F.col("event_date").isNull()).count() == 1


class Stopped(Exception):
    pass


def _stop(*_, **__):
    raise Stopped


def _only(pick):
    """Partitions are pointed for some of the days, then the run dies."""
    from aerolake.sinks import curated

    whole = curated.point_partitions

    def partly(spark, name, pointers, days):
        whole(spark, name, pointers, pick(days))
        raise Stopped

    return partly


STEPS = {
    "data written, not recorded": ("DayPointers.record", lambda: _stop),
    "recorded, no partition pointed": ("point_partitions", lambda: _stop),
    "first day pointed": ("point_partitions", lambda: _only(lambda days: days[:1])),
    "last day pointed": ("point_partitions", lambda: _only(lambda days: days[-1:])),
    "all pointed, nothing removed": ("DayPointers.finish", lambda: _stop),
}


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("then", ["same batch", "new day", "old day", "both days", "catalog entry lost"])
def test_interrupted_merge_rolls_forward(spark, tmp_dir, monkeypatch, step, then):
    """k1 moves from D1 to D3 and the merge dies after each step: never a doubled key, never a lost update."""
    from aerolake.sinks import curated

    name = f"t_stop_{os.path.basename(tmp_dir).replace('-', '_')}"
    path = os.path.join(tmp_dir, "t")
    first = frame(spark, [("k1", "z", 1, D1, "r1"), ("k2", "h2", 2, D1, "r1"), ("k3", "h3", 3, D3, "r1")])
    curated.write_curated(spark, first, name, path)
    moved = frame(spark, [("k1", "zz-moved", 10, D3, "r2")])
    target, make = STEPS[step]
    with monkeypatch.context() as m:
        m.setattr(f"aerolake.sinks.curated.{target}", make())
        with pytest.raises(Stopped):
            merge_into_table(spark, name, moved)
    expected = {"k1": ("zz-moved", D3), "k2": ("h2", D1), "k3": ("h3", D3)}
    if step == "data written, not recorded" and then != "same batch":
        expected["k1"] = ("z", D1)  # never committed, and this batch does not bring it again
    rows = {"same batch": [("k1", "zz-moved", 10, D3, "r3")], "new day": [("k4", "h4", 4, D3, "r3")],
            "old day": [("k5", "h5", 5, D1, "r3")], "both days": [("k4", "h4", 4, D3, "r3"), ("k5", "h5", 5, D1, "r3")],
            "catalog entry lost": [("k6", "h6", 6, D2, "r3")]}[then]
    if then == "catalog entry lost":
        spark.sql(f"DROP TABLE {name}")
    for _ in range(2 if then == "same batch" else 1):
        curated.write_curated(spark, frame(spark, rows), name, path)
        got = sorted((r.record_key, r.payload_hash, r.event_date) for r in spark.table(name).collect())
        assert got == sorted((k, h, d) for k, (h, d) in (expected | {r[0]: (r[1], r[3]) for r in rows}).items())
    # what no partition points at is gone
    used = {r.path.split(path)[1].split("/")[1] for r in spark.table(name).selectExpr("_metadata.file_path path").collect()}
    left = {n for n in os.listdir(path) if n.startswith(("event_date=", curated.DATA_PREFIX))}
    assert {n for n in left if n.startswith("event_date=")} <= used
    assert len(left - used) <= 1


def test_table_merge_plan(spark, tmp_dir):
    """No full outer join of whole rows, no dedupe of the target, and the keys of a small batch are broadcast."""
    from aerolake.operators.merge import classify_source, merge_by_action
    from aerolake.plans.inspect import plan_text

    create_curated_table(frame(spark, [(f"k{i}", "h", i, D1, "r1") for i in range(500)]), "t_plan", os.path.join(tmp_dir, "t"))
    target, source = spark.table("t_plan"), frame(spark, [("k1", "x", 1, D1, "r2"), ("n", "x", 1, D1, "r2")])
    actions = classify_source(target, source).checkpoint()
    assert {r.record_key: r.action for r in actions.collect()} == {"k1": "update", "n": "insert"}
    merged = merge_by_action(target, source, actions)
    text = plan_text(merged, "simple")
    assert "FullOuter" not in text and "Aggregate" not in text
    assert "LeftAnti" in text and merged.count() == 501


def test_row_level_merge_routing(spark, tmp_dir):
    """Parquet tables take the DataFrame merge; the native MERGE path is only for table formats."""
    import pytest

    from aerolake.sinks.curated import ROW_LEVEL_MERGE_PROVIDERS, merge_into_row_level, table_provider

    create_curated_table(frame(spark, [("k1", "h1", 1, D1, "r1")]), "t_route", os.path.join(tmp_dir, "t"))
    assert table_provider(spark, "t_route") == "parquet" not in ROW_LEVEL_MERGE_PROVIDERS
    with pytest.raises(Exception):
        merge_into_row_level(frame(spark, [("k1", "h2", 2, D1, "r2")]), "t_route")


def test_dedupe_hot_key_third_of_rows(spark):
    """One key holds a third of all rows (many re-landed copies); exactly one deterministic survivor."""
    from pyspark.sql import functions as F

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("record_key"),
        F.concat(F.lit("h"), (F.col("id") % 7).cast("string")).alias("payload_hash"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("source_file"),
    ).repartition(16)
    out = dedupe_by_key(df)
    assert out.count() == n - n // 3 + 1
    hot = out.where("record_key = 'hot'").first()
    # smallest (payload_hash, source_file) among the hot copies: h0 with the smallest file name
    assert (hot.payload_hash, hot.source_file) == ("h0", "f0")


def test_unpartitioned_create_is_external_and_refuses_existing(spark, tmp_dir):
    name = "t_smoke_create"
    path = os.path.join(tmp_dir, "smoke")
    rows = spark.createDataFrame([(1, "TEST123", "Germany"), (2, "TEST456", "France")],
                                 "id int, callsign string, origin_country string")
    create_table(rows, name, path=path)
    check_table(spark, name, "parquet")
    assert table_location(spark, name).endswith(path)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "TEST123", "Germany"), (2, "TEST456", "France")]
    with pytest.raises(Exception):
        create_table(rows, name, path=path)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_KEYS = st.sampled_from([f"k{i}" for i in range(12)])
_HASHES = st.sampled_from(["h0", "h1", "h2", None])


@settings(max_examples=10, deadline=None)
@given(
    target=st.dictionaries(_KEYS, _HASHES, max_size=10),
    source=st.dictionaries(_KEYS, _HASHES, max_size=10),
    parts=st.sampled_from([1, 3, 7]),
)
def test_merge_matches_rule_model(spark, target, source, parts):
    """Random unique-key target/source against a plain model of the three rules; the key set is
    T ∪ S, reapplying the source is all no-op, and partitioning does not change the result."""
    t = frame(spark, [(k, h, 1, D1, "t") for k, h in target.items()]).repartition(parts)
    s = frame(spark, [(k, h, 2, D2, "s") for k, h in source.items()]).repartition(parts)
    expected = {}
    for k in set(target) | set(source):
        if k not in source:
            expected[k] = (target[k], "t")
        elif k not in target or target[k] != source[k]:
            expected[k] = (source[k], "s")
        else:
            expected[k] = (target[k], "t")  # no-op keeps the first writer
    once = merge_frames(t, s)
    got = {r.record_key: (r.payload_hash, r.processing_run_id) for r in once.collect()}
    assert got == expected
    actions = {r.action for r in classify_merge(once, s).collect()}
    assert actions <= {"noop", "keep"}
