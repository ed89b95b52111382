"""FIXTURES §3: file-backed edge payloads, each under ANSI on and off."""

from __future__ import annotations

import os

import pytest

from aerolake.jobs import validated_rows
from aerolake.operators.project import curate
from aerolake.operators.validate import reconcile_counts, split_valid_rejected
from aerolake.operators.nested import light_transform
from aerolake.sources.raw_json import read_raw
from support import write_file

GOOD = '["abc123","CALL1  ","Germany","1784188214",1784188214,1.5,2.5,100.0,false,10.0,90.0,0.5,[1,2,30],110.0,"0021",false,0]'


def vec(**over):
    vals = ['"abc123"', '"CALL1  "', '"Germany"', "1784188214", "1784188214", "1.5", "2.5", "100.0", "false",
            "10.0", "90.0", "0.5", "[1,2,30]", "110.0", '"0021"', "false", "0"]
    for i, v in over.items():
        vals[int(i[1:])] = v
    return "[" + ",".join(vals) + "]"


def run(spark, tmp_dir, body: str, name="doc.json"):
    path = write_file(os.path.join(tmp_dir, name), body)
    rows = validated_rows(spark, path)
    valid, rejected = split_valid_rejected(rows)
    return rows, valid, rejected


def test_good_vector(spark, ansi, tmp_dir):
    _, valid, rejected = run(spark, tmp_dir, f'{{"time": 1784188215, "states": [{GOOD}]}}')
    assert valid.count() == 1 and rejected.count() == 0


def test_null_element_keeps_position(spark, ansi, tmp_dir):
    _, valid, rejected = run(spark, tmp_dir, f'{{"time": 1, "states": [{GOOD}, null, {GOOD}]}}')
    r = rejected.collect()
    assert valid.count() == 2
    assert [(x.state_position, x.rejection_reason, x.field_count) for x in r] == [(1, "STATE_ARRAY_IS_NULL", -1)]


@pytest.mark.parametrize("n", [16, 18, 0])
def test_field_counts(spark, ansi, tmp_dir, n):
    items = [f'"v{i}"' for i in range(n)]
    _, valid, rejected = run(spark, tmp_dir, f'{{"time": 1, "states": [[{",".join(items)}]]}}')
    assert valid.count() == 0
    assert rejected.first().rejection_reason == f"INVALID_FIELD_COUNT_EXPECTED_17_ACTUAL_{n}"


@pytest.mark.parametrize("states", ["null", "[]", '"str"'])
def test_states_null_empty_or_string(spark, ansi, tmp_dir, states):
    rows, valid, rejected = run(spark, tmp_dir, f'{{"time": 5, "states": {states}}}')
    r = rejected.collect()
    assert valid.count() == 0 and len(r) == 1
    assert r[0].state_position is None and r[0].rejection_reason == "STATE_ARRAY_IS_NULL"
    assert r[0].source_response_time == 5


@pytest.mark.parametrize("odd", ['"oops"', "42", '{"a": 1}'])
def test_odd_element_only_that_one_rejected(spark, ansi, tmp_dir, odd):
    _, valid, rejected = run(spark, tmp_dir, f'{{"time": 1, "states": [{GOOD}, {odd}, {GOOD}]}}')
    assert valid.count() == 2
    r = rejected.collect()
    assert [(x.state_position, x.rejection_reason) for x in r] == [(1, "STATE_ARRAY_IS_NULL")]
    assert r[0].state_raw is not None


def test_truncated_document(spark, ansi, tmp_dir):
    path = write_file(os.path.join(tmp_dir, "bad.json"), '{"time": 1, "states": [["a", "b"')
    raw = read_raw(spark, path).collect()
    assert len(raw) == 1 and raw[0]._corrupt_record is not None
    rows = validated_rows(spark, path)
    _, rejected = split_valid_rejected(rows)
    r = rejected.collect()
    assert len(r) == 1 and r[0].source_response_time is None
    assert r[0].rejection_reason == "STATE_ARRAY_IS_NULL"


def test_time_missing(spark, ansi, tmp_dir):
    _, valid, _ = run(spark, tmp_dir, f'{{"states": [{GOOD}, {GOOD}]}}')
    rows = valid.collect()
    assert len(rows) == 2 and all(r.source_response_time is None for r in rows)


def test_lenient_casts(spark, ansi, tmp_dir):
    body = vec(i4='"1784188214.0"', i3='"notanum"', i8='"maybe"', i12='"oops"')
    _, valid, _ = run(spark, tmp_dir, f'{{"time": 1784188215, "states": [{body}]}}')
    row = curate(valid, "r", None).first()
    assert row.last_contact == 1784188214
    assert row.time_position is None
    assert row.on_ground is None
    assert row.sensors is None
    assert row.event_timestamp_epoch == 1784188214  # falls back to last_contact


@pytest.mark.parametrize("sensors,expected", [("[1,2,30]", [1, 2, 30]), ('[1,"x"]', None), ('"oops"', None)])
def test_sensors(spark, ansi, tmp_dir, sensors, expected):
    _, valid, _ = run(spark, tmp_dir, f'{{"time": 1, "states": [{vec(i12=sensors)}]}}')
    assert curate(valid, "r", None).first().sensors == expected


@pytest.mark.parametrize("callsign,expected", [('""', ""), ('"  "', ""), ('"\\t a "', "\t a"), ("null", None)])
def test_callsign_trim(spark, ansi, tmp_dir, callsign, expected):
    _, valid, _ = run(spark, tmp_dir, f'{{"time": 1, "states": [{vec(i1=callsign)}]}}')
    assert curate(valid, "r", None).first().callsign == expected


def test_squawk_leading_zeros(spark, ansi, tmp_dir):
    _, valid, _ = run(spark, tmp_dir, f'{{"time": 1, "states": [{GOOD}]}}')
    assert curate(valid, "r", None).first().squawk == "0021"


def test_all_epochs_null(spark, ansi, tmp_dir):
    body = vec(i3="null", i4="null")
    path = write_file(os.path.join(tmp_dir, "d.json"), f'{{"states": [{body}]}}')
    valid, _ = split_valid_rejected(validated_rows(spark, path))
    row = curate(valid, "r", None).first()
    assert row.event_timestamp is None and row.event_date is None


def test_reconciliation_balanced(spark, ansi, tmp_dir):
    body = f'{{"time": 1, "states": [{GOOD}, null, ["a"], {GOOD}]}}'
    rows, _, _ = run(spark, tmp_dir, body)
    r = reconcile_counts(rows).first()
    assert (r.raw_count, r.valid_count, r.rejected_count, r.balanced) == (4, 2, 2, True)


def test_prefix_read_has_partition_columns(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    write_file(os.path.join(base, "year=2026/month=07/day=21/hour=10/a.json"), f'{{"time": 1, "states": [{GOOD}]}}')
    write_file(os.path.join(base, "year=2026/month=07/day=21/hour=11/b.json"), f'{{"time": 2, "states": [{GOOD}]}}')
    df = read_raw(spark, base)
    assert {"year", "month", "day", "hour"} <= set(df.columns)
    from aerolake.sources.raw_json import read_raw_partition

    one = read_raw_partition(spark, base, year=2026, month=7, day=21, hour=11)
    assert [r.time for r in one.collect()] == [2]


def test_light_transform(spark, ansi, tmp_dir):
    body = f'{{"time": 9, "states": [{vec(i1=chr(34) + "  AB1 " + chr(34))}, null, ["x"], {GOOD}]}}'
    path = write_file(os.path.join(tmp_dir, "d.json"), body)
    from aerolake.operators.explode import parse_state_elements

    docs = parse_state_elements(read_raw(spark, path))
    r = light_transform(docs).first()
    assert (r.record_count, r.skipped_count, r.error) == (2, 2, None)
    assert r.states[0].callsign == "AB1" and r.states[0].spi == "false"
    assert r.states[0].source_response_time == 9


def test_light_transform_missing_states(spark, ansi, tmp_dir):
    path = write_file(os.path.join(tmp_dir, "d.json"), '{"time": 9}')
    from aerolake.operators.explode import parse_state_elements

    docs = parse_state_elements(read_raw(spark, path))
    r = light_transform(docs).first()
    assert (r.error, r.record_count, r.skipped_count) == ("MISSING_STATES", None, None)
    empty = parse_state_elements(read_raw(spark, write_file(os.path.join(tmp_dir, "e.json"), '{"time": 9, "states": []}')))
    r = light_transform(empty).first()
    assert (r.record_count, r.error) == (0, None)
    with pytest.raises(Exception):
        light_transform(docs, fail_on_missing=True).collect()


def test_type_conversion_failures_flagged(spark, ansi, tmp_dir):
    from aerolake.operators.quality import violation_summary, with_cast_failures, with_violations

    bad = vec(i4='"1784188214.0"', i3='"notanum"', i8='"maybe"', i12='"oops"')
    _, valid, _ = run(spark, tmp_dir, f'{{"time": 1784188215, "states": [{bad}, {GOOD}]}}')
    cur = curate(with_cast_failures(valid), "r", None, keep=("cast_failures",))
    rows = {r.state_position: (r.cast_failures, r.violations) for r in with_violations(cur).collect()}
    # "1784188214.0" still converts (lenient long); NULL text is not a failure
    assert rows[0][0] == ["time_position", "on_ground", "sensors"]
    assert "TYPE_CONVERSION_FAILED" in rows[0][1]
    assert rows[1] == ([], [])
    summary = {r.rule: r.n for r in violation_summary(cur).collect()}
    assert summary["TYPE_CONVERSION_FAILED"] == 1
    assert cur.columns[-1] == "cast_failures" and "cast_failures" not in curate(valid, "r", None).columns


def test_array_text_in_a_string_is_no_array(spark, ansi, tmp_dir):
    """``states`` as a JSON string that holds the text of a good array: one rejected row."""
    import json

    _, valid, rejected = run(spark, tmp_dir, json.dumps({"time": 5, "states": f"[{GOOD}]"}))
    r = rejected.collect()
    assert valid.count() == 0 and [(x.state_position, x.rejection_reason, x.source_response_time) for x in r] == [(None, "STATE_ARRAY_IS_NULL", 5)]
