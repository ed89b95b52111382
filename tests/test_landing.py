"""Landing validation codes, zero-byte handling and latest-object selection."""

from __future__ import annotations

import os
import time

import pytest

from aerolake.sources.landing import (
    classify_landed,
    latest_object,
    list_files,
    validate_latest,
)
from support import write_file

GOOD = '{"time": 1, "states": [["a"]]}'


def seed(base):
    files = {
        "ok.json": GOOD,
        "empty.json": b"",
        "bad_utf8.json": b'{"time": 1, "states": [["\xc3\x28"]]}',
        "truncated.json": '{"time": 1, "states": [["a"',
        "states_object.json": '{"time": 1, "states": {"a": 1}}',
        "states_empty.json": '{"time": 1, "states": []}',
        "top_list.json": "[1, 2]",
        "no_states.json": '{"time": 1}',
    }
    for name, body in files.items():
        write_file(os.path.join(base, "year=2026/month=07/day=21/hour=10", name), body)
    return files


def test_codes(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    seed(base)
    codes = {os.path.basename(r.path): r.code for r in classify_landed(spark, base).collect()}
    assert codes == {
        "ok.json": "OK",
        "empty.json": "EMPTY_OBJECT",
        "bad_utf8.json": "INVALID_UTF8",
        "truncated.json": "INVALID_JSON",
        "states_object.json": "STATES_NOT_LIST",
        "states_empty.json": "NO_STATES",
        "top_list.json": "STATES_NOT_LIST",
        "no_states.json": "STATES_NOT_LIST",
    }


def test_zero_byte_latest_is_not_hidden(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    write_file(os.path.join(base, "a.json"), GOOD)
    p = write_file(os.path.join(base, "b.json"), b"")
    os.utime(p, (time.time() + 100, time.time() + 100))
    assert os.path.basename(latest_object(list_files(spark, base)).first().path) == "b.json"
    with pytest.raises(RuntimeError, match="EMPTY_OBJECT"):
        validate_latest(spark, base)


def test_latest_tie_goes_to_first_path(spark, tmp_dir):
    base = os.path.join(tmp_dir, "raw")
    t = time.time()
    for n in ("c.json", "a.json", "b.json"):
        os.utime(write_file(os.path.join(base, n), GOOD), (t, t))
    assert validate_latest(spark, base).endswith("a.json")


def test_no_objects(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="NOTHING_LANDED"):
        validate_latest(spark, os.path.join(tmp_dir, "nothing"))


def test_incremental_check_skips_older_files(spark, tmp_dir):
    """Only files landed after the cut-off are listed and read (old junk is never opened)."""
    import datetime as dt

    base = os.path.join(tmp_dir, "raw")
    now = time.time()
    os.utime(write_file(os.path.join(base, "old_bad.json"), '{"time": 1, "sta'), (now - 7200, now - 7200))
    os.utime(write_file(os.path.join(base, "old_empty.json"), b""), (now - 7200, now - 7200))
    write_file(os.path.join(base, "new.json"), GOOD)
    cut = dt.datetime.fromtimestamp(now - 3600, tz=dt.timezone.utc)
    codes = {os.path.basename(r.path): r.code for r in classify_landed(spark, base, modified_after=cut).collect()}
    assert codes == {"new.json": "OK"}
    assert [os.path.basename(r.path) for r in list_files(spark, base, modified_after=cut).collect()] == ["new.json"]
    assert len(classify_landed(spark, base).collect()) == 3
    assert validate_latest(spark, base, modified_after=cut).endswith("new.json")
    with pytest.raises(RuntimeError, match="NOTHING_LANDED"):
        validate_latest(spark, base, modified_after=dt.datetime.fromtimestamp(now + 3600, tz=dt.timezone.utc))
