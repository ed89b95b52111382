"""License scans and URL lists."""

from __future__ import annotations

import datetime as dt
import os
import sys

import numpy as np
import pytest
from llm_cases import HARD, hard_docs, no_docs
from pyspark.sql import functions as F

from aerolake.llm import license_scan as P
from aerolake.llm import url_lists as U
from aerolake.llm.oracle import ORACLE_SQL
from aerolake.llm.queries import QUERIES, op1_license_scan
from aerolake.plans.inspect import assert_no_python

SF = "/root/testdata/sf0.01"
LINES = {"Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Licensed under the Apache License, Version 2.0.": "apache-2.0",
         "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "Released under the MIT License.": "mit"}


def test_every_license_line_is_found_and_nothing_else(spark):
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want[r["doc_id"]] = sorted(v for k, v in LINES.items() for _ in range(r["text"].count(k)))
    got = {i: [] for i in want}
    for r in op1_license_scan(spark, SF).collect():
        if r["license"]:
            got[r["doc_id"]].append(r["license"])
    assert sum(map(len, want.values())) > 10 and {k: sorted(v) for k, v in got.items()} == want


def plain_subsequence(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        before = best[:]
        for j, y in enumerate(b):
            best[j + 1] = max(best[j], before[j + 1], before[j] + (x == y))
    return best[-1]


def test_alignment_is_a_common_subsequence():
    a, b = "x a b c d y e f g z".split(), "a b q c d e f g".split()
    pairs = P.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs))
    assert len(pairs) == plain_subsequence(a, b) == 7
    assert P.align([], b) == P.align(a, []) == []


def test_edited_repeated_and_adjacent_notices():
    scan = P.Scanner(P.TEMPLATES).scan
    mit = P.TEMPLATES["mit-text"]
    edited = mit.replace("associated", "related").replace("free of charge", "free of any charge")
    text = "lorem " * 500 + mit + " ipsum the of and " * 300 + edited + " dolor " + mit + " " + mit
    got = scan(text)
    assert [x[0] for x in got] == ["mit-text"] * 4 and [x[1] == 1 for x in got] == [True, False, True, True]
    assert got[0][2] == 500 and got[0][3] == 500 + len(P.words_of(mit))
    assert scan("the license under version 2 of the software and the public work") == []


def test_dense_insertions_are_covered_like_the_whole_text():
    """Whatever is inserted or left out, a notice that stands alone is covered as by aligning the whole text."""
    rng = np.random.default_rng(9)
    scanner = P.Scanner(P.TEMPLATES)
    for _ in range(300):
        name = sorted(P.TEMPLATES)[rng.integers(len(P.TEMPLATES))]
        template = P.words_of(P.TEMPLATES[name])
        step, words = int(rng.integers(1, 5)), []
        for k, w in enumerate(template):
            if rng.random() < 0.05:
                continue
            words.append(w)
            if step < 4 and k % step == 0:
                words.append(f"filler{rng.integers(10**6)}")
        pairs = P.align(words, template)
        got = [x for x in scanner.scan(" ".join([f"pre{i}" for i in range(40)] + words + [f"post{i}" for i in range(40)])) if x[0] == name]
        if len(pairs) >= 0.8 * len(template) - 1e-9:
            assert [x[1] for x in got] == [pytest.approx(len(pairs) / len(template))], (name, words)
        else:
            assert got == []


def test_a_stretch_without_any_match_grows_like_the_others():
    """Words that stand twice in a stretch, and at neither end of it, match nothing there; a wider one may match other words."""
    scan = P.Scanner({"mit": P.TEMPLATES["mit"]}).scan
    assert scan("mit x mit x x x x x x license") == []
    assert scan("mit x mit x x x released under the mit license") == [("mit", 1.0, 6, 11, 5)]
    rng = np.random.default_rng(4)
    scanner, words = P.Scanner(P.TEMPLATES), sorted({w for t in P.TEMPLATES.values() for w in P.words_of(t)}) + ["x"] * 20
    for _ in range(400):
        text = [words[k] for k in rng.integers(len(words), size=60)]
        found = scanner.scan(" ".join(text))
        assert all(lo < hi and n >= 0.8 * len(P.words_of(P.TEMPLATES[k])) - 1e-9 for k, _, lo, hi, n in found)
        size = len(P.words_of(P.TEMPLATES["mit-text"]))
        got = scanner.scan(" ".join([*text, P.TEMPLATES["mit-text"], *text]))
        assert any(k == "mit-text" and lo < 60 + size and hi > 60 for k, _, lo, hi, _ in got)


def test_templates_of_few_telling_words():
    scan = P.Scanner({"odd": "this work is for the use of all zebra owners", "plain": "to be or not to be"}).scan
    assert [(x[0], x[1]) for x in scan("x this work is for the use of all zebra y")] == [("odd", 0.9)]
    assert [x[0] for x in scan("here to be or not to be there")] == ["plain"]


@pytest.mark.parametrize("clashing", [False, True])
def test_license_hard_rows(spark, clashing):
    got = P.scan_licenses(hard_docs(spark, clashing)).collect()
    assert len(got) == len(HARD) and all(r["license"] is None for r in got)
    assert P.scan_licenses(no_docs(spark)).count() == 0


def test_url_query_equals_its_sql(spark):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
    from check_oracle import duck, table_digest

    name = "op3_url_temporal_lists"
    df = QUERIES[name](spark, SF)
    assert_no_python(df)
    res = duck(SF).execute(ORACLE_SQL[name])
    cols, want = [d[0] for d in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(cols) == sorted(df.columns) and len(got) == len(want)
    assert table_digest(df.columns, got) == table_digest(cols, want)
    assert 0 < sum(r[df.columns.index("blocked")] for r in got) < len(got)


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_entries_active_at_fetch_time(spark):
    entries = [("ads", "host", "a.example.com", "add", day(10)), ("ads", "host", "a.example.com", "add", day(12)),
               ("ads", "host", "a.example.com", "remove", day(20)), ("ads", "host", "a.example.com", "add", day(90)),
               ("ads", "host", "a.example.com", "add", day(30)), ("ads", "host", "a.example.com", "remove", day(30)),
               ("bad", "domain", "example.com", "add", day(15)), ("bad", "domain", "example.com", "remove", day(16)),
               ("one", "url", "b.example.org/x", "add", day(1)), ("one", "url", None, "add", day(1)), ("one", "url", "y", "add", None),
               ("gone", "host", "c.net", "remove", day(1))]
    captures = [(i, url, day(t) if t is not None else None, "x") for i, (url, t, _) in enumerate(CASES)]
    caps = spark.createDataFrame(captures, "id long, url string, fetched_at timestamp, row string").withColumn("pattern", F.lit(1))
    table = spark.createDataFrame(entries, "list_name string, kind string, pattern string, action string, effective_at timestamp")
    for days, hot in ((1, 100), (14, 1), (14, 3), (400, 2)):
        out = U.with_verdict(caps, table, slice_days=days, hot_rows=hot)
        assert out.columns == [*caps.columns, "url_filter"]
        got = {r["id"]: r["url_filter"]["lists"] for r in out.collect()}
        assert [got[i] for i in range(len(CASES))] == [w for _, _, w in CASES]
    assert U.with_verdict(caps.where("false"), table).count() == 0
    assert {r["url_filter"]["blocked"] for r in U.with_verdict(caps, table.where("false")).collect()} == {False}


CASES = [("http://a.example.com/p", 9, ""), ("http://a.example.com/p", 10, "ads"), ("https://u:p@A.Example.com.:80/p", 15, "ads,bad"),
         ("http://a.example.com", 19, "ads"), ("http://a.example.com", 20, ""), ("http://a.example.com", 30, ""), ("http://a.example.com", 95, "ads"),
         ("http://z.example.com/?q", 15, "bad"), ("http://notexample.com/", 15, ""), ("https://b.example.org/x?u=1#f", 2, "one"),
         ("http://b.example.org/x/", 2, ""), (None, 15, ""), ("http://a.example.com/p", None, ""), ("nonsense", 15, ""), ("http://c.net/", 5, ""),
         ("http://a.example.com/p", 10, "ads")]
