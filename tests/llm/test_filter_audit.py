from __future__ import annotations

import itertools
import re

import duckdb
import numpy as np
import pytest
from llm_cases import HARD, SF, hard_docs, no_docs
from pyspark.sql import functions as F

from aerolake.llm import filter_audit as A
from aerolake.llm.oracle import ORACLE_SQL
from aerolake.llm.queries import op11_filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_masks(rows):
    """(part, doc_id, mask) by the definition; rows: (doc_id, text, part)."""
    out = []
    for i, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        twin = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)
        tests = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), twin]
        out.append((part or "", i, sum(b << k for k, b in enumerate(tests))))
    return out


def plain_audit(rows, good, toxic):
    out = set()
    masks = plain_masks(rows)
    for part in {m[0] for m in masks}:
        own = [(i, m) for p, i, m in masks if p == part]
        results = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                here = [x for x in left if x[1] & bit]
                gone = [x for x in own if x not in left or x in here]
                left = [x for x in left if not x[1] & bit]
                results[order, step] = (len(left), len(here), sum(bool(m & bit) for _, m in own) - len(here), sum(m == bit for _, m in own),
                                        sum(i in good for i, _ in here), sum(i in toxic for i, _ in here), f)
                assert len(gone) + len(left) == len(own)
        totals = {f: sum(r[1] for r in results.values() if r[6] == f) for f in "ABCDE"}
        out |= {(part, o, s, *r[:6], totals[r[6]]) for (o, s), r in results.items()}
    return out


def test_query_equals_sql(spark):
    got = op11_filter_audit(spark, SF)
    assert got.columns == COLUMNS
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op11_filter_audit"]).fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) % 600 == 0 and sorted(rows) == sorted(want)


@pytest.mark.parametrize("clashing", [False, True])
def test_hard_rows_equal_the_definition(spark, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (9, 1, 1), (9, 1, 1), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r[0], r[1], r[2]) for r in HARD]
    got = A.audit(A.failure_masks(hard_docs(spark, clashing)), labels)
    assert {tuple(r) for r in got.collect()} == plain_audit(rows, {1, 2, 9}, {2, 9}) and got.count() == 600 * len({r[2] or "" for r in HARD})
    assert A.audit(A.failure_masks(no_docs(spark)), labels).count() == 0


def test_trie_holds_the_least_id_of_each_text():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, rng.integers(0, 9)).astype(np.uint8)) for _ in range(3000)] + [b"a" * 5000, b"a" * 4999 + b"b", b"a" * 5000]
    ids = rng.permutation(len(texts)).tolist()
    trie, least = A.RadixTrie(), {}
    numbers = [trie.insert(t, i) for t, i in zip(texts, ids)]
    for t, i in zip(texts, ids):
        least[t] = min(least.get(t, i), i)
    assert [trie.ids[n] for n in numbers] == [least[t] for t in texts]
    walked = list(trie.traverse())
    assert [t for t, _, _ in walked] == sorted(least) and all(least[t] == i and trie.ids[n] == i for t, i, n in walked)
    # no node with one child but the terminals: the paths are compressed
    stack = [trie.root]
    while stack:
        node = stack.pop()
        stack += node[1].values()
        assert node is trie.root or node[3] is not None or len(node[1]) > 1


def test_small_chunks_and_deep_prefixes(spark, monkeypatch):
    """Long shared starts are told apart by longer prefixes; copies meet whatever the chunks, tasks and ranges."""
    rng = np.random.default_rng(5)
    start = "the same words begin this text " * 40
    rows = [(int(i), start + f"{rng.integers(150)} " * int(rng.integers(1, 4)) if i % 3 else "one hot text " * 60, "en") for i in rng.permutation(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(16)
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    prefixes = texts.select(A.adaptive_prefix(texts, 32).alias("p"), "text").distinct().collect()
    assert max(len(r["p"]) for r in prefixes) > len(start) and len({bytes(r["p"]) for r in prefixes}) > 100
    assert all(bytes(r["text"]).startswith(bytes(r["p"])) for r in prefixes)
    monkeypatch.setattr(A, "CHUNK_BYTES", 4000)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = A.failure_masks(docs).select("part", "doc_id", "mask", "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted((r[0], r[1], r[2]) for r in got for _ in range(r[3])) == sorted(plain_masks(rows))
