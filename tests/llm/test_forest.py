from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import lsh_forest as H
from aerolake.llm.queries import op6_hash_prefix_forest

def is_query():
    return F.col("vec_id") % 100 == 0


def brute(ids, x, k=10):
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(d[j])) for j in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").toPandas()
    want = brute(rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float))
    got = op6_hash_prefix_forest(spark, f"/root/testdata/{sf}").toPandas()
    assert set(got["query_id"]) == set(want)
    hits = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, 11)) and g["score"].is_monotonic_increasing
        exact = dict(want[q])
        hits += len(set(g["vec_id"]) & set(exact))
        assert all(s == pytest.approx(exact[v]) for v, s in zip(g["vec_id"], g["score"]) if v in exact)
    assert hits >= 0.9 * 10 * len(want)


def test_trees_ascend_together():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 8))
    forest = H.HashForest(x, trees=5, bits=10)
    hashes, q = forest.hash(x), rng.normal(size=(6, 8))
    for row, found in zip(forest.hash(q).T, forest.candidates(q, 50)):
        common = np.array([[10 - int(h ^ r).bit_length() for h in hs] for hs, r in zip(hashes, row)])  # prefix lengths
        level = max(n for n in range(11) if (common >= n).any(axis=0).sum() >= 50)
        assert set(found) == set(np.flatnonzero((common >= level).any(axis=0)))


@pytest.mark.parametrize("shard_rows,query_block", [(16384, 2048), (40, 2)])
def test_hard_vectors(spark, shard_rows, query_block):
    rng = np.random.default_rng(3)
    data = [(i, [float(v) for v in rng.normal(size=4)], 1) for i in range(0, 400, 2)]
    data += [(1000 + i, [1.0, 2.0, 3.0, 4.0], 1) for i in range(120)] + [data[0], (None, [1.0] * 4, 1), (1, None, 1), (3, [0.0] * 4, 1),
             (5, [1.0, None, 1.0, 1.0], 1), (7, [float("nan")] * 4, 1), (9, [float("inf")] * 4, 1), (11, [], 1), (500, [1.0, 1.0], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, score int").withColumn("rank", F.lit(1))
    got = H.search(df, is_query(), shard_rows=shard_rows, query_block=query_block, share=1.0).collect()
    ok = {i: v for i, v, _ in data if i is not None and v and len(v) == 4 and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(ok))
    want = brute(ids, np.array([ok[i] for i in ids]))
    have = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        have.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert have.keys() == want.keys()
    for q, w in want.items():
        assert [v for v, _ in have[q]] == [v for v, _ in w], q
    assert H.search(df.where("false"), is_query()).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/check_s"), reason="check tables are not here")
def test_recall_on_the_larger_table(spark):
    rows = spark.read.parquet("/root/testdata/check_s/embeddings.parquet").toPandas()
    want = brute(rows["vec_id"].to_numpy(), np.stack(rows["embedding"].to_numpy()).astype(float))
    got = op6_hash_prefix_forest(spark, "/root/testdata/check_s").toPandas()
    hits = sum(len(set(g["vec_id"]) & {v for v, _ in want[q]}) for q, g in got.groupby("query_id"))
    assert hits >= 0.9 * sum(map(len, want.values()))
