"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets one long hash string per tree (the signs of its projections on random
directions, from the mean of its shard). A tree is the sorted array of its strings. A query
descends each tree by binary search to the rows with the longest common prefix, then all trees
ascend together, one prefix length at a time, until the rows under the prefixes number at
least the wanted candidates; all of those are measured exactly.

The rows are dealt by a hash of their id into shards of a bounded size, each with a forest of
its own, and the stated query set visits every shard in bounded blocks; each shard returns its
nearest ``k`` to every query, and the nearest of those are the answer. Of identical vectors only the
``k + 1`` smallest ids can be in an answer, so the others leave before the search.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components, and
rows without an id, take no part; vectors of other lengths are not compared; equal distances go to
the smaller id; repeated rows of an id count once; a query is never its own neighbour. Only the
id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, staged

#: Trees, bits of a hash string, share of a shard's rows measured for a query (and the least number of them).
TREES, BITS, CANDIDATES, LEAST_CANDIDATES = 32, 24, 0.45, 400
SHARD_ROWS, QUERY_BLOCK, SEED = 16384, 2048, 11


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) > 0) & ~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


class HashForest:
    """Sorted hash strings of some rows, per tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        rng = np.random.default_rng([seed, vectors.shape[1]])
        self.mean, self.bits = vectors.mean(axis=0), bits
        self.planes = rng.normal(size=(trees, bits, vectors.shape[1]))
        hashes = self.hash(vectors)
        self.order = np.argsort(hashes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(hashes, self.order, axis=1)

    def hash(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, rows) hash strings, the first bit the highest."""
        place = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        centred = (vectors - self.mean).T
        return np.stack([((p @ centred) > 0).T @ place for p in self.planes])

    def ranges(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries, bits + 1) slices of the sorted arrays under each prefix length."""
        lo = np.empty((*hashes.shape, self.bits + 1), np.int64)
        hi = np.empty_like(lo)
        for length in range(self.bits + 1):
            shift = self.bits - length
            first = (hashes >> shift) << shift
            for t in range(len(hashes)):
                lo[t, :, length] = np.searchsorted(self.sorted[t], first[t], side="left")
                hi[t, :, length] = np.searchsorted(self.sorted[t], first[t] + (1 << shift) - 1, side="right")
        return lo, hi

    def candidates(self, queries: np.ndarray, wanted: int):
        """Per query the rows found when the trees have ascended far enough to hold ``wanted`` different ones."""
        lo, hi = self.ranges(self.hash(queries))
        total = (hi - lo).sum(axis=0)
        n = self.order.shape[1]
        for q in range(len(queries)):
            # Longest common prefixes first; the count with repeats is at least the count without.
            length = int(np.flatnonzero(total[q] >= min(wanted, n))[-1])
            while True:
                found = np.zeros(n, bool)
                for t in range(len(self.order)):
                    found[self.order[t, lo[t, q, length]:hi[t, q, length]]] = True
                if length == 0 or np.count_nonzero(found) >= wanted:
                    break
                length -= 1
            yield np.flatnonzero(found)


def nearest(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
            share: float = CANDIDATES, least: int = LEAST_CANDIDATES, trees: int = TREES, bits: int = BITS) -> pd.DataFrame:
    forest = HashForest(vectors, trees, bits)
    wanted = min(len(ids), max(least, int(np.ceil(share * len(ids)))))
    out = []
    for qid, q, rows in zip(query_ids, queries, forest.candidates(queries, wanted)):
        rows = rows[ids[rows] != qid]
        gap = vectors[rows] - q
        d = np.sqrt((gap * gap).sum(axis=1))
        best = np.lexsort((ids[rows], d))[:k]
        out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows[best]], "score": d[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK, share: float = CANDIDATES,
           least: int = LEAST_CANDIDATES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row that ``is_query`` marks."""
    rows = staged(vectors.where(usable(quoted(vec_col)) & quoted(id_col).isNotNull()).select(
        quoted(id_col).cast("long").alias("vec_id"), quoted(vec_col).cast("array<double>").alias("vec"),
        is_query.alias("is_query")).dropDuplicates(["vec_id", "vec"]), "ann-rows")
    size = rows.agg(F.count(F.lit(1)), F.sum(F.col("is_query").cast("long"))).first()
    shards, blocks = (max(1, -(-(n or 0) // each)) for n, each in zip(size, (shard_rows, query_block)))
    copy = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    several = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    indexed = (rows.withColumn("copy", copy).where(F.col("copy") <= k + 1)
               .select("vec_id", "vec", F.size("vec").alias("dims"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
                       F.explode(several(blocks)).alias("block")))
    queries = (rows.where("is_query")
               .select("vec_id", "vec", F.size("vec").alias("dims"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
                       F.explode(several(shards)).alias("shard")))
    key = ["dims", "shard", "block"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        left, right = left.sort_values("vec_id", kind="stable"), right.sort_values("vec_id", kind="stable")
        return nearest(left["vec_id"].to_numpy(np.int64), np.stack(left["vec"].to_numpy()),
                       right["vec_id"].to_numpy(np.int64), np.stack(right["vec"].to_numpy()), k, share, least)

    found = indexed.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
