"""SimHash near-duplicates linked through sharded BK-trees.

Fingerprints within ``max_bits`` differing bits agree on all of at least
``blocks - max_bits`` of ``blocks`` bit blocks, so for every choice of that many blocks the
distinct fingerprints are dealt by the value of those blocks into shards, and each link is
found in at least one shard. A shard holds a BK-tree: children are keyed by their integer
Hamming distance to the parent, and a search follows only the edges within the radius of
its own distance. The number of blocks grows with the table so that shards stay small; a
shard that is still larger than ``shard_rows`` is cut into chunks, and every pair of chunks
is its own (tree, queries) task, so no group is gathered whole and no link is lost. The trees
travel to their queries through the shuffle, because a broadcast of all of them would grow
with the table. A shard returns a spanning forest of its links, not its pairs.

Defined cases: a NULL text is an empty one; without words the fingerprint is zero and links
like any other; equal fingerprints are one class before any search, however many rows share
it; rows that repeat a doc_id are rows of their own; a NULL doc_id is never the smallest id
of a component unless it has no other. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from aerolake.llm.common import quoted, small_batches, spare_name, staged
from aerolake.llm.components import connected_components

SHINGLE_WORDS, MAX_BITS = 4, 4
#: Rows of a shard that one task searches at once; larger shards are cut into chunks of this size.
SHARD_ROWS = 8192
#: Mean shard size aimed at when the number of blocks is chosen.
MEAN_SHARD = 16
_SEED, _ROW_BLOCK, _LANES = 42, 255, np.uint64(0x0101010101010101)


def _shingle_digests(text: bytes | None, size: int) -> list[bytes]:
    from xxhash import xxh64_digest

    words = (text or b"").lower().split()  # bytes: lower() is A-Z only, split() is at x20 and x09-x0D
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxh64_digest(joined, _SEED)]
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [xxh64_digest(joined[a:b - 1], _SEED) for a, b in zip(starts, starts[size:])]


def fingerprints(texts: list[bytes | None], size: int = SHINGLE_WORDS) -> np.ndarray:
    """The uint64 SimHash of each text: a bit is set if it is set in over half the shingle hashes."""
    digests = [_shingle_digests(t, size) for t in texts]
    counts = np.array([len(d) for d in digests], dtype=np.int64)
    out = np.zeros(len(texts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    hashes = np.frombuffer(b"".join(b"".join(d) for d in digests), dtype=">u8").astype("<u8")
    n = counts[full]
    ends = np.cumsum(n)
    # Byte lanes count one bit position of all eight bytes at a time; a run of 255 rows cannot overflow.
    pieces = -(-n // _ROW_BLOCK)
    first = np.cumsum(pieces) - pieces
    runs = np.repeat(ends - n, pieces) + (np.arange(pieces.sum()) - np.repeat(first, pieces)) * _ROW_BLOCK
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, runs)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        majority = (2 * ones > n[:, None]).astype(np.uint64)
        for byte in range(8):
            out[full] |= majority[:, byte] << np.uint64(8 * byte + bit)
    return out


@F.arrow_udf(LongType())
def _fingerprint_udf(text: pa.Array) -> pa.Array:
    return pa.array(fingerprints(text.to_pylist()).view(np.int64))


def with_fingerprint(docs: DataFrame, text_col: str, out_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.withColumn(out_col, _fingerprint_udf(quoted(text_col).cast("binary")))


class BKTree:
    """A BK-tree over distinct fingerprints: node -> {distance to it: child}."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.root, self.children = (0 if len(values) else None), [() for _ in values]
        todo = [np.arange(len(values))] if len(values) else []
        while todo:
            members = todo.pop()
            node, rest = int(members[0]), members[1:]
            if not len(rest):
                continue
            d = np.bitwise_count(values[rest] ^ values[node])
            order = np.argsort(d, kind="stable")
            rest, d = rest[order], d[order]
            cuts = np.flatnonzero(np.diff(d)) + 1
            groups = np.split(rest, cuts)
            self.children[node] = [(int(d[c]), int(g[0])) for c, g in zip([0, *cuts], groups)]
            todo += groups

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, positions of the queries within ``radius`` of it) for each node that has any."""
        todo = [(self.root, np.arange(len(queries)))] if self.root is not None and len(queries) else []
        while todo:
            node, who = todo.pop()
            d = np.bitwise_count(queries[who] ^ self.values[node]).astype(np.int16)
            near = who[d <= radius]
            if len(near):
                yield node, near
            for edge, child in self.children[node]:
                follow = who[np.abs(d - edge) <= radius]
                if len(follow):
                    todo.append((child, follow))


def _forest_small(values: list[int], radius: int) -> list[int]:
    """The label (smallest index linked to) of each of a few values, by inserting them one at a time into a BK-tree."""
    label = list(range(len(values)))

    def find(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    children: list[dict[int, int]] = [{} for _ in values]
    for i in range(1, len(values)):
        todo, at, v = [0], 0, values[i]
        while todo:
            j = todo.pop()
            d = (v ^ values[j]).bit_count()
            if d <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
            kids = children[j]
            todo += [kids[e] for e in range(max(d - radius, 0), d + radius + 1) if e in kids]
        while True:
            d = (v ^ values[at]).bit_count()
            if d not in children[at]:
                children[at][d] = i
                break
            at = children[at][d]
    return [find(i) for i in range(len(values))]


def _forest(values: np.ndarray, radius: int) -> np.ndarray:
    """The label (smallest index reachable within the group) of each value."""
    if len(values) <= 48:
        return np.array(_forest_small(values.tolist(), radius))
    label = np.arange(len(values))
    for _, near in BKTree(values).search(values, radius):
        roots = np.unique(label[near])
        if len(roots) > 1:
            label[np.isin(label, roots)] = roots[0]
    return label


def _link_shards(radius: int):
    """Rows sorted by shard -> spanning links (a, b) of each shard, one shard in memory at a time."""
    out_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        a, b, held, key = [], [], [], None

        def close():
            fps = np.unique(np.concatenate(held))
            if len(fps) > 1:
                label = _forest(fps.view(np.uint64), radius)
                moved = np.flatnonzero(label != np.arange(len(fps)))
                a.append(fps[moved])
                b.append(fps[label[moved]])

        def flush():
            batch = pa.record_batch([np.concatenate(a), np.concatenate(b)], schema=out_schema)
            a.clear()
            b.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "pair")]
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
            for lo, hi in zip([0, *changes], [*changes, len(fp)]):
                this = tuple(int(c[lo]) for c in cols)
                if this != key and held:
                    close()
                    held = []
                key = this
                held.append(fp[lo:hi].copy())
            if sum(map(len, a)) > 10_000:
                yield flush()
        if held:
            close()
        if a:
            yield flush()

    return run


def blocks_for(n: int, max_bits: int = MAX_BITS) -> int:
    """The fewest blocks (two more than the bits at least) whose shards of ``n`` rows stay small on average."""
    blocks = max_bits + 2
    while n / 2 ** (64 * (blocks - max_bits) // blocks) > MEAN_SHARD and blocks < 2 * max_bits:
        blocks += 1
    return blocks


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS,
                      blocks: int | None = None) -> DataFrame:
    """Distinct ``fps(fp long)`` -> links ``(a, b)`` that connect exactly what all links of at most ``max_bits`` would."""
    n_blocks = blocks or blocks_for(fps.count(), max_bits)
    edges = np.linspace(0, 64, n_blocks + 1).round().astype(int)
    masks = [sum(((1 << int(edges[i + 1] - edges[i])) - 1) << int(edges[i]) for i in chosen)
             for chosen in combinations(range(n_blocks), n_blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "key"))
    sizes = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = dealt.join(sizes, ["t", "key"])
    # A chunk number per row; a shard of one chunk has the pair 0, a larger one a pair for each other chunk.
    chunks = F.ceil(F.col("n") / shard_rows).cast("long")
    mine = F.pmod(F.xxhash64("fp"), chunks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1),
                        lambda j: F.least(mine, j) * chunks + F.greatest(mine, j))
    members = members.select("t", "key", "fp", F.explode(F.when(chunks == 1, F.array(F.lit(0).cast("long")))
                                                        .otherwise(pairs)).alias("pair"))
    dealt_out = members.repartition("t", "key", "pair").sortWithinPartitions("t", "key", "pair")
    return dealt_out.mapInArrow(_link_shards(max_bits), "a long, b long")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           max_bits: int = MAX_BITS) -> DataFrame:
    """``(<id_col>, fp long, component_id)``: one row per input row."""
    narrow = with_fingerprint(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), "text", "fp")
    return component_of(narrow.select("id", "fp"), max_bits).withColumnRenamed("id", id_col)


def component_of(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``prints(id, fp)`` -> ``(id, fp, component_id)``."""
    prints = staged(prints, "simhash-prints")
    classes = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    small_batches(prints.sparkSession)
    roots = connected_components(link_fingerprints(classes.select("fp"), max_bits))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = staged(linked, "simhash-linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(linked.join(smallest, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select("id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: the one with the smallest id (NULL ids last).

    Columns stay as they are. Rows that tie on the id are told apart by an order fixed when they
    are first written, so exactly one stays.
    """
    row = spare_name(docs, "_simhash_row")
    fp = spare_name(docs, "_simhash_fp")
    numbered = staged(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()), text_col, fp), "simhash-docs")
    # The class of a fingerprint keeps its smallest (id, row); components compare those.
    order = F.struct(quoted(id_col).isNull().alias("void"), quoted(id_col).alias("id"), quoted(row).alias("row"))
    best = staged(numbered.groupBy(quoted(fp).alias("fp")).agg(F.min(order).alias("best")), "simhash-best")
    roots = connected_components(link_fingerprints(best.select("fp"), max_bits))
    stays = (best.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("first")).select(F.col("first.row").alias("row")))
    # Rows leave that are not the best of their fingerprint, or whose fingerprint is not the best of its component.
    # They are fewer than those that stay; Spark broadcasts them below its own limit and shuffles both sides beyond it.
    narrow = numbered.select(quoted(row).alias("row"))
    leaves = staged(narrow.join(staged(stays, "simhash-stays"), "row", "left_anti"), "simhash-leaves")
    return numbered.join(leaves.withColumnRenamed("row", row), row, "left_anti").select(*[quoted(c) for c in docs.columns])
