"""Which filter removes what: an audit of filters over every order they can be applied in, with exact duplicates by radix text tries.

Five filters judge whole texts (NULL: empty). Words are maximal runs of other characters than space and
``\\t..\\r``, with case. A: under 200 words; B: distinct words under half of the words; C: ``[A-Z]`` over 3 % of the code points;
D: any of ``#$%&*|``; E: the text equals that of a row with a smaller id, anywhere in the table.

E needs whole texts side by side. Each task inserts its texts into compressed tries whose terminals hold the least id, so copies
within a task meet before any shuffle: a row above the least id of its text is a duplicate already, and one
row a task and text goes on. These are dealt out by ranges of text prefixes as long as it takes: a prefix that holds more
than a task's share of the bytes is lengthened fourfold, until it is light or the texts end. Each range is
a trie again; equal texts have equal prefixes, so they meet in one of them, and its traversal says which of the rows that came are
above the least id. Rows become counts of failure masks a part of the table; the 120 orders are expanded from those counts.

Bounds: a task's trie holds at most ``CHUNK_BYTES`` of new text before it is traversed and emptied; a range's trie each distinct
text of the range once, without the prefixes they share. The driver sees hashes of heavy prefixes only: at most one a range and length.

Defined cases: a row with a NULL id has no smaller id and is smaller than none, so E never fails it; rows that repeat
an id and a text are not each other's duplicates; NULL parts are the empty string; a label counts if any row of its id has it; an empty
table has no rows; texts of any length are whole. Other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import arrow_batches, drop_staged, quoted, shuffle_partitions, staged

FILTERS = "ABCDE"
#: Fixed values of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Bytes of new text in a task's trie, and of text in one range.
CHUNK_BYTES, RANGE_BYTES = 16 << 20, 64 << 20
#: First prefix length, and the factor by which heavy prefixes grow.
PREFIX, LONGER = 4, 4
#: A text's weight besides its bytes.
ROW_BYTES = 64

_CAPITALS = bytes(range(65, 91))
_LATER_BYTES = bytes(range(0x80, 0xC0))


class RadixTrie:
    """Compressed trie of byte strings; a node is ``[label, children by first byte, least id, number]``, and terminals have an id.

    Every terminal has a number, so that a caller can note it and look up the least id once all texts are in."""

    def __init__(self):
        self.root: list = [b"", {}, None, None]
        self.ids: list[int] = []
        self.size = 0

    def insert(self, text: bytes, i: int) -> int:
        """The number of the text's terminal, whose id is lowered to ``i``."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = [text[at:], {}, None, None]
                node[1][text[at]] = child
                self.size += len(text) - at + ROW_BYTES
                node, at = child, len(text)
                break
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, text, at)
            upper = [label[:same], {label[same]: child}, None, None]
            child[0] = label[same:]
            node[1][text[at]] = upper
            self.size += ROW_BYTES
            node, at = upper, at + same
        if node[3] is None:
            node[2], node[3] = i, len(self.ids)
            self.ids.append(i)
        elif i < node[2]:
            node[2] = self.ids[node[3]] = i
        return node[3]

    def traverse(self) -> Iterator[tuple[bytes, int, int]]:
        """(text, least id, number) of every terminal, in byte order."""
        stack = [(b"", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node[0]
            if node[3] is not None:
                yield text, node[2], node[3]
            stack += [(text, node[1][b]) for b in sorted(node[1], reverse=True)]


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``text[at:]``, which differ within the label."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == text[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def own_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    code_points = len(text.translate(None, _LATER_BYTES))
    return ((n < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1 | (100 * capitals > MOST_CAPITALS * code_points) << 2
            | (len(text.translate(None, SYMBOLS)) < len(text)) << 3)


_LOCAL = "text binary, doc_id long, part string, mask int, n long"


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose text still has to meet other tasks' (with it, once for each id and part), and counts of the settled ones."""
    trie, rows, masks = RadixTrie(), [], []

    def flush():
        texts = {number: text for text, _, number in trie.traverse()}
        settled, open_rows = {}, {}
        for number, i, part in rows:
            if i is None or i > trie.ids[number]:
                key = i, part, masks[number] | (0 if i is None else 16)
                settled[key] = settled.get(key, 0) + 1
            else:
                open_rows[number, part] = open_rows.get((number, part), 0) + 1
        out = [(None, *k, n) for k, n in settled.items()]
        out += [(texts[number], trie.ids[number], part, masks[number], n) for (number, part), n in open_rows.items()]
        del rows[:], masks[:]
        size, cut = 0, 0
        for at, row in enumerate(out):
            size += len(row[0] or b"") + ROW_BYTES
            if size > 4 << 20 or at == len(out) - 1:
                yield _batch(out[cut:at + 1])
                size, cut = 0, at + 1

    for b in batches:
        for text, i, part in zip(*(b.column(c).to_pylist() for c in ("text", "doc_id", "part"))):
            if i is None:
                number = len(trie.ids)
                trie.ids.append(None)
                masks.append(own_mask(text))
                trie.size += ROW_BYTES
            else:
                number = trie.insert(text, i)
                if number == len(masks):
                    masks.append(own_mask(text))
            rows.append((number, i, part))
            if trie.size + ROW_BYTES * len(rows) > CHUNK_BYTES:
                yield from flush()
                trie = RadixTrie()
    if rows:
        yield from flush()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in _LOCAL.split(", ")])


_FLAGS = "doc_id long, part string, mask int, n long"


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one range with the bit of filter E, known once every text of the range is in the trie."""
    trie, kept = RadixTrie(), []
    for b in batches:
        ids = b.column("doc_id").to_numpy()
        numbers = [trie.insert(t, i) for t, i in zip(b.column("text").to_pylist(), ids.tolist())]
        kept.append((np.array(numbers, np.int64), b.select(["doc_id", "part", "mask", "n"])))
    least = np.array(trie.ids, np.int64)
    for numbers, b in kept:
        mask = b.column("mask").to_numpy() | (16 * (b.column("doc_id").to_numpy() > least[numbers])).astype(np.int32)
        yield pa.record_batch([b.column("doc_id"), b.column("part"), pa.array(mask, pa.int32()), b.column("n")],
                              names=["doc_id", "part", "mask", "n"])


def adaptive_prefix(texts: DataFrame, shares: int) -> Column:
    """The start of a text up to the first length (``PREFIX``, then times ``LONGER``) whose texts weigh under one of ``shares`` shares.

    Only the 8-byte hashes of heavy prefixes reach the driver, at most ``shares`` of a length; where two hashes meet, a prefix is
    longer than it needs to be."""
    text = F.col("text")
    weight = F.length(text) + ROW_BYTES
    whole = texts.agg(F.sum(weight)).first()[0] or 0
    levels, size, left = [], PREFIX, texts
    while True:
        head = F.substring(text, 1, size)
        # a text that ends here cannot be told apart by a longer prefix
        heavy = [r["head"] for r in left.where(F.length(text) > size).groupBy(F.xxhash64(head).alias("head")).agg(F.sum(weight).alias("w"))
                 .where(F.col("w") * shares > whole).select("head").collect()]
        if not heavy:
            break
        levels.append((size, heavy))
        left = left.where(F.xxhash64(head).isin(heavy))
        size *= LONGER
    prefix = F.substring(text, 1, size)
    for length, heavy in reversed(levels):
        head = F.substring(text, 1, length)
        prefix = F.when(F.xxhash64(head).isin(heavy), prefix).otherwise(head)
    return prefix


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(doc_id, part, mask, n)``: how many rows of an id and part fail which filters (bit 0 is A, bit 4 is E)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary").alias("text"), quoted(id_col).cast("long").alias("doc_id"),
                       F.coalesce(quoted(part_col).cast("string"), F.lit("")).alias("part"))
    with arrow_batches(spark):
        local = staged(rows.mapInArrow(_local, _LOCAL), "audit-local")
        texts = local.where("text IS NOT NULL")
        held = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        ranges = max(shuffle_partitions(spark), -(-held // RANGE_BYTES))
        dealt = texts.withColumn("prefix", adaptive_prefix(texts, ranges)).repartitionByRange(ranges, "prefix").drop("prefix")
        found = local.where("text IS NULL").drop("text").unionByName(dealt.mapInArrow(_resolved, _FLAGS))
        out = staged(found, "audit-masks")
    drop_staged(local)
    return out


def orders() -> list[str]:
    return ["".join(p) for p in itertools.permutations(FILTERS)]


def audit(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What every step of every order keeps and removes in each part, by the counts of ``failure_masks`` rows.

    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``."""
    of_id = labels.groupBy(quoted(id_col).cast("long").alias("label_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")).where("label_id IS NOT NULL AND (good OR toxic)")
    # rows that repeat an id are added up before they meet its label
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = rows.join(of_id, F.col("doc_id") == F.col("label_id"), "left")
    counts = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"))
    # at most 32 masks a part
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = [(o, k + 1, 1 << FILTERS.index(f), sum(1 << FILTERS.index(g) for g in o[:k])) for o in orders() for k, f in enumerate(o)]
    table = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(bit).alias("bit"), F.lit(done).alias("done"))
                      for o, k, bit, done in steps])
    bit, done = F.col("s.bit"), F.col("s.done")

    def total(what: str, test) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + F.when(test(m["mask"]), m[what]).otherwise(0))

    def fails(m):
        return m.bitwiseAND(bit) != 0

    def earlier(m):
        return m.bitwiseAND(done) != 0

    def falls(m):
        return fails(m) & ~earlier(m)

    # of all orders, one in as many as a row has failures has this filter first among them
    in_orders = F.aggregate("masks", F.lit(0).cast("long"), lambda a, m: a + F.when(
        fails(m["mask"]), m["n"] * (F.lit(len(orders())) / F.bit_count(m["mask"])).cast("long")).otherwise(0))
    return by_part.withColumn("s", F.explode(table)).select(
        "part", "s.filter_order", "s.step", total("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"), total("n", falls).alias("removed"),
        total("n", lambda m: fails(m) & earlier(m)).alias("redundant"), total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", falls).alias("good_lost"), total("toxic", falls).alias("toxic_lost"), in_orders.alias("shapley"))
