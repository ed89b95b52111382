"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity`` tokens in one Python pass. What goes
where depends only on the lengths, so the plan is made on the length histogram, which has at
most ``capacity`` rows however many documents there are. For each bin, starting from the
longest length left, a bitset subset-sum over the available lengths finds the fullest feasible
combination, which is removed as often as its lengths last. Pieces then look up their place by
their rank among the pieces of their length; the ranks come from sub-buckets, so a length that
a third of all pieces share is spread over many tasks.

Defined cases: a NULL or empty text is the closing id alone; rows that repeat a doc_id, or have
none, are packed like any other; only id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, single_threaded, small_batches, staged

CAPACITY, END_ID = 4096, 1
#: Pieces of one length that one task ranks at once.
RANK_ROWS = 4096
#: Distinct words whose ids a worker remembers; later ones, which are rare, are tokenized in each batch that has them.
REMEMBERED_WORDS = 600_000
#: Words tokenized at once.
_CALL_WORDS = 4000


class WordIds:
    """Ids of whitespace-delimited words by a tokenizer that never merges across white space.

    The ids of a text are the concatenation of its words' ids, so each distinct word is
    tokenized once. Only ASCII white space separates words here; any other white space stays
    inside a word for the tokenizer to judge.
    """

    def __init__(self, path: str):
        single_threaded()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code: dict[str, int] = {}
        self.ids, self.starts, self.lens = np.empty(1 << 20, np.uint32), np.empty(1 << 18, np.int64), np.empty(1 << 18, np.int32)
        self.used = 0

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.empty(max(n, 2 * len(a)), a.dtype)
        out[:len(a)] = a
        return out

    def _tokenized(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and the number of each word's."""
        ids, lens = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)]
        for i in range(0, len(words), _CALL_WORDS):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words[i:i + _CALL_WORDS], add_special_tokens=False)]
            ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
            lens.append(np.fromiter(map(len, found), np.int32, len(found)))
        return np.concatenate(ids), np.concatenate(lens)

    def _add(self, ids: np.ndarray, lens: np.ndarray, n: int, used: int) -> None:
        """Words ``n`` and on, their ids from place ``used``."""
        self.ids = self._grown(self.ids, used + len(ids))
        self.ids[used:used + len(ids)] = ids
        self.starts, self.lens = self._grown(self.starts, n + len(lens)), self._grown(self.lens, n + len(lens))
        self.starts[n:n + len(lens)] = used + np.cumsum(lens) - lens
        self.lens[n:n + len(lens)] = lens

    def encode(self, texts: pa.Array, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids of string ``texts``, each text's followed by ``end_id``, and the number of ids of each text."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()  # distinct words of the batch, found outside Python
        words = coded.dictionary.to_pylist()
        new, n = [w for w in words if w not in self.code], len(self.code)
        fresh = dict(zip(new, range(n, n + len(new))))
        ids, sizes = self._tokenized(new)
        self._add(ids, sizes, n, self.used)
        known = np.fromiter((c if (c := self.code.get(w)) is not None else fresh[w] for w in words), np.int64, len(words))
        if n + len(new) <= REMEMBERED_WORDS:  # else the next batch overwrites them
            self.code.update(fresh)
            self.used += len(ids)
        codes = known[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        lens = self.lens[codes].astype(np.int64)
        ends = np.cumsum(lens)
        flat = self.ids[np.repeat(self.starts[codes] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)]
        last = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        ids_before = np.concatenate([[0], ends])[last]
        per_text = np.diff(np.concatenate([[0], ids_before]))
        return np.insert(flat, ids_before, end_id).astype("<u4", copy=False), per_text + 1


@functools.cache
def _word_ids(path: str) -> WordIds:
    """One memory of words for each worker process: its tasks run one after the other."""
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: ids are little-endian unsigned 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        coder = _word_ids(tokenizer_path)
        for batch in batches:
            ids, counts = coder.encode(batch.column("text"), end_id)
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, counts[doc] - start)
            at = (np.cumsum(counts) - counts)[doc] + start
            yield pa.record_batch([batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                                   pa.array(length), pa.array([ids[a:a + n].tobytes() for a, n in zip(at, length)], pa.binary())],
                                  schema=schema)
        pa.default_memory_pool().release_unused()

    small_batches(docs.sparkSession)
    narrow = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def _fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum of at most ``room``, longer lengths first."""
    reach, keep, trail = 1, (1 << (room + 1)) - 1, []
    for n in lengths:
        if n > room:
            continue
        left, part = min(counts[n], room // n), 1
        while left > 0:
            take = min(part, left)
            trail.append((n, take, reach))
            reach |= (reach << (n * take)) & keep
            left -= take
            part *= 2
        if reach >> room:
            break
    at, out = reach.bit_length() - 1, {}
    for n, take, before in reversed(trail):
        if not before >> at & 1:
            out[n] = out.get(n, 0) + take
            at -= n * take
    return out


def bin_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Segments of the plan: pieces of ``length`` ranked from ``rank`` on fill ``copies`` places each,
    ``offset`` tokens in, of the bins from ``first_bin`` on; sorted by (length, rank)."""
    counts = {int(n): int(c) for n, c in histogram.items() if c > 0}
    used = dict.fromkeys(counts, 0)
    lengths, rows, bins = sorted(counts, reverse=True), [], 0
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        combo = _fullest(lengths, counts, capacity - longest)
        counts[longest] += 1
        combo[longest] = combo.get(longest, 0) + 1
        times, offset = min(counts[n] // c for n, c in combo.items()), 0
        for n in sorted(combo, reverse=True):
            rows.append((n, used[n], bins, combo[n], offset))
            offset += n * combo[n]
            used[n] += combo[n] * times
            counts[n] -= combo[n] * times
        bins += times
        lengths = [n for n in lengths if counts[n]]
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first_bin", "copies", "offset"), table.T.copy()))


_RANK_BITS = 44
#: The number of a piece, fixed when it is written.
ROW = "_packing_row"


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` written once, each with a number of its own."""
    return staged(pieces.withColumn(ROW, F.monotonically_increasing_id()), "packing-pieces")


def ranked(pieces: DataFrame, rank_rows: int = RANK_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """``pieces`` with ``_rank``, its place among those of its length, and the length histogram.

    A length is cut into sub-buckets by a hash of the row number (equal rows part too); each is ranked alone and moved by the count
    of the buckets before it. ``pieces`` must be staged by :func:`numbered`, so that every pass sees the same rows.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = -(-max(histogram.values(), default=1) // rank_rows)
    key = [ROW]
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)))
    offsets = bucketed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")
                                               .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    local = bucketed.withColumn("_local", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*key)))
    return (local.join(offsets, ["length", "_bucket"])
            .withColumn("_rank", F.col("_before") + F.col("_local") - 1).drop("_bucket", "_before", "_local")), histogram


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` of :func:`numbered` (any columns, with ``length``) with ``sequence_id`` and ``offset``.

    The plan sent to the tasks is bounded by the capacity: a few rows for each distinct length.
    """
    placed, histogram = ranked(pieces)
    plan = bin_plan(histogram, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(plan | {"key": (plan["length"] << _RANK_BITS) | plan["rank"]})

    @F.arrow_udf("sequence_id long, offset long")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        p, n, r = shared.value, length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(p["key"], (n << _RANK_BITS) | r, side="right") - 1
        bins, slot = np.divmod(r - p["rank"][at], p["copies"][at])
        return pa.StructArray.from_arrays([pa.array(p["first_bin"][at] + bins), pa.array(p["offset"][at] + slot * n)],
                                          names=["sequence_id", "offset"])

    placed = placed.withColumn("_place", place("length", "_rank"))
    return placed.select(*[c for c in pieces.columns if c != ROW], "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Pieces with their place; with ``keep_ids`` their token ids too, else a crc32 of them."""
    pieces = token_pieces(docs, tokenizer_path, id_col, text_col, capacity)
    if not keep_ids:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(numbered(pieces), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the token ids of each packed sequence, at most one capacity long."""
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"),
                                              F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", "length",
                    F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
