"""Language-model scores by a probabilistic suffix tree over words, of no fixed size or depth.

Words, contexts (the words before a place, nearest first) and pairs of a context and its next word are
64-bit hashes; two different ones are taken for one only where the hashes meet. The tree is grown level
by level. Documents are dealt into blocks of about ``BLOCK_TOKENS`` words, each one compressed row.

Count first, ask later: a block sends the sorted hashes of its contexts and pairs with their training counts to the buckets of the hash
range they lie in, as one compressed message a bucket; a bucket adds them up and answers each message with the totals in its
order. Pairs are only counted at places whose context can still be frequent and whose shorter pair is no rarity; contexts of one
word have the counts of their words, those of two words the counts of the pairs before. The
successors of frequent contexts that turn out to be listed are then written once each, as a table ``(ctx, n, p, total)``, and decide
which contexts are states; blocks ask only for the verdict on contexts they hold.

A context seen ``LEAST_COUNT`` times or more in training becomes a state if its successor distribution
diverges from that of its longest shorter context: the test is its leave-one-out log-likelihood gain over
the whole training text. Next-word distributions are smoothed by absolute discounting towards the shorter
context, down to the smoothed word frequencies. A word is scored by the longest suffix of its history that is a state.

A place is open for a longer context as long as its context is frequent enough and a longer one may still gain
``LEAST_GAIN`` nats: a successor seen ``n`` times cannot gain more than in a context that it follows every time. A place
closes too once its last ``idle`` contexts in turn, each a word longer, were no states (None: never; a text that many documents share
and go on from in their own ways keeps its end open for as many levels as it has words). That depends on the place's own contexts
alone, never on other texts. Levels are added until no place is open. A block keeps the words of texts that have open places, up to
the last one, its frequent words under small numbers, and what belongs to a pair once for each pair.
No number of words, contexts or successors is fixed; nothing that grows with them is collected or broadcast. A bucket holds at most
about ``BUCKET_KEYS`` hashes and a pair or context comes once from each block; successors of contexts with many are never
dealt by context.

Defined cases: a NULL or empty text is the end symbol alone; a NULL doc_id is never learned
from; rows that repeat an id count and are scored as rows of their own; a text of any length is whole, in one block; without training text
every probability is that of an unseen word. Only the id and text columns are read.
"""

from __future__ import annotations

import contextlib
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.llm.common import arrow_batches, drop_staged, quoted, shuffle_partitions, staged
from aerolake.session import delete_folder, scratch_path

#: Count of a context before it is considered, discount, and the gain in nats a state must bring.
LEAST_COUNT, DISCOUNT, LEAST_GAIN = 8, 0.75, 12.0
#: Words of a block, hashes of a bucket, bytes hashed at once.
BLOCK_TOKENS, BUCKET_KEYS, HASH_BYTES = 1 << 20, 1 << 21, 1 << 20
#: Contexts of a place without a state, one after the other, that close it.
IDLE = 2
#: Rows of the tables between steps that a task holds at once when it reads them.
READ_ROWS = 256
#: Spark's own bound on the buckets of a table.
MOST_PARTS = 100_000
#: A context with this share of a level's successors, and more than so many, is summed where they lie.
HOT_SHARE, LEAST_HOT = 1 / 400, 64

_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE, _BACK, _NEXT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
#: What stands for words that training has not or once: no context has them, and no successor is one.
FEW = np.random.default_rng(11).integers(1, 1 << 63, 2, dtype=np.uint64)
#: The bits of a probability that blocks keep between levels: 36 of the mantissa, an error under 2e-11.
_PRECISE = ~np.uint64(0xFFFF)
#: The symbol after the last word of a text.
END = np.int64(-1)
#: Kinds of written rows: a block, messages about pairs, about contexts, for verdicts on contexts, and listed successors.
BLOCK, PAIRS, CONTEXTS, VERDICTS, SUCCESSOR = range(5)
_ROWS = "kind int, block long, bucket long, payload binary, ctx long, n long, p double, total long"
_MESSAGE = "kind int, block long, bucket long, payload binary"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def hash_words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of ``words_of`` and the place of its first byte."""
    a = np.frombuffer(text.lower(), np.uint8)
    at = np.flatnonzero(~_SPACE[a])
    if not len(at):
        return np.zeros(0, np.int64), at
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(first, append=len(at))
    place = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size.max(), _PLACE))])
    h = np.add.reduceat(_BYTE[a[at]] * place[np.arange(len(at)) - np.repeat(first, size)], first) + size.astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))).view(np.int64), at[first]


def hash_texts(texts: list[bytes | None]) -> list[np.ndarray]:
    """The word hashes of each text and ``END``."""
    out, i = [], 0
    while i < len(texts):
        part, size = [], 0
        while i < len(texts) and (not part or size + len(texts[i] or b"") < HASH_BYTES):
            part.append(texts[i] or b"")
            size += len(part[-1]) + 1
            i += 1
        h, at = hash_words(b"\n".join(part))
        cut = np.searchsorted(at, np.cumsum([len(t) + 1 for t in part])[:-1])
        out += [np.append(x, END) for x in np.split(h, cut)]
    return out


def packed(arrays: dict) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, 5))


def unpacked(payload: bytes) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _block(state: dict) -> bytes:
    return packed(state | ({"ids": _planes(state["ids"])} if "ids" in state else {}))


def _state(payload: bytes) -> dict:
    state = unpacked(payload)
    return state | ({"ids": _unplanes(state["ids"], np.int32)} if "ids" in state else {})


def _rows(kind: int, block: int, bucket=None, payload=None) -> pa.RecordBatch:
    """Messages of a block, or the block itself."""
    payload = payload if isinstance(payload, list) else [payload]
    n, none = len(payload), [None] * len(payload)
    cols = [[kind] * n, [block] * n, none if bucket is None else bucket, payload, none, none, none, none]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)


_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the first place of each and the number of each place's key. The high bits are sorted with the places
    below them, several times as fast as an argsort; where keys differ in the low bits only, and so come out of order, that is done."""
    low = np.uint64((1 << max(len(keys) - 1, 0).bit_length()) - 1)
    order = keys & ~low
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= low
    order = order.astype(np.int32)
    there = keys[order]
    if (there[1:] < there[:-1]).any():
        order = np.argsort(keys, kind="stable").astype(np.int32)
        there = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(there[1:], there[:-1], out=new[1:])
    where = np.empty(len(keys), np.int32)
    where[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return there[new], order[new], where


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the unsigned hash, in order; the same as ``_bucket`` in SQL."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _bucket(key: Column, buckets: int) -> Column:
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 32) * F.lit(buckets).cast("long"), 32)


def _messages(kind: int, block: int, keys: np.ndarray, n: np.ndarray | None, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted distinct ``keys`` cut by bucket."""
    if not len(keys):
        return
    of = bucket_of(keys, buckets)
    cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(keys)]
    payload = []
    for a, b in zip(cuts, cuts[1:]):
        gaps = np.diff(keys[a:b], prepend=np.uint64(0))
        planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)  # the high bytes of the gaps are zeros
        payload.append(packed({"gaps": planes, "n": None if n is None else n[a:b].astype(np.int32)}))
    yield _rows(kind, block, of[cuts[:-1]].tolist(), payload)


def _keys(message: dict) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(message["gaps"].T).view(np.uint64).ravel(), dtype=np.uint64)


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Every text as word numbers in the dictionary of its block, and the block's words with their training counts."""

    def run(batches):
        number, held = TaskContext.get().partitionId() << 32, []

        def close():
            words = [w for part in held for w in part[0]]
            flat, size = np.concatenate(words).view(np.uint64), np.array([len(w) for w in words])
            ids, hold, learn = (sum((part[k] for part in held), []) for k in (1, 2, 3))
            learn = np.array(learn, bool)
            known, _, where = _distinct(flat)
            often = np.argsort(-np.bincount(where, minlength=len(known)), kind="stable")
            rank = np.empty(len(known), np.int32)
            rank[often] = np.arange(len(known))
            state = {"words": known[often], "ids": rank[where], "size": size, "doc": ids, "held": hold, "learn": learn}
            yield _rows(BLOCK, number, payload=_block(state))
            yield from _messages(PAIRS, number, known, np.bincount(where[np.repeat(learn, size)], minlength=len(known)), buckets)

        for batch in batches:
            part = [hash_texts(batch.column("text").to_pylist()), *(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "learn"))]
            if part[0]:
                held.append(part)
            if sum(len(w) for p in held for w in p[0]) >= BLOCK_TOKENS:
                yield from close()
                number, held = number + 1, []
        if held:
            yield from close()

    return docs.mapInArrow(run, _ROWS)


def _added_up(least: dict[int, int]):
    """The answers of one bucket: for each key of each message its total over all blocks (0 below ``least`` of its kind), twice, plus
    one for the first block that has it; and the bucket's own sums in a row of block -1."""

    def run(group: pa.Table) -> pa.Table:
        out, sums = [], np.zeros(3)
        kinds, blocks = group.column("kind").to_numpy(), group.column("block").to_numpy()
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            rows = rows[np.argsort(blocks[rows])]
            parts = [unpacked(group.column("payload")[int(i)].as_py()) for i in rows]
            keys = [_keys(p) for p in parts]
            known, first, where = _distinct(np.concatenate(keys))
            total = np.bincount(where, np.concatenate([p["n"] for p in parts]), len(known)).astype(np.int64)
            if kind == PAIRS:
                sums += total.sum(), np.count_nonzero(total), total[known == np.uint64(END.view(np.uint64))].sum()
            answer = 2 * np.where(total >= least[int(kind)], total, 0)[where]
            answer[first] += 1
            cuts = np.cumsum([len(k) for k in keys])[:-1]
            out += [(int(kind), int(blocks[i]), int(group.column("bucket")[0].as_py()), packed({"answer": a})) for i, a in zip(rows, np.split(answer, cuts))]
        out.append((PAIRS, -1, int(group.column("bucket")[0].as_py()), packed({"sums": sums})))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES[:4])

    return run


def _judged(asked: pa.Table, states: pa.Table) -> pa.Table:
    """The verdicts of one bucket: for each key of each message 0, or kept + 2 * open, and the weight of the shorter context."""
    known, order, _ = _distinct(states.column("ctx").to_numpy().view(np.uint64) if states.num_rows else np.zeros(0, np.uint64))
    flag = states.column("flag").to_numpy()[order] if states.num_rows else np.zeros(0, np.int32)
    back = states.column("back").to_numpy()[order] if states.num_rows else np.zeros(0)
    out = []
    for kind, block, bucket, payload in zip(*(asked.column(c).to_pylist() for c in _NAMES[:4])):
        keys = _keys(unpacked(payload))
        verdict, weight = np.zeros(len(keys), np.int8), np.zeros(len(keys))
        if len(known):
            i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[i] == keys
            verdict[hit], weight[hit] = flag[i[hit]], back[i[hit]]
        out.append((kind, block, bucket, packed({"verdict": verdict, "back": weight[verdict > 0]})))
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, _TYPES)], names=_NAMES[:4])


def _planes(a: np.ndarray) -> np.ndarray:
    """The bytes of numbers by their place, which packs better."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T)


def _unplanes(a: np.ndarray, dtype) -> np.ndarray:
    return np.ascontiguousarray(a.T).view(dtype).ravel()


def _places(state: dict) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(state["open"], count=len(state["ids"]))).astype(np.int32)


def _keep(state: dict, at: np.ndarray, depth: int, of: np.ndarray | None = None, p: np.ndarray | None = None,
          n: np.ndarray | None = None, total: np.ndarray | None = None, without: np.ndarray | None = None,
          longer: np.ndarray | None = None) -> None:
    """The open places of the state. What follows from the ``depth`` words before a place and its own word is kept once for each pair,
    in the order of the pairs' hashes (``of``: the number of each place's pair in that order, gaps allowed); without ``p`` (before the first states) it follows from the words' counts.
    ``without``: how many contexts in turn were no states; ``longer``, by place: the count of the next longer context where known."""
    mask = np.zeros(len(state["ids"]), bool)
    mask[at] = True
    first = None if of is None else _firsts(of)
    state |= {"open": np.packbits(mask), "places": len(at), "by": depth, "p": None if p is None else _planes((p[first].view(np.uint64) & _PRECISE).view(np.float64)),
              "without": None if without is None else without[first], "n": None if n is None else _planes(n[first].astype(np.int32)),
              "total": None if total is None else _planes(total[first].astype(np.int32)),
              "longer": None if longer is None else _planes(longer.astype(np.int32))}


def _trim(state: dict) -> None:
    """Forget the words after a text's last open place, and the dictionary's words that are left without a place."""
    if not state["places"]:
        for name in ("words", "ids", "rows", "long", "open"):
            state.pop(name, None)
        return
    at, long = _places(state), state["long"]
    starts = np.cumsum(long) - long
    text = np.searchsorted(starts, at, side="right") - 1
    need = np.zeros(len(long), np.int64)
    need[text] = at - starts[text] + 1  # places ascend: the last one stays
    if 4 * need.sum() > 3 * len(state["ids"]) and not state.pop("blanked", False):
        return
    mine = np.arange(len(state["ids"])) - np.repeat(starts, long) < np.repeat(need, long)
    is_open = np.zeros(len(mine), bool)
    is_open[at] = True
    ids = state["ids"][mine]
    used = np.zeros(len(state["words"]), bool)
    used[ids] = used[: len(FEW)] = True
    state |= {"words": state["words"][used], "ids": (np.cumsum(used) - 1).astype(np.int32)[ids], "open": np.packbits(is_open[mine]),
              "rows": state["rows"][need > 0], "long": need[need > 0]}


def _sorted_once(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys, by a sort: ``np.unique`` alone hashes, which takes ten times as long here."""
    keys = np.sort(keys)
    return keys[np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))] if len(keys) else keys


def _firsts(of: np.ndarray) -> np.ndarray:
    """The first place of each number that is there, by the numbers."""
    first = np.full(of.max() + 1 if len(of) else 0, -1, np.int32)
    first[of[::-1]] = np.arange(len(of), dtype=np.int32)[::-1]
    return first[first >= 0]


class _Open:
    """The open places of a block that have ``depth`` words before them, with their contexts and pairs, probability by the shorter
    context, count of the shorter pair, and the count of the context where it is known."""

    def __init__(self, state: dict, depth: int):
        long, at = state["long"], _places(state)
        starts = (np.cumsum(long) - long).astype(np.int32)
        text = (np.searchsorted(starts, at, side="right") - 1).astype(np.int32)
        since, row = at - starts[text], state["rows"][text]
        del text
        far = since >= depth
        if depth:
            far[far] = state["ids"][at[far] - depth] >= len(FEW)  # no frequent context begins with such a word
        mine = (lambda a: a) if far.all() else (lambda a: a[far])  # places that are far already are not copied
        count = state["count"] if state["p"] is None or state["n"] is None else None
        kept = None if state["n"] is None else self._hashes(state, at, state["by"])
        of = None if kept is None else _distinct(kept[1])[2]
        p = (count[state["ids"][at]] + 0.5) / state["denominator"] if state["p"] is None else _unplanes(state["p"], np.float64)[of]
        self.near = (row[~far], p[~far])
        self.p, self.row, self.since = mine(p), mine(row), mine(since)
        del p, row, since
        self.n = mine(count[state["ids"][at]] if state["n"] is None else _unplanes(state["n"], np.int32)[of])
        self.without = np.zeros(len(self.p), np.int8) if state["without"] is None else mine(state["without"][of])
        self.at = mine(at)
        total = next((_unplanes(state[k], np.int32) for k in ("total", "longer") if state[k] is not None), None)
        total = total[of] if state["total"] is not None else total
        self.total = mine(total) if total is not None else count[state["ids"][self.at - 1]] if depth == 1 else None
        self.of = None
        if kept is not None and state["by"] == depth:
            self.ctx, self.pair, self.of = mine(kept[0]), mine(kept[1]), mine(of)
        elif kept is not None and state["by"] == depth - 1:
            self.ctx, kept, of = mine(kept[0]), None, None
            self._lengthen(state, depth)
        else:
            self.ctx, self.pair = self._hashes(state, self.at, depth)

    def _lengthen(self, state: dict, depth: int) -> None:
        """Contexts of ``depth`` words from those of one word less."""
        with np.errstate(over="ignore"):
            self.ctx = self.ctx + state["words"][state["ids"][self.at - depth]] * np.uint64(pow(int(_BACK), depth - 1, 1 << 64))
            self.pair = self.ctx * _NEXT + state["words"][state["ids"][self.at]]

    def deeper(self, state: dict, depth: int, total: np.ndarray | None) -> None:
        """Go over to the places that have ``depth`` words before them, one more than now; ``total``: the counts of those contexts."""
        far = self.since >= depth
        far[far] = state["ids"][self.at[far] - depth] >= len(FEW)
        self.p = self.without = self.pair = self.of = None
        self.total = total
        self.take(far)
        self._lengthen(state, depth)

    @staticmethod
    def _hashes(state: dict, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Contexts of ``depth`` words, and pairs, of places that have as many words before them."""
        word = lambda back: state["words"][state["ids"][at - back]]
        ctx, factor = np.zeros(len(at), np.uint64), np.uint64(1)
        with np.errstate(over="ignore"):
            for j in range(1, depth + 1):
                ctx += word(j) * factor
                factor = factor * _BACK
            return ctx, ctx * _NEXT + word(0)

    def take(self, keep: np.ndarray) -> None:
        for name in ("at", "p", "n", "row", "since", "ctx", "pair", "of", "total", "without"):
            if getattr(self, name) is not None:
                setattr(self, name, getattr(self, name)[keep])


def _close(state: dict, row: np.ndarray, p: np.ndarray) -> None:
    state["closed"] = state["closed"] + np.bincount(row, np.log10(p), len(state["size"]))


def _asks(state: dict, block: int, o: _Open | None, buckets: int) -> Iterator[pa.RecordBatch]:
    """The block, and its messages about the contexts and pairs of the open places."""
    yield _rows(BLOCK, block, payload=_block(state))
    if o:
        learn = state["learn"][o.row]
        if o.total is None:
            keys, _, where = _distinct(o.ctx)
            yield from _messages(CONTEXTS, block, keys, np.bincount(where[learn], minlength=len(keys)), buckets)
        some = o.n >= 2  # a rarer shorter pair cannot be listed here
        keys, _, where = _distinct(o.pair[some])
        yield from _messages(PAIRS, block, keys, np.bincount(where[learn[some]], minlength=len(keys)), buckets)


def _answers(got: pa.Table, kind: int, name: str) -> np.ndarray:
    rows = sorted((b, p) for k, b, p in zip(*(got.column(c).to_pylist() for c in ("kind", "bucket", "payload"))) if k == kind)
    return np.concatenate([unpacked(p)[name] for _, p in rows]) if rows else np.zeros(0)


def _one_table(batches: Iterator[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(list(batches), schema=pa.schema(list(zip(_NAMES, _TYPES))))


def _meet(step):
    """A function of a block's state and its answers, for a cogroup by block."""

    def run(blocks: pa.Table, got: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return _one_table([])
        return _one_table(step(_state(blocks.column("payload")[0].as_py()), blocks.column("block")[0].as_py(), got))

    return run


def _first_level(denominator: float, buckets: int):
    """Word counts arrive: base scores, and the messages of the first level."""

    def step(state, block, got):
        count = np.empty(len(state["words"]), np.int64)
        count[np.argsort(state["words"])] = _answers(got, PAIRS, "answer") // 2  # the answers are sorted by hash
        size, c = state["size"], count[state["ids"]]
        row, p = np.repeat(np.arange(len(size), dtype=np.int32), size), (c + 0.5) / denominator
        state |= {"base": np.bincount(row, np.log10(p), len(size)), "known": np.bincount(row, c > 0, len(size)).astype(np.int64),
                  "closed": np.zeros(len(size)), "count": count, "denominator": denominator, "rows": np.arange(len(size), dtype=np.int32), "long": size}
        few = count < len(FEW)
        state["ids"] = np.where(few, count, np.cumsum(~few) - 1 + len(FEW)).astype(np.int32)[state["ids"]]
        state |= {"words": np.concatenate([FEW, state["words"][~few]]), "count": np.concatenate([np.arange(len(FEW)), count[~few]])}
        before = np.concatenate([[0], c[:-1]])
        before[np.cumsum(size) - size] = 0
        far = before >= LEAST_COUNT
        _close(state, row[~far], p[~far])
        _keep(state, np.flatnonzero(far), 0)
        del row, p, c, before, few, far
        yield from _asks(state, block, _Open(state, 1) if state["places"] else None, buckets)

    return _meet(step)


def _counted(depth: int, buckets: int):
    """Totals of contexts and pairs arrive: rare contexts close their places; listed successors are written by the first block that has
    them, and the verdict on the other contexts is asked for."""

    def step(state, block, got):
        if state["places"]:
            o = _Open(state, depth)
            _close(state, *o.near)
            contexts = None
            if o.total is None:
                known, _, where = _distinct(o.ctx)
                counts = (_answers(got, CONTEXTS, "answer") // 2).astype(np.int32)
                o.total, contexts = counts[where], known[counts > 0]
                del known, where
            total = o.total
            n, mine = np.zeros(len(o.at), np.int32), np.zeros(0, int)
            o.of, o.pair = _distinct(o.pair)[2], None
            some = np.flatnonzero(o.n >= 2).astype(np.int32)
            if len(some):
                of = o.of[some]
                asked = np.zeros(o.of.max() + 1, bool)
                asked[of] = True
                said = _answers(got, PAIRS, "answer").astype(np.int64)
                n[some] = (said // 2)[(np.cumsum(asked, dtype=np.int32) - np.int32(1))[of]]
                mine = some[_firsts(of)[(said % 2 == 1) & (said > 1)]]
                mine = mine[total[mine] > 0]
            if len(mine):
                none = [None] * len(mine)
                cols = [[SUCCESSOR] * len(mine), none, none, none, o.ctx[mine].view(np.int64), n[mine].astype(np.int64), o.p[mine], total[mine].astype(np.int64)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)
            rare = total == 0
            _close(state, o.row[rare], o.p[rare])
            o.n = n
            o.take(~rare)
            _keep(state, o.at, depth, o.of, None if depth == 1 else o.p, o.n, None if depth == 1 else o.total, o.without)
            yield from _messages(VERDICTS, block, _sorted_once(o.ctx) if contexts is None else contexts, None, buckets)
            if depth > 1:
                _trim(state)
        yield _rows(BLOCK, block, payload=_block(state))

    return _meet(step)


def _decided(depth: int, buckets: int, last: bool, idle: int | None):
    """Verdicts arrive: probabilities by the states, and the messages of the next level from the places still open."""

    def step(state, block, got):
        o = _Open(state, depth) if state["places"] else None
        if o:
            where, o.pair = _distinct(o.ctx)[2], None
            verdict = _answers(got, VERDICTS, "verdict").astype(np.int8)
            back = np.ones(len(verdict))
            back[verdict > 0] = _answers(got, VERDICTS, "back")
            verdict, back = verdict[where], back[where]
            del where
            kept = verdict % 2 == 1
            mass = np.where(o.n >= 2, (o.n - DISCOUNT) / o.total, 0.0)
            o.p = np.where(kept, mass + back * o.p, o.p)
            del mass, back
            o.without = np.where(kept, 0, np.minimum(o.without, 100) + 1).astype(np.int8)
            still, longer = (verdict >= 2) & (not last), None
            if idle:
                still &= o.without < idle
            if depth == 1:
                # a context of two words has the count of that pair, and every pair that can be frequent was asked for
                pairs = np.zeros(len(state["ids"]), np.int32)
                pairs[o.at] = o.n
                longer = pairs[o.at - 1]
                still &= longer >= LEAST_COUNT
                longer = longer[still]
            _close(state, o.row[~still], o.p[~still])
            o.take(still)
            if depth == 1:
                # a word that starts a rare pair is in no longer frequent context; it stays beside the open places alone
                needed = np.append(pairs[1:] >= LEAST_COUNT, False)
                needed[o.at] = needed[o.at - 1] = True
                state["ids"] = np.where(needed, state["ids"], np.int32(0))
                state["blanked"] = True
            # of a shorter pair's count only matters whether it is a rarity
            _keep(state, o.at, depth, o.of, o.p, np.minimum(o.n, 2), without=o.without, longer=longer)
            o.deeper(state, depth + 1, longer)
        state.pop("count", None)
        _trim(state)
        yield from _asks(state, block, o, buckets)

    return _meet(step)


def _gains(successors: DataFrame) -> DataFrame:
    """``(ctx, gain, rest_kept, rest, back)`` from successors that know what their context lists and hears in all."""
    n, p, total = F.col("n"), F.col("p"), F.col("total")
    # no longer context gains more by a successor than one that it follows every time
    most = lambda q: F.greatest(n * F.log((n - 1 - DISCOUNT) / (n * q) + DISCOUNT / n), F.lit(0.0))
    left_out = F.greatest(n - 1 - DISCOUNT, F.lit(0.0)) / total + F.col("back") * p
    return successors.withColumn("back", (total - F.col("listed")) / total).groupBy("ctx").agg(
        (F.sum(n * (F.log(left_out) - F.log(p))) + F.max(total - F.col("heard")) * F.log(F.greatest(F.max("back"), F.lit(1e-12)))).alias("gain"),
        F.sum(most((n - DISCOUNT) / total + F.col("back") * p)).alias("rest_kept"), F.sum(most(p)).alias("rest"), F.max("back").alias("back"))


def _states(listed: DataFrame, depth: int) -> DataFrame:
    """``(ctx, flag, back)`` of the contexts that are states (flag 1) or leave enough to gain (flag 2), from their listed successors.

    Successors are dealt once, by context, and summed there twice; those of the few hot contexts stay where they lie and get their
    context's sums by a broadcast."""
    n = F.col("n")
    totals = staged(listed.groupBy("ctx").agg(F.sum(n - DISCOUNT).alias("listed"), F.sum("n").alias("heard"), F.count(F.lit(1)).alias("k")),
                    f"lm-totals-{depth}")
    whole = totals.agg(F.sum("k")).first()[0] or 0
    # at most 1 / HOT_SHARE contexts
    hot = [r["ctx"] for r in totals.where(F.col("k") > max(HOT_SHARE * whole, LEAST_HOT)).select("ctx").collect()]
    is_hot = F.col("ctx").isin(hot) if hot else F.lit(False)
    rows, mine = listed.select("ctx", "n", "p", "total"), Window.partitionBy("ctx")
    summed = rows.where(~is_hot).withColumns({"listed": F.sum(n - DISCOUNT).over(mine), "heard": F.sum("n").over(mine)})
    if hot:
        few = F.broadcast(totals.where(is_hot).select("ctx", "listed", "heard"))
        summed = _gains(summed).unionByName(_gains(rows.where(is_hot).join(few, "ctx")))
    else:
        summed = _gains(summed)
    kept = F.col("gain") > LEAST_GAIN
    still = F.when(kept, F.col("rest_kept")).otherwise(F.col("rest")) > LEAST_GAIN
    out = staged(summed.select("ctx", (kept.cast("int") + 2 * still.cast("int")).alias("flag"), "back").where("flag > 0"), f"lm-states-{depth}")
    drop_staged(totals)
    return out


@dataclass
class Fitted:
    """Training tokens, and the number of states of each depth from one."""

    states: list[int]
    tokens: int


@contextlib.contextmanager
def _tidy(spark: SparkSession):
    """A writer of tables, none of which outlive this; shuffle files go with the query that wrote them; small Arrow batches, and few
    rows, with their payloads, read at once. The caller's settings come back."""
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.columnarReaderBatchSize": str(READ_ROWS)}
    parts, tables = min(shuffle_partitions(spark), MOST_PARTS), []
    before = {k: spark.conf.get(k, None) for k in conf}

    def written(rows: DataFrame, name: str, listed: bool = False) -> _Written:
        tables.append(_Written(rows, name, parts, listed))
        return tables[-1]

    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        with arrow_batches(spark):
            yield written
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        for table in tables:
            table.drop()


class _Written:
    """Rows of several kinds written once as a table of the shared folder, a folder for each kind, bucketed by block: answers are
    dealt to the buckets that their blocks already lie in, and the blocks, much the larger side, are never shuffled."""

    def __init__(self, rows: DataFrame, name: str, parts: int, listed: bool):
        self.spark, self.path = rows.sparkSession, scratch_path(rows.sparkSession, name)
        self.table = f"lm_{uuid.uuid4().hex}"
        # payloads are packed already, and each differs
        writer = rows.write.partitionBy("kind").bucketBy(parts, "block").option("parquet.enable.dictionary#payload", "false")
        writer.option("compression", "snappy" if listed else "none").option("path", self.path).saveAsTable(self.table)

    def of(self, *kinds: int) -> DataFrame:
        """Rows of some kinds that are there."""
        return self.spark.table(self.table).where(F.col("kind").isin(*kinds))

    def messages(self, *kinds: int) -> DataFrame:
        return self.of(*kinds).select(*_NAMES[:4])

    def drop(self, *kinds: int) -> None:
        """Delete what is read no more: some kinds, or all."""
        for kind in kinds:
            delete_folder(self.spark, f"{self.path}/kind={kind}")
        if not kinds:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            delete_folder(self.spark, self.path)


def fit_and_encode(docs: DataFrame, learn: Column, held: Column, id_col: str = "doc_id", text_col: str = "text",
                   depth: int | None = None, idle: int | None = IDLE) -> tuple[Fitted, DataFrame]:
    """The tree learned from the rows ``learn`` marks, and all rows scored by it, in blocks.

    ``depth`` is the most words of a context, None for no bound; ``idle`` the contexts of a place that in turn are no states
    after which no longer one is tested there, None for no such end."""
    spark = docs.sparkSession
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("binary").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(held, F.lit(False)).alias("held_out"))
    least = shuffle_partitions(spark)
    with _tidy(spark) as written:
        now, buckets = written(_blocks(rows, least), "lm-blocks"), least

        def answered(least_of: dict[int, int]) -> DataFrame:
            asked = now.messages(PAIRS, CONTEXTS)
            answers = staged(asked.groupBy("bucket").applyInArrow(_added_up(least_of), _MESSAGE), "lm-answers")
            now.drop(PAIRS, CONTEXTS)
            return answers

        def met(step, answers: DataFrame, name: str, listed: bool = False) -> _Written:
            mine = now.messages(BLOCK).groupBy("block").cogroup(answers.where("block >= 0").groupBy("block"))
            after = written(mine.applyInArrow(step, _ROWS), name, listed)
            drop_staged(answers)
            now.drop()
            return after

        answers = answered({PAIRS: 0})
        sums = [unpacked(bytes(r["payload"]))["sums"] for r in answers.where("block < 0").select("payload").collect()]
        tokens, seen, _ = (int(x) for x in np.sum(sums, axis=0)) if sums else (0, 0, 0)
        # a token is asked for at most once a level as a context and once as part of a pair
        buckets = max(least, -(-2 * tokens // BUCKET_KEYS))
        now = met(_first_level(tokens + 0.5 * (seen + 1), buckets), answers, "lm-level-0")
        states: list[int] = []
        while (depth is None or len(states) < depth) and now.messages(PAIRS, CONTEXTS).take(1):
            at = len(states) + 1
            now = met(_counted(at, buckets), answered({PAIRS: 2, CONTEXTS: LEAST_COUNT}), f"lm-counted-{at}", listed=True)
            contexts = _states(now.of(SUCCESSOR).select("ctx", "n", "p", "total"), at)
            asked = now.messages(VERDICTS)
            verdicts = staged(asked.groupBy("bucket").cogroup(contexts.withColumn("bucket", _bucket(F.col("ctx"), buckets)).groupBy("bucket"))
                              .applyInArrow(_judged, _MESSAGE), "lm-verdicts")
            now.drop(VERDICTS, SUCCESSOR)
            states.append(contexts.where("flag % 2 = 1").count())
            drop_staged(contexts)
            now = met(_decided(at, buckets, at == depth, idle), verdicts, f"lm-level-{at}")
        encoded = staged(now.messages(BLOCK).mapInArrow(_scored, _SCORED), "lm-scores")
        now.drop()
    while states and not states[-1]:
        states.pop()
    return Fitted(states, tokens), encoded


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column("payload").to_pylist():
            s = _state(payload)
            if s["places"]:  # open where the depth is bounded
                o = _Open(s, 0)
                _close(s, o.row, o.p)
            yield pa.record_batch([pa.array(s["doc"], pa.int64()), pa.array(s["held"], pa.bool_()), pa.array(s["size"], pa.int64()),
                                   pa.array(s["known"]), pa.array(s["base"]), pa.array(s["closed"])], names=[c.split()[0] for c in _SCORED.split(", ")])


def scores(fitted: Fitted, encoded: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per text."""
    return encoded.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(fitted.tokens).cast("long").alias("train_tokens"),
                          "base_score", "score")
