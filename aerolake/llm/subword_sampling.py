"""SentencePiece segmentations sampled without replacement by Gumbel top-k.

A text's lattice holds every way to cut it into pieces of the vocabulary. Backward sums give each
lattice edge its probability, so a segmentation is a walk from the root, and a perturbed search finds the
``k`` with the largest Gumbel-perturbed log-probabilities without listing the others: the root's perturbed
value is the best any segmentation reaches; a walk drawn edge by edge attains it; at each step the edges not
taken form a branch whose best value is a Gumbel of the branch's mass, truncated at the
walk's. The open branch with the largest value is always expanded next (A-star with exact bounds), so
the walks come out in order, distinct, and distributed as draws without replacement. The value of the
best branch left open is the threshold of the inclusion scores.

No piece joins two characters that are never neighbours inside a piece, so the lattice is cut there; the
lattice of each distinct stretch is built once and walks are drawn for all stretches at a time. Random
numbers are hashes of (seed, row key, sample, place): they do not depend on batches or partitions.

Piece scores: a piece of rank r weighs as log(1 / (r + 2)), since the scores of a BPE model are ranks and
not probabilities; a character without a piece is spelled in bytes, each of the last rank.

Defined cases: a NULL or empty text has one segmentation, with no pieces; a text with fewer than ``k``
segmentations gives all it has, each of inclusion score 1; rows that repeat a key get equal samples; a NULL key
counts as the text "null". Only the key and text columns are read.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, single_threaded, small_batches

SAMPLES, SEED = 2, 17
REMEMBERED = 300_000
_SPACE = "▁"
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64: a 64-bit hash of 64-bit counters."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def uniform(stream: np.ndarray, place: np.ndarray) -> np.ndarray:
    """In (0, 1), by stream and place."""
    with np.errstate(over="ignore"):
        return ((_mix(stream + _mix(place.astype(np.uint64))) >> _U(11)).astype(np.float64) + 0.5) / 2.0**53


class _Grown:
    """An array that is appended to."""

    def __init__(self, dtype, start=()):
        self.a, self.n = np.empty(1 << 16, dtype), 0
        self.add(np.array(start, dtype))

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.a):
            bigger = np.empty(max(2 * len(self.a), self.n + len(more)), self.a.dtype)
            bigger[:self.n] = self.a[:self.n]
            self.a = bigger
        self.a[self.n:self.n + len(more)] = more
        self.n += len(more)

    def view(self) -> np.ndarray:
        return self.a[:self.n]


_BASE = _U(0x100000001B3)


class Lattices:
    """Edges of the lattices of distinct stretches, in flat arrays sorted by the node they leave."""

    def __init__(self, model_path: str):
        single_threaded()
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = self.model.get_piece_size()
        usable = [i for i in range(n) if not (self.model.is_unknown(i) or self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        self.piece = {self.model.id_to_piece(i): i for i in usable}
        self.byte = np.array([self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.weight = -np.log(np.arange(n) + 2.0)
        self.byte_weight = -math.log(n + 2)
        self.joins = np.array(sorted({(ord(p[i]) << 32) | ord(p[i + 1]) for p in self.piece for i in range(len(p) - 1)}), np.int64)
        # every beginning of a piece by its rolling hash, with the id where it is a piece itself
        known = {p[:i]: self.piece.get(p[:i], -1) for p in self.piece for i in range(1, len(p) + 1)}
        self.longest = max(map(len, self.piece))
        hashes = np.array([self._hash(p) for p in known], np.uint64)
        order = np.argsort(hashes)
        self.known, self.known_id = hashes[order], np.array(list(known.values()), np.int32)[order]
        # bytes of each id, for decoding
        text = [b""] * n
        for p, i in self.piece.items():
            text[i] = p.replace(_SPACE, " ").encode()
        for value, i in enumerate(self.byte):
            text[i] = bytes([value])
        self.text_len = np.array([len(t) for t in text])
        self.text_at = np.cumsum(self.text_len) - self.text_len
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.forget()

    @staticmethod
    def _hash(s: str) -> int:
        h = 0
        for c in s:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.units, self.unit_at = _Grown(np.int64), _Grown(np.int64)
        self.stretch: dict[str, int] = {}
        self.new: list[str] = []
        self.first, self.last, self.node_edges = _Grown(np.int64), _Grown(np.int64), _Grown(np.int64, [0])
        self.to, self.log_p, self.cum, self.id = _Grown(np.int64), _Grown(np.float64), _Grown(np.float64), _Grown(np.int32)
        self.arrays = None

    def _build(self) -> None:
        """The lattices of the new stretches, all at a time: matches by length, backward sums by distance from the end."""
        size = np.array([len(s) for s in self.new])
        chars = np.frombuffer("".join(self.new).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(size)), size)
        rem = (np.cumsum(size))[owner] - np.arange(len(chars))
        live, h, found = np.arange(len(chars)), np.zeros(len(chars), np.uint64), []
        lonely = np.ones(len(chars), bool)
        for length in range(1, self.longest + 1):
            fits = rem[live] >= length
            live, h = live[fits], h[fits]
            with np.errstate(over="ignore"):
                h = h * _BASE + chars[live + length - 1] + _U(1)
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            hit = self.known[at] == h
            live, h, ids = live[hit], h[hit], self.known_id[at[hit]]
            whole = ids >= 0
            found.append((live[whole], np.full(whole.sum(), length), ids[whole]))
            if length == 1:
                lonely[live[whole]] = False
            if not len(live):
                break
        spelled = np.flatnonzero(lonely)
        found.append((spelled, np.ones(len(spelled), np.int64), -1 - chars[spelled].astype(np.int64)))
        start, length, ids = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-length, start))  # long pieces, the likely ones, first
        start, length, ids = start[order], length[order], ids[order]
        weight = np.where(ids >= 0, self.weight[np.maximum(ids, 0)], self.byte_weight * self._utf8_len(-1 - ids))
        # a stretch of n characters has n + 1 nodes, the last without edges
        node, beta = start + owner[start], np.zeros(len(chars) + len(size))
        to = node + length
        far = rem[start]
        by_far = np.argsort(far, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(far[by_far])) + 1, [len(by_far)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            e = by_far[lo:hi]
            value = weight[e] + beta[to[e]]
            group = np.concatenate([[0], np.flatnonzero(np.diff(node[e])) + 1])
            top = np.maximum.reduceat(value, group)
            spread = np.diff(np.concatenate([group, [len(e)]]))
            beta[node[e[group]]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, spread)), group))
        log_p = np.minimum(weight + beta[to] - beta[node], 0.0)
        edges = np.bincount(node, minlength=len(beta))
        ends = np.cumsum(edges)
        log_p[edges[node] == 1] = 0.0
        p = np.exp(log_p)
        total = np.cumsum(p)
        before = np.concatenate([[0.0], total])[(ends - edges)[node]]
        base_node, base_edge = self.node_edges.n - 1, self.to.n
        cum = np.round(np.clip(total - before, 0.0, 1.0), 12)  # as if no other stretch were there
        closing = ends[edges > 0] - 1
        cum[closing] = 1.0
        nodes = np.cumsum(size + 1)
        self.first.add(base_node + nodes - size - 1)
        self.last.add(base_node + nodes - 1)
        self.node_edges.add(base_edge + ends)
        self.to.add(base_node + to)
        self.log_p.add(log_p)
        self.cum.add(cum)
        self.id.add(ids)
        self.new, self.arrays = [], None

    @staticmethod
    def _utf8_len(c: np.ndarray) -> np.ndarray:
        return 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)

    def _cut(self, words: list[str]) -> None:
        """Cut new words into stretches wherever no piece joins two neighbours."""
        size = np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        pair = (chars[:-1] << 32) | chars[1:]
        at = np.minimum(np.searchsorted(self.joins, pair), len(self.joins) - 1)
        cut = np.ones(len(chars) + 1, bool)
        cut[1:-1] = self.joins[at] != pair
        ends = np.cumsum(size)
        cut[ends] = True
        places = np.flatnonzero(cut[1:]) + 1
        joined, stretch, known, out = "".join(words), self.stretch, len(self.stretch), []
        for lo, hi in zip([0, *places.tolist()], places.tolist()):
            s = joined[lo:hi]
            code = stretch.get(s)
            if code is None:
                code = stretch[s] = known
                known += 1
                self.new.append(s)
            out.append(code)
        per_word = np.diff(np.concatenate([[0], np.searchsorted(places, ends, side="right")]))
        self.unit_at.add(self.units.n + np.cumsum(per_word) - per_word)
        self.units.add(np.array(out, np.int64))
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The stretches of all texts, each text's leading space included, and their number for each text."""
        spaced = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "")
        # a word is a run of spaces and what follows it; only runs of more than one space need the pattern
        odd = pc.match_substring_regex(spaced, f"  |{_SPACE}").to_numpy(zero_copy_only=False)
        if odd.any():
            split = [re.findall("\u2581+[^\u2581]*", t.replace(" ", _SPACE)) if t != " " else [] for t in spaced.to_pylist()]
            counts = np.array([len(w) for w in split], dtype=np.int64)
            coded = pa.array([w for ws in split for w in ws], pa.string()).dictionary_encode()
            words = coded.dictionary.to_pylist()
        else:
            split = pc.list_slice(pc.split_pattern(spaced, " "), 1)
            empty = pc.equal(spaced, " ").to_numpy(zero_copy_only=False)
            counts = np.where(empty, 0, pc.list_value_length(split).to_numpy(zero_copy_only=False))
            full = pa.array(~empty)
            coded = split.filter(full).flatten().dictionary_encode()
            words = [_SPACE + w for w in coded.dictionary.to_pylist()]
        new = [w for w in words if w not in self.words]
        if new:
            self._cut(new)
        if not words:
            return np.zeros(0, np.int64), counts
        known = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        codes = known[coded.indices.to_numpy(zero_copy_only=False)]
        at, ends = self.unit_at.view(), np.append(self.unit_at.view()[1:], self.units.n)
        n = (ends - at)[codes]
        total = np.cumsum(n)
        units = self.units.view()[np.repeat(at[codes] - (total - n), n) + np.arange(total[-1])]
        return units, np.diff(np.concatenate([[0], np.concatenate([[0], total])[np.cumsum(counts)]]))

    def frozen(self) -> dict[str, np.ndarray]:
        if self.new:
            self._build()
        if self.arrays is None:
            self.arrays = {k: getattr(self, k).view() for k in ("first", "last", "node_edges", "to", "log_p", "cum", "id")}
        return self.arrays

    def draw(self, at: np.ndarray, end: np.ndarray, stream: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A walk from each node ``at`` to its ``end``: edges in order and the position in ``at`` each belongs to."""
        a = self.frozen()
        at, live = at.copy(), np.flatnonzero(at != end)
        owner, taken, step = [], [], 0
        while len(live):
            here = at[live]
            u = uniform(stream[live], place[live] * 65536 + step)
            e, target = a["node_edges"][here], u
            wait = np.flatnonzero(a["cum"][e] <= target)
            while len(wait):
                e[wait] += 1
                wait = wait[a["cum"][e[wait]] <= target[wait]]
            owner.append(live)
            taken.append(e)
            there = a["to"][e]
            at[live] = there
            live = live[there != end[live]]
            step += 1
        if not owner:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, taken = np.concatenate(owner), np.concatenate(taken)
        order = np.argsort(owner, kind="stable")
        return taken[order], owner[order]

    def ids_of(self, edges: np.ndarray) -> np.ndarray:
        ids = self.frozen()["id"][edges]
        spelled = np.flatnonzero(ids < 0)
        if not len(spelled):
            return ids
        n = np.ones(len(ids), np.int64)
        n[spelled] = self._utf8_len(-1 - ids[spelled])
        out, at = np.repeat(ids, n), np.cumsum(n) - n
        for i in spelled:
            raw = chr(-1 - ids[i]).encode("utf-8", "surrogatepass")
            out[at[i]:at[i] + len(raw)] = self.byte[list(raw)]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation, without the model's leading space."""
        n = self.text_len[ids]
        ends = np.cumsum(n)
        raw = self.text[np.repeat(self.text_at[ids] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        return raw.removeprefix(b" ").decode("utf-8", "replace")


class _Walks:
    """One sampled segmentation of each of several texts, and the branches they left open.

    ``docs`` are the texts, ``size`` their edges each, ``unit`` the stretch each edge is in; branches before ``turn`` belong to the walk
    this one turned from, and the branch at ``turn`` also lacks the ``gone`` edges.
    """

    def __init__(self, lat: dict, docs: np.ndarray, edges: np.ndarray, size: np.ndarray, unit: np.ndarray, value: np.ndarray,
                 stream: np.ndarray, turn: np.ndarray | None = None, gone: list[tuple[int, ...]] | None = None):
        self.docs, self.edges, self.size, self.unit, self.value = docs, edges, size, unit, value
        self.at = np.cumsum(size) - size
        self.row = {int(d): i for i, d in enumerate(docs)}
        lp = lat["log_p"][edges]
        total = np.concatenate([[0.0], np.cumsum(lp)])
        base = np.repeat(total[self.at], size)
        self.total = total[self.at + size] - total[self.at]
        place = np.arange(len(edges)) - np.repeat(self.at, size)
        rest = -np.expm1(lp)
        self.turn = self.at + (turn if turn is not None else 0)
        self.gone = gone
        if gone is not None:
            for i, j in enumerate(self.turn):
                node = lat["node_of"](edges[j])
                others = [e for e in range(lat["node_edges"][node], lat["node_edges"][node + 1]) if e not in gone[i] and e != edges[j]]
                rest[j] = np.exp(lat["log_p"][others]).sum()
        noise = -np.log(uniform(np.repeat(stream, size), place))
        with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
            phi = np.round(total[:-1] - base, 9) + np.log(rest)  # as if no other text were there
            # a Gumbel of location phi, truncated at the walk's own value
            self.open = phi - np.log(np.exp(np.minimum(phi - np.repeat(value, size), 700)) + noise)
        self.open[rest < 1e-15] = -np.inf
        if turn is not None:
            self.open[place < np.repeat(turn, size)] = -np.inf

    def best(self, n: int) -> np.ndarray:
        out = np.full(n, -np.inf)
        out[self.docs] = np.maximum.reduceat(self.open, self.at) if len(self.docs) else out[self.docs]
        return out


def stream_of(key, seed: int, sample: int, kind: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{seed}/{key}/{sample}/{kind}")


def top_samples(lattices: Lattices, units: np.ndarray, counts: np.ndarray, keys: list, k: int, seed: int
                ) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text (``counts`` of the ``units`` each) its ``k`` best samples, best first:
    edges, log-probability, perturbed value, inclusion score."""
    lat = dict(lattices.frozen())
    edges_at = lat["node_edges"]
    lat["node_of"] = lambda e: int(np.searchsorted(edges_at, e, side="right") - 1)
    n, empty = len(counts), [(np.zeros(0, np.int64), 0.0, 0.0, 1.0)]
    out: list[list] = [empty if not c else [] for c in counts]
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    first_unit = np.cumsum(counts) - counts

    def streams(docs, sample: int, kind: int) -> np.ndarray:
        return np.array([stream_of(keys[d], seed, sample, kind) for d in docs], np.uint64)

    doc_of = np.repeat(np.arange(n), counts)
    place = np.arange(len(units)) - first_unit[doc_of]
    draws = np.zeros(n, np.uint64)
    draws[full] = streams(full, 0, 0)
    edges, owner = lattices.draw(lat["first"][units], lat["last"][units], draws[doc_of], place)
    size = np.bincount(doc_of[owner], minlength=n)[full]
    root = -np.log(-np.log(uniform(streams(full, 0, 2), np.zeros(len(full), np.int64))))
    walks = [_Walks(lat, full, edges, size, owner, root, streams(full, 0, 1))]
    for sample in range(1, k):
        best = np.stack([w.best(n) for w in walks])
        which, top = best.argmax(axis=0), best.max(axis=0)
        docs = np.flatnonzero(top > -np.inf)
        if not len(docs):
            break
        draws[docs] = streams(docs, sample, 0)
        spins = uniform(streams(docs, sample, 3), np.zeros(len(docs), np.int64))
        turns, prefixes, prefix_units, gone, nodes, ends, tail_doc, tail_place, tail_unit = [], [], [], [], [], [], [], [], []
        for d, spin in zip(docs, spins):
            w = walks[which[d]]
            i = w.row[int(d)]
            j = int(w.at[i] + w.open[w.at[i]:w.at[i] + w.size[i]].argmax())
            node = lat["node_of"](w.edges[j])
            without = (int(w.edges[j]),) + (w.gone[i] if w.gone is not None and j == w.turn[i] else ())
            w.open[j] = -np.inf  # the branch lives on in the new walk
            options = [e for e in range(edges_at[node], edges_at[node + 1]) if e not in without]
            mass = np.cumsum(np.exp(lat["log_p"][options]))
            turn = options[min(int(np.searchsorted(mass, spin * mass[-1], side="right")), len(options) - 1)]
            unit = int(w.unit[j])
            after = np.arange(unit + 1, first_unit[d] + counts[d])
            turns.append(j - w.at[i])
            gone.append(without)
            prefixes.append(np.append(w.edges[w.at[i]:j], turn))
            prefix_units.append(np.append(w.unit[w.at[i]:j], unit))
            nodes += [lat["to"][turn:turn + 1], lat["first"][units[after]]]
            ends += [lat["last"][units[unit:unit + 1]], lat["last"][units[after]]]
            tail_doc.append(np.full(len(after) + 1, d))
            tail_place.append(place[unit:first_unit[d] + counts[d]])
            tail_unit.append(np.append(unit, after))
        tail_doc, tail_unit = np.concatenate(tail_doc), np.concatenate(tail_unit)
        tail, owner = lattices.draw(np.concatenate(nodes), np.concatenate(ends), draws[tail_doc], np.concatenate(tail_place))
        tail_sizes = np.bincount(tail_doc[owner], minlength=n)[docs]
        cut = np.cumsum(tail_sizes)[:-1]
        parts = [x for pair in zip(prefixes, np.split(tail, cut)) for x in pair]
        unit_parts = [x for pair in zip(prefix_units, np.split(tail_unit[owner], cut)) for x in pair]
        walks.append(_Walks(lat, docs, np.concatenate(parts), np.array([len(x) for x in prefixes]) + tail_sizes, np.concatenate(unit_parts),
                            top[docs], streams(docs, sample, 1), np.array(turns), gone))
    threshold = np.stack([w.best(n) for w in walks]).max(axis=0)
    for w in walks:
        for i, d in enumerate(w.docs):
            lp = float(w.total[i])
            score = 1.0 if threshold[d] == -np.inf else -math.expm1(-math.exp(min(lp - threshold[d], 700)))
            out[d].append((w.edges[w.at[i]:w.at[i] + w.size[i]], lp, float(w.value[i]), score))
    return out


@functools.cache
def _lattices(path: str) -> Lattices:
    """One memory of lattices for each worker process: its tasks run one after the other."""
    return Lattices(path)


def sample_segmentations(docs: DataFrame, model_path: str, k: int = SAMPLES, seed: int = SEED, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``(doc_id, sample, ids, log_prob, perturbed, inclusion, decoded)``: up to ``k`` rows for each row."""
    names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "inclusion", "decoded"]

    def run(batches):
        lattices = _lattices(model_path)
        for batch in batches:
            if len(lattices.words) > REMEMBERED:
                lattices.forget()
            keys = batch.column("doc_id").to_pylist()
            units, counts = lattices.encode(batch.column("text"))
            out = {n: [] for n in names}
            for key, samples in zip(keys, top_samples(lattices, units, counts, ["null" if i is None else i for i in keys], k, seed)):
                for i, (edges, lp, value, score) in enumerate(samples):
                    ids = lattices.ids_of(edges)
                    for n, v in zip(names, (key, i, ids, lp, value, score, lattices.decode(ids))):
                        out[n].append(v)
            offsets = np.cumsum([0, *map(len, out["ids"])], dtype=np.int32)
            flat = np.concatenate(out["ids"]) if out["ids"] else np.zeros(0, np.int32)
            yield pa.record_batch([pa.array(out["doc_id"], pa.int64()), pa.array(out["sample"], pa.int32()),
                                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                                   *(pa.array(out[n], pa.float64()) for n in names[3:6]), pa.array(out["decoded"], pa.string())], names=names)

    small_batches(docs.sparkSession)
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, decoded string")
