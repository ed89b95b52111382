"""Personal data in whole texts: exact patterns, and a skip-chain conditional random field that carries their labels on.

The patterns (e-mail, IP, card, phone; leftmost and non-overlapping for each kind, with their checks) always stand. The field
then labels the words of a text that hold a digit or ``@``; any other word is fixed as plain. Its potentials are features
of a word, one table for neighbours, and one weight a label for words of the same document that repeat each other share
their last seven digits or what stands before an ``@`` (each linked to the one before it, so ``m`` equal words make ``m - 1`` links). Words
under a pattern are evidence. Marginals come from loopy sum-product message passing over all documents of a batch at once; neighbouring
words whose label has a marginal of ``LEAST`` or more and that touch no pattern become a span of their own: a number that stands
with its country code in one place is found without it in another.

Training: pseudo-likelihood by Adam in numpy, on words of at most ``FIT_DOCS`` distinct texts (the ones of least hash) and
``FIT_WORDS`` words of each, labelled by the patterns; telling or all features are hidden from shares of the words, so that
neighbours and repeats get weight. Everything else covers all rows and whole texts in one Arrow pass.

Defined cases: a NULL text is empty and has no spans; rows that repeat stay rows, each with its spans; without a word to learn from,
only the patterns speak; texts of any length are whole. Only the id and text columns are read, the id is any long or NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import arrow_batches, quoted, staged

KINDS = ("email", "ip", "card", "phone")
#: Labels of the field: 0 is plain, k + 1 is KINDS[k].
LABELS = len(KINDS) + 1
#: Distinct texts and words of each that the field learns from, shares of their words whose telling features, or all, are hidden.
FIT_DOCS, FIT_WORDS, HIDDEN, BLIND = 4000, 64, 0.25, 0.15
#: Marginal of an added span, greatest weight of a repeat, rounds of message passing at most, change that ends them, damping.
LEAST, MOST_SKIP, ROUNDS, SETTLED, DAMPING = 0.95, 3.0, 100, 1e-4, 0.3
STEPS, RATE, PENALTY = 300, 0.05, 1e-3
#: Digits at the end that two similar numbers share.
TAIL = 7

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match starts at the first digit of its run: from a later one it would fail alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS, _MARK = re.compile("[0-9]"), re.compile("[0-9@]")
_WHITE, _NOT_WHITE = " \t\n\x0b\x0c\r", re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS_ONLY = {c: None for c in map(ord, " ().-+")}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def small_parts(ip: str) -> bool:
    return all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in ip.split("."))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: only a run of local characters right before an ``@`` can start one, and a run never holds an ``@``."""
    found, at, low = [], text.find("@"), 0
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
        low = m.end() if m else at + 1
        at = text.find("@", low)
    return found


def patterns(text: str) -> list[list[tuple[int, int]]]:
    """The spans of each kind, by place."""
    found: list[list[tuple[int, int]]] = [emails(text), [], [], []]
    if _DIGITS.search(text):
        found[1] = [m.span() for m in _IP.finditer(text) if small_parts(m[0])]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                found[2].append(m.span())
        if "+" in text:
            found[3] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(m[0].translate(_DIGITS_ONLY)) <= 15]
    return found


@dataclass
class Words:
    """The words of some texts that hold a digit or ``@``: their text, place, own core, label (0 also where unknown), whether that is
    evidence, and whether the word before it in the list is its neighbour in the text."""

    text: list[str]
    doc: list[int]
    core: list[tuple[int, int]]
    label: list[int]
    known: list[bool]
    follows: list[bool]


def words_of(texts: list[str], spans: list[list[list[tuple[int, int]]]]) -> Words:
    out = Words([], [], [], [], [], [])
    for doc, (text, found) in enumerate(zip(texts, spans)):
        every = sorted((s, e, k + 1) for k, kind in enumerate(found) for s, e in kind)
        covered, high = 0, [0]
        for s, e, _ in every:
            high.append(max(high[-1], e))
        end = 0
        m = _MARK.search(text)
        while m:
            start = max(end, *(text.rfind(c, end, m.start()) + 1 for c in _WHITE))
            after = _NOT_WHITE.match(text, m.start()).end()
            gap = text[end:start] if out.doc and out.doc[-1] == doc else "x"
            word = text[start:after]
            left, right = 0, len(word)
            while left < right and not (word[left].isalnum() or word[left] in "+("):
                left += 1
            while right > left and not word[right - 1].isalnum():
                right -= 1
            # the first span that ends after the word's start, by the running greatest end
            while covered < len(every) and high[covered + 1] <= start:
                covered += 1
            label = 0
            for s, e, k in every[covered:]:
                if s >= after:
                    break
                if e > start:
                    label = k
                    break
            out.text.append(word)
            out.doc.append(doc)
            out.core.append((start + left, start + right))
            out.label.append(label)
            out.known.append(bool(label))
            out.follows.append(not gap.strip(_WHITE))
            end = after
            m = _MARK.search(text, end)
    return out


FEATURES = 34
#: Features that all but name a label; training hides them at times.
TELLING = (1, 2, 4, 15, 16, 18, 21, 23, 27)


def features(words: Words) -> np.ndarray:
    """0/1 features of each word; those on the digits of the whole run of neighbouring numbers look beyond it."""
    n = len(words.text)
    x = np.zeros((n, FEATURES), np.float32)
    digits = ["".join(_DIGITS.findall(w)) for w in words.text]
    bare = [not w.translate(_DIGITS_ONLY).strip("0123456789,;:!?") for w in words.text]
    run_start = 0
    for i, w in enumerate(words.text):
        core, d, f = w.lstrip("\"'<[{"), digits[i], x[i]
        f[0] = 1
        if "@" in w:
            f[1] = bool(emails(w))
            f[2] = bool(_DOMAIN.search(w, w.find("@") + 1))
            f[3] = 1
        f[4] = core.startswith("+") and bool(d)
        f[5] = "(" in w or ")" in w
        f[6] = bool(re.search("[0-9]-[0-9]", w))
        size = len(d)
        f[7 + (size > 2) + (size > 3) + (size > 4) + (size > 7) + (size > 11) + (size > 15) + (size > 19)] = size > 0
        f[15] = bool(m := _IP.search(w)) and small_parts(m[0])
        f[16] = bool(m)
        f[17] = bool(re.search("[0-9][.][0-9]", w)) and not m
        f[18] = 16 <= size <= 19 and luhn(d)
        f[19] = 16 <= size <= 19 and not luhn(d)
        f[20] = bare[i]
        f[21] = i > 0 and words.follows[i] and words.text[i - 1].startswith("+")
        f[22] = any(c.isalpha() for c in w)
        f[23] = bool(re.search("^[(]?[0-9]{3}[)]?[-. ]?[0-9]{3}-[0-9]{4}", core))
        f[24] = size == 4 and bare[i]
        f[28] = bool(re.search("[A-Za-z][0-9]|[0-9][A-Za-z]", w))
        f[29] = len(w) > 24
        f[30] = any(c in w for c in "=\"'<>/_:")
        f[31] = bool(re.fullmatch("[(][0-9]{3}[)]", w))
        f[32] = bool(re.fullmatch("[0-9]{3}-[0-9]{4}[.,;!?]?", w))
        f[33] = "%" in w or "$" in w
        last = i + 1 == n or not (words.follows[i + 1] and bare[i + 1] and bare[i])
        if last:
            whole = "".join(digits[run_start:i + 1])
            x[run_start:i + 1, 25] = 8 <= len(whole) <= 15
            x[run_start:i + 1, 26] = 16 <= len(whole) <= 19
            x[run_start:i + 1, 27] = 16 <= len(whole) <= 19 and luhn(whole)
            run_start = i + 1
    return x


def chains(words: Words) -> np.ndarray:
    """(i, i + 1) of neighbours."""
    i = np.flatnonzero(np.array(words.follows, bool))
    return np.stack([i - 1, i], 1)


def skips(words: Words) -> np.ndarray:
    """(earlier, later) of words of a document that repeat each other or end in the same digits, each with the last one before it."""
    last: dict = {}
    found = []
    for i, (w, doc) in enumerate(zip(words.text, words.doc)):
        d = "".join(_DIGITS.findall(w))
        bare = w.partition("@")[0] or w
        key = (doc, d[-TAIL:]) if len(d) >= TAIL and "@" not in w else (doc, bare.strip("\"'()<>[]{}.,;:!?").casefold())
        if len(key[1]) < 4:
            continue
        j = last.get(key)
        if j is not None and not (j == i - 1 and words.follows[i]):
            found.append((j, i))
        last[key] = i
    return np.array(found, np.int64).reshape(-1, 2)


@dataclass
class Field:
    """Weights of the features, of neighbouring labels, and of a label that a repeated word shares."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def potentials(self, words: Words, x: np.ndarray) -> np.ndarray:
        """Log potential of each label of each word; plain neighbours are part of it, evidence decides it."""
        u = x @ self.unary
        follows = np.array(words.follows, bool)
        last = np.append(~follows[1:], True)
        u += np.where(follows[:, None], 0, self.chain[0][None]) + np.where(last[:, None], self.chain[:, 0][None], 0)
        known = np.array(words.known, bool)
        u[known] = -30.0
        u[known, np.array(words.label)[known]] = 30.0
        return u


def marginals(u: np.ndarray, edges: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Label marginals by damped loopy sum-product; ``edges`` (i, j), ``tables`` the log potential [label of i, label of j] of each."""
    n, m = len(u), len(edges)
    if not m:
        return _normal(u)
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    order = np.argsort(target, kind="stable")
    heads, first = np.unique(target[order], return_index=True)
    message = np.zeros((2 * m, u.shape[1]))

    def belief():
        b = u.astype(np.float64).copy()
        b[heads] += np.add.reduceat(message[order], first)
        return b

    for _ in range(ROUNDS):
        out = (belief()[source] - message[back])[:, :, None] + table
        top = out.max(1)
        out = top + np.log(np.exp(out - top[:, None]).sum(1))
        out -= out.max(1, keepdims=True)
        new = DAMPING * message + (1 - DAMPING) * out
        change = np.abs(new - message).max()
        message = new
        if change < SETTLED:
            break
    return _normal(belief())


def _normal(logs: np.ndarray) -> np.ndarray:
    p = np.exp(logs - logs.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def label_words(field: Field, words: Words) -> np.ndarray:
    chain, skip = chains(words), skips(words)
    tables = np.concatenate([np.broadcast_to(field.chain, (len(chain), LABELS, LABELS)),
                             np.broadcast_to(np.diag(field.skip), (len(skip), LABELS, LABELS))])
    return marginals(field.potentials(words, features(words)), np.concatenate([chain, skip]), tables)


def added_spans(words: Words, p: np.ndarray, docs: int, least: float = LEAST) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, marginal) of each document: neighbouring words of one certain label and no evidence."""
    out: list[list] = [[] for _ in range(docs)]
    label = np.where(p[:, 1:].max(1) >= least, p[:, 1:].argmax(1) + 1, 0) if len(p) else np.zeros(0, int)
    label[np.array(words.known, bool)] = 0
    at = None
    for i, k in enumerate(label.tolist()):
        if not k or words.core[i][0] >= words.core[i][1]:
            at = None
            continue
        if at is not None and words.follows[i] and at[0] == k - 1:
            at[2], at[3] = words.core[i][1], min(at[3], float(p[i, k]))
        else:
            at = [k - 1, *words.core[i], float(p[i, k])]
            out[words.doc[i]].append(at)
    return [sorted(map(tuple, spans)) for spans in out]


def _evidence(texts: list[str]) -> np.ndarray:
    """Training rows of one text: features, label, labels of the neighbours before and after, and how many linked words have each label."""
    words = words_of(texts, [patterns(t) for t in texts])
    n = len(words.text)
    label = np.array(words.label, np.int64)
    rows = np.zeros((n, FEATURES + 3 + LABELS), np.int8)
    rows[:, :FEATURES] = features(words)
    follows = np.array(words.follows, bool)
    rows[:, FEATURES] = label
    rows[1:, FEATURES + 1] = np.where(follows[1:], label[:-1], 0)
    rows[:-1, FEATURES + 2] = np.where(follows[1:], label[1:], 0)
    many = np.zeros((n, LABELS), np.int64)
    for i, j in skips(words):
        many[i, label[j]] += 1
        many[j, label[i]] += 1
    rows[:, FEATURES + 3:] = many
    return rows


def train(rows: np.ndarray, seed: int = 12) -> Field:
    """Pseudo-likelihood of each word's label given the labels around it."""
    rng = np.random.default_rng(seed)
    x = rows[:, :FEATURES].astype(np.float64)
    luck = rng.random(len(x))
    x[np.ix_(luck < HIDDEN + BLIND, np.array(TELLING))] = 0
    x[luck < BLIND, 1:] = 0
    y, one = rows[:, FEATURES].astype(int), np.eye(LABELS)
    before, after, linked = one[rows[:, FEATURES + 1].astype(int)], one[rows[:, FEATURES + 2].astype(int)], rows[:, FEATURES + 3:].astype(np.float64)
    w = [np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(LABELS)]
    mean, square = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for step in range(1, STEPS + 1):
        p = _normal(x @ w[0] + before @ w[1] + after @ w[1].T + linked * w[2])
        miss = (one[y] - p) / len(y)
        for k, g in enumerate((x.T @ miss, before.T @ miss + miss.T @ after, (linked * miss).sum(0))):
            g = g - PENALTY * w[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            w[k] += RATE * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
        w[2] = np.clip(w[2], 0, MOST_SKIP)
    return Field(*w)


def fit(docs: DataFrame, text_col: str = "text", fit_docs: int = FIT_DOCS) -> Field | None:
    """The field learned from a bounded sample of distinct texts, by the patterns; None where no text has a word to learn from."""
    text = quoted(text_col).cast("string")
    marked = docs.select(text.alias("text")).where(text.rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    distinct = marked.agg(F.approx_count_distinct("h")).first()[0]
    share = max(1, distinct // (2 * fit_docs))
    few = marked.where(F.pmod("h", F.lit(share)) == 0).groupBy("h").agg(F.min("text").alias("text")).orderBy("h").limit(fit_docs)

    def run(batches):
        for b in batches:
            found = [_evidence([t]) for t in b.column("text").to_pylist()]
            cut = [r if len(r) <= FIT_WORDS else r[np.linspace(0, len(r) - 1, FIT_WORDS).astype(int)] for r in found]
            yield pa.record_batch([pa.array([r.tobytes() for r in cut], pa.binary())], names=["rows"])

    with arrow_batches(docs.sparkSession):
        got = b"".join(bytes(r["rows"]) for r in few.mapInArrow(run, "rows binary").collect())
    rows = np.frombuffer(got, np.int8).reshape(-1, FEATURES + 3 + LABELS)
    return train(rows) if len(rows) else None


_SPAN = "array<struct<kind: string, start: int, end: int, marginal: double>>"


def find_personal_data(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, spans)`` of each row: the patterns' spans, and these with the ones the field adds (marginal 1 for a pattern), both by
    kind and place in code points, end exclusive."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            base = [patterns(t) for t in texts]
            words = words_of(texts, base)
            added = added_spans(words, label_words(field, words), len(texts)) if field and words.text else [[]] * len(texts)
            first = [[(k, s, e, 1.0) for k, found in enumerate(kinds) for s, e in found] for kinds in base]
            out = [[[{"kind": KINDS[k], "start": s, "end": e, "marginal": p} for k, s, e, p in sorted(spans)] for spans in col]
                   for col in (first, [f + a for f, a in zip(first, added)])]
            yield pa.record_batch([b.column("doc_id"), pa.array(out[0], kind), pa.array(out[1], kind)], names=["doc_id", "base", "spans"])

    with arrow_batches(docs.sparkSession):
        return staged(rows.mapInArrow(run, f"doc_id long, base {_SPAN}, spans {_SPAN}"), "personal-data")
