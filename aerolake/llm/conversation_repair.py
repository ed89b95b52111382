"""Repair of the turn structure of conversations by a run-length dynamic program.

A repaired conversation is empty, or an optional system turn and then user and assistant turns in turn:
its role initials match ``(s?(ua)+)?``. Edits: Keep a row (0), Rerole it to user or assistant (3), Delete it (4),
Insert an empty user or assistant turn (3). Blank and repeated rows must be deleted; a truncated row that
stays costs 3 more. The audit is the string of the edits' initials of the cheapest repair, the ASCII-least of several.

A row is a symbol (role initial and fault), a conversation a list of runs of equal symbols. The work left
from each of the four grammar states is a vector; a run of ``k`` rows takes it back by the cached binary
powers of the symbol's min-plus transition, so its cost takes ``log k`` steps. The choices are then unrolled from
the front: halves of a run are entered through the powers again, so no vector is kept for each row.

On Spark: equal rows are added up before they are shuffled, repeats are found by a grouped minimum, rows are dealt by ranges
of (conversation, turn, role) and numbered; the dynamic program reads only the symbols, and a last pass
streams the texts past their audit. A conversation's audit is one string and its SHA-256 is one chain, so one task
streams each conversation in these two passes; it holds the runs and the audit, never the texts.

Defined cases: nulls in role and text are one space, so a NULL text is blank; a NULL conversation id is a
conversation of its own; NULL turns come first, and rows of one turn are ordered by role and text;
equal rows repeat each other; a text of any length is one row; no rows give no conversations.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import arrow_batches, drop_staged, quoted, shuffle_partitions, staged

# Prices of the edits and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: Where an inserted or reroled turn leads; its role follows from that.
FORCED = (USER, USER, ASSISTANT, USER)
#: Where a kept row leads, by its role initial.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = frozenset({"su", "ua", "au"})
NEVER = 1 << 40
#: Faults, in the order in which they count.
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Rows of a run that are unrolled one after the other.
STEP_ROWS = 64

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
Symbol = tuple[str, bool, bool]


def symbol_of(initial: str, fault: int) -> Symbol:
    """(initial, must go, truncated); rows that must go are one symbol whatever their role."""
    return ("", True, False) if fault in (BLANK, DUPLICATE) else (initial if initial in KEPT else "", False, fault == CUT)


def row_edits(symbol: Symbol, state: int) -> list[tuple[str, int, int]]:
    """(letter, price, next state) of the edits of one row, in ASCII order of their letters."""
    initial, must_go, cut = symbol
    edits = [("D", DELETE, state)]
    if not must_go:
        extra = TRUNCATED if cut else 0
        if state in KEPT.get(initial, {}):
            edits.append(("K", KEEP + extra, KEPT[initial][state]))
        edits.append(("R", REROLE + extra, FORCED[state]))
    return edits


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(x + y for x, y in zip(row, col)) for col in zip(*b)) for row in a)


@functools.cache
def inserts() -> Matrix:
    """Price of any number of inserted turns between two states."""
    one = tuple(tuple(0 if s == t else INSERT if FORCED[s] == t else NEVER for t in range(4)) for s in range(4))
    two = times(one, one)
    return times(two, two)


@functools.cache
def power(symbol: Symbol, j: int) -> Matrix:
    """Transition of ``2**j`` rows of a symbol, inserts before each of them included."""
    if j:
        return times(power(symbol, j - 1), power(symbol, j - 1))
    row = tuple(tuple(min((c for _, c, u in row_edits(symbol, s) if u == t), default=NEVER) for t in range(4)) for s in range(4))
    return times(inserts(), row)


def at_end() -> Vector:
    return tuple(min(row[t] for t in ACCEPTING) for row in inserts())


@functools.cache
def _over_power(symbol: Symbol, j: int, after: Vector) -> tuple[int, Vector]:
    v = [min(x + y for x, y in zip(row, after)) for row in power(symbol, j)]
    low = min(v)
    return low, tuple(x - low for x in v)


def before(symbol: Symbol, count: int, after: Vector) -> tuple[int, Vector]:
    """The work left before ``count`` rows of a symbol, given that after them: (least price, what each state adds to it)."""
    whole, j = 0, 0
    while count:
        if count & 1:
            low, after = _over_power(symbol, j, after)
            whole += low
        count, j = count >> 1, j + 1
    return whole, after


@functools.cache
def _one_row(symbol: Symbol, after: Vector, state: int) -> tuple[str, int]:
    """The letters of one row, inserts before it included, and the state after it."""
    low, v = before(symbol, 1, after)
    left, letters = tuple(low + x for x in v), ""
    while True:
        for letter, price, to in row_edits(symbol, state):
            if letter > "I" and left[state] == INSERT + left[FORCED[state]]:
                break
            if left[state] == price + after[to]:
                return letters + letter, to
        letters, state = letters + "I", FORCED[state]


def unroll(symbol: Symbol, count: int, after: Vector, state: int, out: list[str]) -> int:
    """Add the letters of ``count`` rows of a symbol to ``out``; the state after them."""
    if count > STEP_ROWS:
        half = count // 2
        state = unroll(symbol, count - half, before(symbol, half, after)[1], state, out)
        return unroll(symbol, half, after, state, out)
    rest = [after]
    for _ in range(count - 1):
        rest.append(before(symbol, 1, rest[-1])[1])
    for v in reversed(rest):
        letters, state = _one_row(symbol, v, state)
        out.append(letters)
    return state


def repair(runs: list[tuple[Symbol, int]]) -> tuple[int, str]:
    """Price and audit of the cheapest repair of a conversation given as runs of equal symbols."""
    after = [at_end()]
    price = 0
    for symbol, count in reversed(runs):
        low, v = before(symbol, count, after[-1])
        price += low
        after.append(v)
    price += after[-1][START]
    state, out = START, []
    for (symbol, count), v in zip(runs, reversed(after[:-1])):
        state = unroll(symbol, count, v, state, out)
    while state not in ACCEPTING:
        out.append("I")
        state = FORCED[state]
    return price, "".join(out)


def collapsed(symbols: Iterable[tuple[Symbol, int]]) -> list[tuple[Symbol, int]]:
    runs: list[tuple[Symbol, int]] = []
    for symbol, count in symbols:
        if count and runs and runs[-1][0] == symbol:
            runs[-1] = (symbol, runs[-1][1] + count)
        elif count:
            runs.append((symbol, count))
    return runs


class _Conversation:
    """One conversation's counts and runs, filled row by row."""

    def __init__(self):
        self.turns, self.low, self.high, self.last_turn = 0, None, None, None
        self.faults, self.illegal, self.initial, self.runs = [0] * 4, 0, None, []

    def add(self, turn: int | None, initial: str, fault: int, n: int) -> None:
        """``n`` equal rows, of which all but the first repeat it."""
        if not n:
            return
        if turn is not None and turn != self.last_turn:
            self.turns, self.low, self.high, self.last_turn = self.turns + 1, turn if self.low is None else self.low, turn, turn
        self.illegal += n - 1 + (self.initial is not None and self.initial + initial not in LEGAL)
        self.initial = initial
        again = BLANK if fault == BLANK else DUPLICATE
        self.faults[fault] += 1
        self.faults[again] += n - 1
        for symbol, count in ((symbol_of(initial, fault), 1), (symbol_of(initial, again), n - 1)):
            if count and self.runs and self.runs[-1][0] == symbol:
                self.runs[-1] = (symbol, self.runs[-1][1] + count)
            elif count:
                self.runs.append((symbol, count))

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], self.illegal, *repair(self.runs)


_AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _AUDIT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]
    now, conv, out = None, None, []

    def batch():
        cols = list(zip(*out)) or [()] * len(names)
        out.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    for b in batches:
        for conv_id, turn, initial, fault, n in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "n"))):
            if conv is None or conv_id != now:
                if conv:
                    out.append((now, *conv.result()))
                now, conv = conv_id, _Conversation()
            conv.add(turn, initial, fault, n)
        if out:
            yield batch()
    if conv:
        out.append((now, *conv.result()))
        yield batch()


def rebuilt(audit: str, rows: Iterable[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """The repaired turns (role, text) of rows (role, text, copies) by their audit."""
    state, at = START, 0

    def forced() -> tuple[str, str]:
        nonlocal state
        state = FORCED[state]
        return "user" if state == USER else "assistant"

    for role, text, n in rows:
        for _ in range(n):
            while audit[at] == "I":
                at += 1
                yield forced(), ""
            letter, at = audit[at], at + 1
            if letter == "K":
                state = KEPT[role[:1]][state]
                yield role, text
            elif letter == "R":
                yield forced(), text
    for _ in audit[at:]:
        yield forced(), ""


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, Iterator[tuple[str, str, int]]]]:
    """(id, audit, its rows as they come) of rows sorted so that the audit is first."""
    def rows():
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "n")))

    ahead = rows()
    head = next(ahead, None)

    def own():
        nonlocal head
        head = next(ahead, None)
        while head is not None and head[1] is None:
            yield head[2:]
            head = next(ahead, None)

    while head is not None:
        part = own()
        yield head[0], head[1], part
        for _ in part:
            pass


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, digests = [], []

    def batch():
        out = pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
        ids.clear()
        digests.clear()
        return out

    for conv_id, audit, rows in _conversations(batches):
        sha = hashlib.sha256()
        for i, (role, text) in enumerate(rebuilt(audit, rows)):
            sha.update(f"{chr(10) if i else ''}{role}:{text}".encode())
        ids.append(conv_id)
        digests.append(sha.hexdigest())
        if len(ids) >= 10_000:
            yield batch()
    if ids:
        yield batch()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    size = 0

    def batch():
        cols = list(zip(*out))
        out.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                               names=["conv_id", "place", "role", "text"])

    for conv_id, audit, rows in _conversations(batches):
        for i, (role, text) in enumerate(rebuilt(audit, rows)):
            out.append((conv_id, i, role, text))
            size += len(text)
            if len(out) >= 1000 or size > 4 << 20:
                size = 0
                yield batch()
    if out:
        yield batch()


def _ordered(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies) -> DataFrame:
    """Equal rows added up, with their fault, in the order of their conversation (``place``); written once."""
    spark = rows.sparkSession
    plain = rows.select(
        quoted(conv_col).cast("long").alias("conv_id"), quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(quoted(text_col).cast("string"), F.lit(" ")).alias("text"), copies.cast("long").alias("n"))
    # a row without copies only names its conversation
    there = F.col("n") > 0
    plain = plain.select("conv_id", *[F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")], "n")
    added = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn(
        "same", F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256))
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    first = added.where(there).groupBy("same").agg(F.min(order).alias("first"))
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = (F.when(F.length(bare) == 0, BLANK).when(order > F.col("first"), DUPLICATE)
             .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT).otherwise(FINE))
    keys = ("conv_id", "turn", "role", "text")
    found = (added.join(first, "same", "left").select(*keys, "n", fault.alias("fault"))
             .repartitionByRange(shuffle_partitions(spark), *keys[:3]).sortWithinPartitions(*keys)
             .withColumn("place", F.monotonically_increasing_id()))
    return staged(found, "repair-rows")


def _audits(rows: DataFrame) -> DataFrame:
    few = rows.select("conv_id", "place", "turn", F.coalesce(F.substring("role", 1, 1), F.lit("")).alias("initial"), "fault", "n")
    dealt = few.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "place")
    return staged(dealt.drop("place").mapInArrow(_audited, _AUDIT), "repair-audits")


def _with_audit(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The audit of each conversation, followed by its rows."""
    heads = audits.select("conv_id", F.lit(-1).cast("long").alias("place"), "audit", F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("n"))
    body = rows.where("n > 0").select("conv_id", "place", F.lit(None).cast("string").alias("audit"), "role", "text", "n")
    return (heads.unionByName(body).repartition(shuffle_partitions(rows.sparkSession), "conv_id")
            .sortWithinPartitions("conv_id", "place"))


def repair_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", copies=None, turns: bool = False) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of each conversation, or with
    ``turns`` the repaired turns ``(conv_id, place, role, text)``. ``copies``: how often each row stands there (0: only its id counts)."""
    spark = rows.sparkSession
    with arrow_batches(spark):
        ordered = _ordered(rows, conv_col, turn_col, role_col, text_col, F.lit(1) if copies is None else copies)
        audits = _audits(ordered)
        dealt = _with_audit(ordered, audits)
        if turns:
            out = staged(dealt.mapInArrow(_turns, "conv_id long, place long, role string, text string"), "repair-turns")
        else:
            digests = dealt.mapInArrow(_digests, "conv_id long, repaired_sha256 string")
            same = audits["conv_id"].eqNullSafe(digests["conv_id"])
            out = staged(audits.join(digests, same).select(audits["*"], "repaired_sha256"), "repair-result")
    drop_staged(ordered)
    drop_staged(audits)
    return out
