from __future__ import annotations

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from llm_cases import EXTRA, SF
from pyspark.sql import functions as F

from aerolake.llm import conversation_repair as R
from aerolake.llm.queries import damaged, op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        elif k == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        out.append(R.BLANK if not bare else R.DUPLICATE if (role, text) in seen else R.CUT if bare[-1] not in ".!?" else R.FINE)
        seen.add((role, text))
    return out


def by_listing(rows, faults):
    """Every edit string of a short conversation, listed; None marks a string that is not a repair."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    forced = {"": "u", "s": "u", "u": "a", "a": "u"}
    found = []

    def go(i, state, cost, audit):
        if cost > 4 * len(rows) + 6 or len(audit) > 2 * len(rows) + 3:
            return
        if i == len(rows) and state in ("", "a"):
            found.append((cost, audit))
        if not audit.endswith("III"):
            go(i, forced[state], cost + 3, audit + "I")
        if i < len(rows):
            go(i + 1, state, cost + 4, audit + "D")
            if faults[i] not in (R.BLANK, R.DUPLICATE):
                extra = 3 if faults[i] == R.CUT else 0
                role = rows[i][2][:1]
                if (state, role) in legal:
                    go(i + 1, legal[state, role], cost + extra, audit + "K")
                go(i + 1, forced[state], cost + 3 + extra, audit + "R")

    go(0, "", 0, "")
    return min(found)


def test_every_short_conversation_is_repaired_as_by_listing():
    kinds = [(r, f) for r in "suaX" for f in (R.FINE, R.CUT)] + [("u", R.BLANK)]
    for n in range(4):
        for conv in itertools.product(kinds, repeat=n):
            rows = [(0, i, r, f"t{i}") for i, (r, _) in enumerate(conv)]
            runs = R.collapsed([(R.symbol_of(r, f), 1) for r, f in conv])
            assert R.repair(runs) == by_listing(rows, [f for _, f in conv]), conv


def test_longer_conversations_with_runs():
    rng = np.random.default_rng(4)
    for _ in range(60):
        conv = [("suaX"[rng.choice(4, p=[.1, .45, .35, .1])], rng.choice([R.FINE, R.CUT, R.BLANK], p=[.7, .2, .1])) for _ in range(rng.integers(1, 5))]
        conv = [c for c in conv for _ in range(rng.integers(1, 3))]
        rows = [(0, i, r, f"t{i}") for i, (r, _) in enumerate(conv)]
        assert R.repair(R.collapsed([(R.symbol_of(r, f), 1) for r, f in conv])) == by_listing(rows, [f for _, f in conv]), conv


def test_powers_equal_row_by_row():
    """A run of any length costs and reads the same as its rows one by one, however it is halved."""
    rng = np.random.default_rng(6)
    symbols = [R.symbol_of(r, f) for r in "suaX" for f in (R.FINE, R.CUT, R.BLANK)]
    for _ in range(40):
        runs = [(symbols[rng.integers(len(symbols))], int(rng.integers(1, 400))) for _ in range(4)]
        whole = R.repair(R.collapsed(runs))
        singles = [(s, 1) for s, n in runs for _ in range(n)]
        assert whole == R.repair(singles)
        price, audit = whole
        assert audit.count("I") + sum(n for _, n in runs) == len(audit)
    price, audit = R.repair([(R.symbol_of("u", R.FINE), 1 << 40)] * 0 + [(R.symbol_of("u", R.FINE), 100_001)])
    assert audit[-1] in "IDKR" and price > 0


def plain(rows):
    """conv -> the whole result by the definition."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(plain_damage([r for r in rows if r[0] == conv]), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        if not own:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        faults, turns = faults_of(own), [r[1] for r in own if r[1] is not None]
        first = [r[2][:1] for r in own]
        runs = R.collapsed([(R.symbol_of(i, f), 1) for i, f in zip(first, faults)])
        cost, audit = R.repair(runs) if len(own) > 5 else by_listing(own, faults)
        text = "\n".join(f"{r}:{t}" for r, t in R.rebuilt(audit, [(r[2], r[3], 1) for r in own]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in (R.BLANK, R.DUPLICATE, R.CUT)),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_query_equals_the_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(*(c.split()[0] for c in SCHEMA.split(", "))).collect()]
    got = op13_conversation_repair(spark, SF)
    assert dict(got.dtypes) == {"conv_id": "bigint", "audit": "string", "repaired_sha256": "string"} | dict.fromkeys(
        ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint")
    assert as_dict(got) == plain(rows)


HARD_ROWS = [
    (1, None, "user", None), (1, None, "user", "x."), (1, 2, None, "hm."), (1, 2, "", "y"), (1, 7, "assistant", "ok."),
    (None, 0, "system", "Be kind."), (None, None, "user", "Hi?"), (None, 3, "assistant", "Hello!"), (2, 0, "user", "same."),
    (2, 0, "user", "same."), (2, 1, "user", "same."), (3, None, None, None), (4, 5, "system", "only"), (5, 1, "user", "é ß 漢字 😀 \x00 \x85"),
    (5, 2, "assistant", "word " * 60_000 + "."), (6, 0, "user", " \t\n"), (6, 1, "user", "a.\n\x0b "), (6, 2, "user", "a.  "),
] + [(7, 5, "user", "again.")] * 300 + [(8, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.") for i in range(500)]


@pytest.mark.parametrize("clashing", [False, True])
def test_hard_rows(spark, clashing):
    docs = spark.createDataFrame(HARD_ROWS, SCHEMA).repartition(5)
    names = (*EXTRA, "place", "n", "fault", "audit", "cost", "initial", "same", "first", "copies")
    docs = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)]) if clashing else docs
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert as_dict(R.repair_conversations(damaged(docs), copies=F.col("copies"))) == plain(HARD_ROWS)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_whole_turns_and_empty_table(spark):
    docs = spark.createDataFrame(HARD_ROWS, SCHEMA)
    none = docs.where("false")
    assert R.repair_conversations(none).count() == 0 and R.repair_conversations(none, turns=True).count() == 0
    turns = R.repair_conversations(docs, turns=True).orderBy("conv_id", "place").collect()
    initials = {}
    for r in turns:
        initials[r["conv_id"]] = initials.get(r["conv_id"], "") + r["role"][:1]
    import re

    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())
    assert initials[8] == "ua" * 250 and [r["text"] for r in turns if r["conv_id"] == 8][:2] == ["turn 0.", "turn 1."]
