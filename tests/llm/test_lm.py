from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import HARD, SF, hard_docs, no_docs
from pyspark.sql import functions as F

from aerolake.llm import suffix_tree_lm as M
from aerolake.llm.queries import op7_suffix_tree_lm
from aerolake.plans.inspect import plan_text


def ascii_lower(t):
    return (t or "").encode().lower().split()


def plain_base(rows):
    """doc -> (held out, n_tokens, n_known, N, base score) by the definition."""
    rem = [zlib.crc32(str(i).encode()) % 5 if i is not None else None for i, _ in rows]
    c, ends = Counter(), 0
    for (_, t), r in zip(rows, rem):
        if r is not None and r != 1:
            c.update(ascii_lower(t))
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + (1 if ends else 0)
    p = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return [(i, r == 1, len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, sum(p(c[x]) for x in w) + p(ends))
            for (i, t), r in zip(rows, rem) for w in [ascii_lower(t)]]


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 3))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6), (g, w)


NAMES = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")


def test_query_base_and_gain(spark):
    got = op7_suffix_tree_lm(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    close([tuple(r[n] for n in NAMES) for r in got], plain_base([(d["doc_id"], d["text"]) for d in docs]))
    train = [r for r in got if not r["held_out"]]
    assert sum(r["score"] for r in train) > sum(r["base_score"] for r in train)


def test_hard_rows(spark):
    from aerolake.llm.common import held_out, learns_from

    i = F.col("doc_id")
    for docs in (hard_docs(spark), hard_docs(spark, True)):
        fitted = M.fit_and_encode(docs, learns_from(i, 5, 1), held_out(i, 5, 1))
        got = M.scores(*fitted).collect()
        close([tuple(r[n] for n in NAMES) for r in got], plain_base([(r[0], r[1]) for r in HARD]))
        assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got)
    none = M.scores(*M.fit_and_encode(no_docs(spark), F.lit(True), F.lit(False)))
    assert none.count() == 0
    unseen = M.scores(*M.fit_and_encode(hard_docs(spark), F.lit(False), F.lit(False))).collect()
    assert len(unseen) == len(HARD) and all(r["train_tokens"] == r["n_known"] == 0 for r in unseen)


def test_settings_come_back_and_scratch_goes(spark):
    import pathlib

    from aerolake.session import checkpoint_root

    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(k) for k in keys]
    root = pathlib.Path(checkpoint_root(spark).replace("file:", "")) / "aerolake-scratch"
    there = {p.name for p in root.iterdir()} if root.exists() else set()
    docs = spark.createDataFrame([(d, "a b c d") for d in range(40)], "doc_id long, text string")
    M.scores(*M.fit_and_encode(docs, F.lit(True), F.lit(False))).collect()
    assert [spark.conf.get(k) for k in keys] == before
    assert all(n.startswith("lm-scores") for n in {p.name for p in root.iterdir()} - there)


def plain_scores(rows, deepest):
    """Scores by the definition: every frequent context of up to ``deepest`` words is tested, shortest first. ``rows``: (learn, words)."""
    texts = [(learn, [*w, None]) for learn, w in rows]
    base = Counter(w for learn, t in texts if learn for w in t)
    whole = sum(base.values()) + 0.5 * (len(base) + 1)
    p = [[(base[w] + 0.5) / whole for w in t] for _, t in texts]
    states = []
    for d in range(1, deepest + 1):
        seen, shorter = {}, {}
        for (learn, t), q in zip(texts, p):
            for i in range(d, len(t)):
                if learn:
                    seen.setdefault(tuple(t[i - d:i]), Counter())[t[i]] += 1
                    shorter[tuple(t[i - d:i]), t[i]] = q[i]
        kept = {}
        for c, after in seen.items():
            total, many = sum(after.values()), {w: n for w, n in after.items() if n >= 2}
            back = (total - sum(n - M.DISCOUNT for n in many.values())) / total
            gain = sum(n * math.log(((max(n - 1 - M.DISCOUNT, 0) / total) + back * shorter[c, w]) / shorter[c, w]) for w, n in many.items())
            gain += (total - sum(many.values())) * math.log(max(back, 1e-12))
            if total >= M.LEAST_COUNT and gain > M.LEAST_GAIN:
                kept[c] = ({w: (n - M.DISCOUNT) / total for w, n in many.items()}, back)
        for (_, t), q in zip(texts, p):
            for i in range(d, len(t)):
                if tuple(t[i - d:i]) in kept:
                    mass, back = kept[tuple(t[i - d:i])]
                    q[i] = mass.get(t[i], 0) + back * q[i]
        states.append(len(kept))
    return states, [sum(map(math.log10, q)) for q in p]


def test_words_beyond_any_rank_are_contexts_and_successors(spark, monkeypatch):
    """Rare words are contexts and successors like frequent ones: scores are those of the definition."""
    rng = np.random.default_rng(5)
    rows = []
    for d in range(150):
        words = []
        for _ in range(20):
            k = int(rng.integers(12))
            words += [*["the"] * int(rng.integers(1, 4)), f"rare{k}", f"next{k}" if rng.random() < 0.9 else "other"]
        rows.append((d, words))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    for tokens, keys in ((1 << 21, 1 << 21), (2000, 6000)):  # also several blocks and buckets
        monkeypatch.setattr(M, "BLOCK_TOKENS", tokens)
        monkeypatch.setattr(M, "BUCKET_KEYS", keys)
        fitted, encoded = M.fit_and_encode(docs.repartition(3), F.col("doc_id") < 120, F.col("doc_id") >= 120, depth=2)
        got = {r["doc_id"]: r["score"] for r in M.scores(fitted, encoded).collect()}
        states, want = plain_scores([(d < 120, w) for d, w in rows], 2)
        assert fitted.states == states and states[0] >= 12
        assert [got[d] for d, _ in rows] == pytest.approx(want, rel=1e-9)


def test_contexts_grow_as_long_as_they_tell(spark):
    """A word set by the four before it, in a text that is random otherwise: states of more than two words, as by the definition."""
    rng = np.random.default_rng(11)
    rows = []
    for d in range(260):
        words = []
        for _ in range(12):
            a, b, c, e = rng.integers(3, size=4)
            words += [f"a{a}", f"b{b}", f"c{c}", f"d{e}", f"z{(a + b + c + e) % 3}"]
        rows.append((d, words))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    learn, held = F.col("doc_id") < 200, F.col("doc_id") >= 200
    fitted, encoded = M.fit_and_encode(docs, learn, held, idle=None)
    states, want = plain_scores([(d < 200, w) for d, w in rows], len(fitted.states))
    assert fitted.states == states and len(states) >= 4 and states[3] >= 40
    got = {r["doc_id"]: r["score"] for r in M.scores(fitted, encoded).collect()}
    assert [got[d] for d, _ in rows] == pytest.approx(want, rel=1e-9)
    two = M.scores(*M.fit_and_encode(docs, learn, held, depth=2)).where("held_out").agg(F.sum("score")).first()[0]
    assert sum(got[d] for d in range(200, 260)) > 0.9 * two


def test_contexts_behind_levels_without_a_state(spark):
    """A word set by the three before it and by no one or two of them: the states of three words are found all the same."""
    rng = np.random.default_rng(13)
    rows = []
    for d in range(240):
        words = []
        for _ in range(14):
            a, b, c = rng.integers(2, size=3)
            words += [f"a{a}", f"b{b}", f"c{c}", f"z{a ^ b ^ c}"]
        rows.append((d, words))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    fitted, encoded = M.fit_and_encode(docs, F.col("doc_id") < 200, F.lit(False), idle=None, depth=4)
    states, want = plain_scores([(d < 200, w) for d, w in rows], len(fitted.states))
    assert fitted.states == states and len(states) >= 3 and states[2] >= 8
    got = {r["doc_id"]: r["score"] for r in M.scores(fitted, encoded).collect()}
    assert [got[d] for d, _ in rows] == pytest.approx(want, rel=1e-9)


def test_copies_of_a_text_are_learned_deep(spark):
    """A group of copies, with other texts: scores by the definition at every depth."""
    rng = np.random.default_rng(17)
    copy = [f"w{x}" for x in rng.integers(400, size=60)]
    rows = [(d, copy if d % 3 == 0 else [f"w{x}" for x in rng.integers(400, size=40)]) for d in range(90)]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    fitted, encoded = M.fit_and_encode(docs, F.col("doc_id") < 75, F.lit(False))
    states, want = plain_scores([(d < 75, w) for d, w in rows], len(fitted.states))
    assert fitted.states == states
    got = {r["doc_id"]: r["score"] for r in M.scores(fitted, encoded).collect()}
    assert [got[d] for d, _ in rows] == pytest.approx(want, rel=1e-9)


def test_successors_are_dealt_once_and_hot_contexts_stay(spark, monkeypatch):
    """One shuffle of whole successors whatever their number; contexts summed where they lie give the same verdicts."""
    plans = []

    def staged(df, name):
        plans.append((name, plan_text(df, "simple")))
        return df

    monkeypatch.setattr(M, "staged", staged)
    monkeypatch.setattr(M, "drop_staged", lambda df: None)
    listed = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).cast("long").alias("ctx"), (2 + F.col("id") % 5).alias("n"),
        (1 / (10 + F.col("id") % 97)).alias("p"), F.when(F.col("id") % 3 == 0, 30_000).when(F.col("id") % 500 == 0, 30_000).otherwise(90).cast("long").alias("total"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if there were too many contexts to broadcast
    try:
        got = []
        for share, least in ((1 / 400, 64), (1, 10**9), (0, 0)):  # some are hot, none, all
            monkeypatch.setattr(M, "HOT_SHARE", share)
            monkeypatch.setattr(M, "LEAST_HOT", least)
            got.append({r["ctx"]: (r["flag"], pytest.approx(r["back"])) for r in M._states(listed, 1).collect()})
        assert got[0] == got[1] == got[2] and 0 in got[0] and len(got[0]) > 100
        found = [p for name, p in plans if name.startswith("lm-states")]
        assert all("SortMergeJoin" not in p for p in found)
        assert found[1].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_distinct_keys_as_by_unique():
    """Also keys that differ in the low bits only, where the places stand while sorting."""
    rng = np.random.default_rng(3)
    wide = rng.integers(1, 1 << 63, 500, dtype=np.uint64)
    for keys in (wide[rng.integers(500, size=4000)], wide[rng.integers(3, size=4000)] + rng.integers(9, size=4000).astype(np.uint64),
                 np.full(7, np.uint64(M.END.view(np.uint64))), wide[:1], wide[:0]):
        known, first, where = M._distinct(keys)
        want = np.unique(keys, return_index=True, return_inverse=True)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip((known, first, where), want))


def test_steps_hold_few_bytes_a_word(monkeypatch):
    """What the steps of the first level allocate for a block, by its words: an executor has to hold two blocks' steps beside its heap."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    rng = np.random.default_rng(23)
    words = [f"w{x}".encode() for x in range(3000)]
    texts = [b" ".join(words[x] for x in (3000 * rng.random(1000) ** 3).astype(int)) for _ in range(300)]
    docs = pa.record_batch([pa.array(range(300), pa.int64()), pa.array(texts), pa.array([d % 5 != 1 for d in range(300)]),
                            pa.array([d % 5 == 1 for d in range(300)])], names=["doc_id", "text", "learn", "held_out"])
    monkeypatch.setattr(M, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    n = sum(len(t.split()) + 1 for t in texts)

    def split(rows):
        whole = M._one_table(rows)
        kind = whole.column("kind").to_numpy()
        return whole.filter(pa.array(kind == M.BLOCK)), whole.filter(pa.array(kind > M.BLOCK)), whole.filter(pa.array(kind == M.SUCCESSOR))

    def answered(least, asked):
        answers = M._added_up(least)(asked)
        return answers.filter(pa.array(answers.column("block").to_numpy() >= 0))

    def step(run, block, answers):
        tracemalloc.start()
        rows = run(block, answers).to_batches()
        most.append(tracemalloc.get_traced_memory()[1] / n)
        tracemalloc.stop()
        return split(rows)

    most = []
    block, asked, _ = split(M._blocks(SimpleNamespace(mapInArrow=lambda run, _: run(iter([docs]))), 1))
    block, asked, _ = step(M._first_level(n + 0.5 * 3002, 1), block, answered({M.PAIRS: 0}, asked))
    block, asked, listed = step(M._counted(1, 1), block, answered({M.PAIRS: 2, M.CONTEXTS: M.LEAST_COUNT}, asked))
    ctx = np.unique(listed.column("ctx").to_numpy())
    assert len(ctx) > 1000
    states = pa.table({"ctx": ctx, "flag": np.full(len(ctx), 3, np.int32), "back": np.full(len(ctx), 0.5)})
    verdicts = M._judged(asked.filter(pa.array(asked.column("kind").to_numpy() == M.VERDICTS)), states)
    step(M._decided(1, 1, False, M.IDLE), block, verdicts)
    assert max(most) < 135
