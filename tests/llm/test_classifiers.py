"""Toxicity and language: held-out accuracy, and the hard rows."""

from __future__ import annotations

import numpy as np
import pytest
from llm_cases import HARD, hard_docs, no_docs
from pyspark.sql import functions as F

from aerolake.llm import langid as L
from aerolake.llm import toxicity as T
from aerolake.llm.queries import op8_toxicity, op9_language_id

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    got = {r["doc_id"]: r for r in op9_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    held = [d for d in docs if got[d["doc_id"]]["held_out"]]
    assert 150 < len(held) < 350
    assert np.mean([got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_convolution_equals_the_plain_one():
    rng = np.random.default_rng(1)
    net = L.train(rng.integers(1, 255, (20, L.WINDOW)).astype(np.uint8), np.arange(20) % 2, ["a", "b"], epochs=1)
    x = rng.integers(0, 255, (3, L.WINDOW)).astype(np.uint8)
    want = []
    for row in x:
        e, f = net.params["embed"][row], []
        for w in L.WIDTHS:
            z = [e[i:i + w].ravel() @ net.params[f"w{w}"] + net.params[f"b{w}"] for i in range(L.WINDOW - w + 1)]
            f.append(np.maximum(np.max(z, axis=0), 0))
        want.append(np.concatenate(f))
    assert np.allclose(net.features(x), want, atol=1e-4)


@pytest.mark.parametrize("clashing", [False, True])
def test_language_hard_rows(spark, clashing):
    docs = hard_docs(spark, clashing)
    model = L.fit(docs, F.col("doc_id").isNotNull())
    assert set(model.langs) == {"en", "de"}
    out = L.with_language(docs, model, out_col="_l").collect()
    assert len(out) == len(HARD)
    for r in out:
        no_letter = not any(c.isalpha() for c in r["text"] or "")
        assert (r["_l"]["lang"] == "und") == no_letter and 0 <= r["_l"]["score"] <= 1
    assert L.fit(no_docs(spark), F.lit(True)) is None
    assert {r["_l"]["lang"] for r in L.with_language(docs, None, out_col="_l").collect()} == {"und"}
    assert L.with_language(no_docs(spark), model).count() == 0


def test_every_language_is_learned_from_a_bounded_sample(spark):
    """More languages than documents each: all are learned; a hot id gives one training row."""
    rows = [(1000 * k + i, f"{chr(97 + k % 26)}{k} " * 30, f"l{k:03}") for k in range(200) for i in range(3)] + [(7, "hot row", "hot")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs, F.lit(True), fit_total=400)
    assert model.langs == sorted({r[2] for r in rows})


def test_gradients_lower_the_loss():
    """Training separates what one filter can tell apart."""
    rng = np.random.default_rng(3)
    x = rng.integers(97, 110, (200, L.WINDOW)).astype(np.uint8)
    y = np.arange(200) % 2
    x[y == 1, ::9] = 122
    net = L.train(x, y, ["a", "b"], epochs=60)
    assert np.mean(net.probabilities(x).argmax(axis=1) == y) > 0.95


def test_gains_and_features_equal_plain_ones():
    """Lengths of windows compressed one at a time, and the four features by their definition."""
    import zstandard

    base, both = T.compressors(b"ordinary words of a plain text " * 5, b"grumbolt fazzwick ")
    docs = [T.windows(t) for t in (b"a plain text of ordinary words and one grumbolt in it", b"", b"fazzwick " * 30, b"x y z")]

    def length(content, window):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=d, compression_params=T._params()).compress(window))

    want = []
    for parts in docs:
        gains = [length(b"ordinary words of a plain text " * 5 + bytes(18), w) - length(b"ordinary words of a plain text " * 5 + b"grumbolt fazzwick ", w)
                 for w in parts]
        mean = max(sum(gains), 0) / (len(gains) + 2)
        want.append([mean, np.log1p(20 * mean), max(gains) / 4, sum(g >= 2 for g in gains) / len(gains)] if parts else [0] * 4)
    assert T.gain_features(docs, base, both) == pytest.approx(np.array(want))
    assert want[2][0] > want[3][0]


def test_short_insults_and_few_labels_never_leave_the_dictionary_empty(spark):
    rng = np.random.default_rng(8)
    syllables = ["ka", "lo", "mi", "ter", "on", "ve"]
    rows = []
    for i in range(120):
        words = ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(60)]
        rows.append((i, " ".join(w if i % 2 == 0 or k % 6 else "zug" for k, w in enumerate(words))))
    docs = spark.createDataFrame(rows + [rows[1]] * 200, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = T.fit(docs, labels, F.col("doc_id") < 80)
    score = {r["doc_id"]: r["_t"] for r in T.with_toxicity(docs, model, out_col="_t").collect()}
    assert model.toxic and np.mean([(score[i] >= 0.5) == (i % 2 == 1) for i in range(80, 120)]) > 0.9
    few = T.fit(docs, labels, F.col("doc_id").isin(0, 1, 2))
    assert few.toxic


def made_up(n, rng, insults):
    """Half the documents hold words of a few stems among random syllables."""
    syllables = ["ka", "lo", "mi", "ter", "on", "ve", "sta", "qui", "en", "dor"]
    docs = []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(rng.integers(30, 200))]
        if i % 2:
            for _ in range(max(2, len(words) // 40)):
                words[rng.integers(0, len(words))] = rng.choice(insults) + rng.choice(["", "xa", "xo", "xi"])
        docs.append((i, " ".join(words), i % 2))
    return docs


def test_toxic_stems_are_learned_and_generalise():
    rng = np.random.default_rng(4)
    docs = made_up(800, rng, ["grumbolt", "fazzwick", "plonkard"])
    parts = [T.windows(t.encode()) for _, t, _ in docs]
    model = T.fit_windows([p for p, d in zip(parts[:600], docs) if d[2]], [p for p, d in zip(parts[:600], docs) if not d[2]])
    s = model.scorer()([t.encode() for _, t, _ in docs[600:]])
    y = np.array([d[2] for d in docs[600:]])
    assert np.mean((s >= 0.5) == y) > 0.95 and (0 <= s).all() and (s <= 1).all()


def test_query_covers_all_and_orders_labels(spark):
    got = {r["doc_id"]: r for r in op8_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(got) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    s = {y: [r["score"] for i, r in got.items() if r["held_out"] and labels.get(i) == y] for y in (0, 1)}
    above = np.mean([[a > b for b in s[0]] for a in s[1]]) + 0.5 * np.mean([[a == b for b in s[0]] for a in s[1]])
    assert above > 0.85
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got.values())


@pytest.mark.parametrize("clashing", [False, True])
def test_toxicity_hard_rows(spark, clashing):
    docs = hard_docs(spark, clashing)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 1, 1), (9, 0, 1), (None, 0, 1), (10, None, None), (77, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = T.fit(docs, labels, F.col("doc_id").isNotNull())
    out = T.with_toxicity(docs, model, out_col="_t").collect()
    assert len(out) == len(HARD) and all(0 <= r["_t"] <= 1 for r in out)
    assert T.fit(docs, labels.where("toxic = 0"), F.lit(True)) is None and T.fit(no_docs(spark), labels, F.lit(True)) is None
    assert {r["_t"] for r in T.with_toxicity(docs, None, out_col="_t").collect()} == {0.0}
    assert T.with_toxicity(no_docs(spark), model).count() == 0
