from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_cases import HARD, SF, hard_docs, no_docs

from aerolake.llm import subword_sampling as S
from aerolake.llm.queries import SUBWORD_MODEL, tokenizer_path


@pytest.fixture(scope="module")
def lattices():
    return S.Lattices(tokenizer_path(SUBWORD_MODEL))


def every_segmentation(lattices, text):
    """id tuple -> log-probability, by listing them all."""
    out, weight = {}, {}

    def go(rest, ids, w):
        if not rest:
            weight[ids] = w
            return
        for j in range(1, len(rest) + 1):
            k = lattices.piece.get(rest[:j])
            if k is not None:
                go(rest[j:], (*ids, k), w - math.log(k + 2))
        if rest[0] not in lattices.piece:
            raw = rest[0].encode()
            go(rest[1:], (*ids, *(int(lattices.byte[b]) for b in raw)), w + len(raw) * lattices.byte_weight)

    go("▁" + text.replace(" ", "▁"), (), 0.0)
    top = math.log(sum(math.exp(w) for w in weight.values()))
    for ids, w in weight.items():
        out[ids] = w - top
    return out


def sample(lattices, text, keys, k):
    units, counts = lattices.encode(pa.array([text] * len(keys)))
    return [[(tuple(int(i) for i in lattices.ids_of(e)), lp, v, q) for e, lp, v, q in one]
            for one in S.top_samples(lattices, units, counts, keys, k, 5)]


def test_samples_follow_the_distribution_without_replacement(lattices):
    text, n = "the  cat!", 4000
    want = every_segmentation(lattices, text)
    got = sample(lattices, text, list(range(n)), 2)
    for one in got[:200]:
        assert len({ids for ids, *_ in one}) == 2 and one[0][2] > one[1][2]
        for ids, lp, _, q in one:
            assert lp == pytest.approx(want[ids], abs=1e-6) and 0 < q <= 1
    first, second = (Counter(one[i][0] for one in got) for i in (0, 1))
    for ids, lp in sorted(want.items(), key=lambda x: -x[1])[:4]:
        p = math.exp(lp)
        assert first[ids] / n == pytest.approx(p, abs=4 * math.sqrt(p * (1 - p) / n) + 1e-3)
        p2 = sum(math.exp(o) * p / (1 - math.exp(o)) for other, o in want.items() if other != ids)
        assert second[ids] / n == pytest.approx(p2, abs=4 * math.sqrt(p2 * (1 - p2) / n) + 1e-3)


def test_short_texts_give_all_they_have(lattices):
    want = every_segmentation(lattices, "of")
    got = sample(lattices, "of", [1, 2, 3], len(want) + 3)
    for one in got:
        assert {ids for ids, *_ in one} == set(want) and all(q == 1 for *_, q in one)
        values = [v for _, _, v, _ in one]
        assert values == sorted(values, reverse=True)


def test_inclusion_scores_weigh_to_one(lattices):
    """The sum of probability over inclusion score estimates the total probability without bias."""
    got = sample(lattices, "on the mat", list(range(3000)), 3)
    weights = [sum(math.exp(lp) / q for _, lp, _, q in one) for one in got]
    assert np.mean(weights) == pytest.approx(1, abs=5 * np.std(weights) / math.sqrt(len(weights)) + 1e-3)


def test_decoding_round_trip_and_library_agree(spark, lattices):
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(SUBWORD_MODEL))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = S.sample_segmentations(frame, tokenizer_path(SUBWORD_MODEL)).collect()
    assert len(got) == 2 * len(docs)
    for r in got:
        assert r["decoded"] == docs[r["doc_id"]] == model.decode(list(r["ids"]))
    again = S.sample_segmentations(frame.repartition(7), tokenizer_path(SUBWORD_MODEL)).collect()
    key = lambda r: (r["doc_id"], r["sample"])
    for a, b in zip(sorted(got, key=key), sorted(again, key=key), strict=True):
        assert a["ids"] == b["ids"] and a["perturbed"] == pytest.approx(b["perturbed"], abs=1e-6)


@pytest.mark.parametrize("clashing", [False, True])
def test_hard_rows(spark, clashing):
    got = S.sample_segmentations(hard_docs(spark, clashing), tokenizer_path(SUBWORD_MODEL)).collect()
    texts = {}
    for r in HARD:
        texts.setdefault(r[0], set()).add(r[1] or "")
    assert {r["doc_id"] for r in got} == {r[0] for r in HARD} and all(r["decoded"] in texts[r["doc_id"]] for r in got)
    assert [len(r["ids"]) for r in got if r["doc_id"] in (3, 4)] == [0, 0]
    assert S.sample_segmentations(no_docs(spark), tokenizer_path(SUBWORD_MODEL)).count() == 0


def test_no_piece_crosses_a_cut(lattices):
    joined = {(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in lattices.joins}
    assert all((ord(a), ord(b)) in joined for p in list(lattices.piece)[:3000] for a, b in zip(p, p[1:]))
