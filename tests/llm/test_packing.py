from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import HARD, SF, hard_docs, no_docs

from aerolake.llm import packing as P
from aerolake.llm.common import staged
from aerolake.llm.queries import PACKING_TOKENIZER, op5_best_fit_packing, tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(PACKING_TOKENIZER))


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(packed, texts, tokenizer, capacity=4096):
    """Every piece of every text is there once, its place is gapless, and the number of sequences is near the least."""
    bins = defaultdict(list)
    for r in packed:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    want = []
    for i, t in texts:
        ids = plain_ids(tokenizer, t)
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[a:a + capacity], "<u4")
            want.append((i, k, a, len(part), zlib.crc32(part.tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return len(bins), math.ceil(sum(w[3] for w in want) / capacity)


def test_query_packs_every_id(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    used, least = check(op5_best_fit_packing(spark, SF).collect(), docs, tokenizer)
    assert used <= least + 1


def test_hard_rows(spark, tokenizer):
    special = "a<|endoftext|>b <|ENDOFTEXT|> it's  we'LL x y é ΑΣ"
    docs = hard_docs(spark, True).unionByName(hard_docs(spark, True).where("doc_id = 6").replace({"one": special}, subset=["text"]))
    packed = P.pack_documents(docs, tokenizer_path(PACKING_TOKENIZER), keep_ids=False).collect()
    check(packed, [(r[0], r[1]) for r in HARD] + [(6, special)], tokenizer)
    assert P.pack_documents(no_docs(spark), tokenizer_path(PACKING_TOKENIZER)).count() == 0


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = hard_docs(spark).where("doc_id in (1, 6, 9, 10)")
    packed = staged(P.pack_documents(docs, tokenizer_path(PACKING_TOKENIZER)), "t")
    out = P.sequences(packed).collect()
    want = sum(len(plain_ids(tokenizer, r["text"])) for r in docs.collect())
    assert sum(r["length"] for r in out) == want and all(len(r["ids"]) == 4 * r["length"] <= 4 * 4096 for r in out)


def test_each_bin_is_the_fullest_possible():
    rnd = random.Random(5)
    for _ in range(60):
        counts = {rnd.randrange(1, 60): rnd.randrange(1, 5) for _ in range(rnd.randrange(1, 9))}
        room = rnd.randrange(0, 100)
        best = {0}
        for n, c in counts.items():
            best = {s + n * k for s in best for k in range(c + 1) if s + n * k <= room}
        combo = P._fullest(sorted(counts, reverse=True), counts, room)
        assert sum(n * c for n, c in combo.items()) == max(best) and all(c <= counts[n] for n, c in combo.items())


def first_fit(hist, capacity=4096):
    """Bins of first-fit decreasing."""
    room = []
    for n in sorted((n for n, c in hist.items() for _ in range(c)), reverse=True):
        at = next((i for i, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(capacity - n)
        else:
            room[at] -= n
    return len(room)


def test_plan_places_every_piece_once():
    rnd = random.Random(6)
    hist = {rnd.randrange(1, 4097): rnd.randrange(1, 6) for _ in range(400)}
    plan = P.bin_plan(hist)
    fill = defaultdict(int)
    for n, c in hist.items():
        at = plan["length"] == n
        places = set()
        for r, first, copies, offset in zip(plan["rank"][at], plan["first_bin"][at], plan["copies"][at], plan["offset"][at]):
            end = min([x for x in plan["rank"][at] if x > r], default=c)
            for rank in range(r, end):
                b, slot = divmod(rank - r, copies)
                places.add((first + b, offset + slot * n))
                fill[first + b] += n
        assert len(places) == c
    assert max(fill.values()) <= 4096 and len(fill) <= first_fit(hist)
    assert P.bin_plan({})["length"].size == 0


def test_ranks_of_a_hot_length_come_from_many_buckets(spark):
    from pyspark.sql import functions as F

    pieces = P.numbered(spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("length")))
    ranked, hist = P.ranked(pieces, rank_rows=50)
    by = defaultdict(list)
    for r in ranked.collect():
        by[r["length"]].append(r["_rank"])
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(n)) for k, n in hist.items()}
