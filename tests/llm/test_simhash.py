from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_cases import HARD, SF, hard_docs, no_docs, rows

from aerolake.llm import simhash_dedup as S
from aerolake.llm.components import connected_components
from aerolake.llm.queries import op2_simhash_near_dedup


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Smallest index reachable at 4 bits or fewer, by comparing all pairs."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = find(i), find(j)
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_equal_the_plain_ones():
    texts = [r[1] for r in HARD]
    got = S.fingerprints([None if t is None else t.encode() for t in texts])
    assert [int(x) for x in got] == [plain_fingerprint(t) for t in texts]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_fingerprint(r["text"]) for r in docs]
    want = {d["doc_id"]: (f"{p:016x}", docs[c]["doc_id"]) for d, p, c in zip(docs, prints, plain_components(prints))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op2_simhash_near_dedup(spark, SF).collect()}
    assert got == want


@pytest.mark.parametrize("shard_rows,blocks", [(8192, 6), (5, 6), (3, 5), (8192, 8)])
def test_links_connect_what_all_links_would(spark, shard_rows, blocks):
    rnd = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 2, 8, 60])):
            v = base
            for _ in range(rnd.randrange(7)):
                v ^= 1 << rnd.randrange(64)
            prints.add(v)
            base = rnd.choice([base, v])
    prints = sorted(prints, key=lambda v: v - (1 << 64) if v >> 63 else v)
    signed = [v - (1 << 64) if v >> 63 else v for v in prints]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = S.link_fingerprints(fps, shard_rows=shard_rows, blocks=blocks)
    assert links.count() <= 70 * len(prints) * (1 if shard_rows > 100 else 40)
    root = {r["node"]: r["root"] for r in connected_components(links).collect()}
    want = plain_components(prints)
    assert [root.get(v, v) for v in signed] == [signed[i] for i in want]


def test_trees_follow_edges_within_the_radius():
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    hits = {(n, int(q)) for n, near in S.BKTree(values).search(values, 2) for q in near}
    want = {(i, j) for i in range(len(values)) for j in range(len(values)) if (int(values[i]) ^ int(values[j])).bit_count() <= 2}
    assert hits == want
    small = values[:40]
    assert S._forest_small(small.tolist(), 2) == plain_labels(small.tolist(), 2)


def plain_labels(values, radius):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, j in combinations(range(len(values)), 2):
            if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    return label


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201), (201, 200), (-5, 130)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert {got[i] for i in range(61)} == {0} and got[100] == got[130] == got[-5] == -5 and got[201] == 200
    assert 7 in got and connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hard_rows(spark):
    got = rows(S.near_duplicate_classes(hard_docs(spark)))
    assert len(got) == len(HARD)
    component = {}
    for i, fp, c in got:
        component.setdefault(fp, c)
        assert component[fp] == c
    assert component[0] == 3  # null and empty texts, the null id is not the smallest
    for clashing in (False, True):
        docs = hard_docs(spark, clashing)
        kept = S.keep_one_of_each(docs)
        assert kept.columns == docs.columns
        ids = [r["doc_id"] for r in kept.collect()]
        assert sorted(ids) == [1, 3, 6, 7, 8, 9, 10, 11]
    assert S.keep_one_of_each(no_docs(spark)).count() == 0 and S.near_duplicate_classes(no_docs(spark)).count() == 0
