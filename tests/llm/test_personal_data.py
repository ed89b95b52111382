from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import HARD, SF, hard_docs, no_docs

from aerolake.llm import personal_data as P
from aerolake.llm.queries import op12_personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    return [[m.span() for m in EMAIL.finditer(text)],
            [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
            [m.span() for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and plain_luhn(digits(m))],
            [m.span() for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["@", ".", "a", "b-", "%", "+", "+1", "12", "255", "256", "0001", " ", "-", "(", ")", "\n", "é", "٣", "4539578763621486",
                                 "4539 5787 6362 1486", "1.2.3.4", "x@y.z", "+1 (487) 555-7209", "a@b@c.d", ".."]), max_size=14).map("".join))
def test_patterns_equal_plain_regular_expressions(text):
    assert P.patterns(text) == plain(text)


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "@" * 100_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 300_000, "x" * 300_000 + "1"):
        words = P.words_of([text], [P.patterns(text)])
        assert len(words.text) <= 1


def exact(u, edges, tables):
    n, k = u.shape
    p = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        w = np.exp(sum(u[i, y] for i, y in enumerate(labels)) + sum(t[labels[i], labels[j]] for (i, j), t in zip(edges, tables)))
        p[np.arange(n), labels] += w
    return p / p.sum(1, keepdims=True)


def test_marginals_are_exact_on_trees_and_close_on_loops():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, k = 5, 3
        u = rng.normal(size=(n, k))
        tree = np.array([(int(rng.integers(j)), j) for j in range(1, n)])
        tables = rng.normal(size=(n - 1, k, k))
        assert P.marginals(u, tree, tables) == pytest.approx(exact(u, tree, tables), abs=1e-3)
        loop = np.concatenate([tree, [[0, 4]]])
        weak = np.concatenate([tables, [np.diag([0.5] * k)]])
        assert np.abs(P.marginals(u, loop, weak) - exact(u, loop, weak)).max() < 0.15
    assert P.marginals(np.zeros((2, 3)), np.zeros((0, 2), int), np.zeros((0, 3, 3))) == pytest.approx(1 / 3)


def learned(seed=0):
    rng = np.random.default_rng(seed)
    d = lambda n: "".join(map(str, rng.integers(10, size=n)))
    texts = []
    for _ in range(400):
        phone, mail, ip = f"+1 ({d(3)}) 555-{d(4)}", f"name{d(3)}@mail{d(1)}.example.com", ".".join(str(x) for x in rng.integers(256, size=4))
        texts.append(f"call {phone} or write {mail} from {ip} about {d(4)} pieces and {d(16)} more, again {phone} {mail} on {d(2)}.{d(2)}.")
    return P.train(np.concatenate([P._evidence([t]) for t in texts]))


def spans_of(field, text):
    words = P.words_of([text], [P.patterns(text)])
    return [(P.KINDS[k], text[s:e]) for k, s, e, _ in P.added_spans(words, P.label_words(field, words), 1)[0]] if words.text else []


def test_labels_carry_to_repeats_and_not_to_others():
    field = learned()
    assert field.skip[1] > 0.3 and field.skip[4] > 0.3  # the kinds that repeat in the texts it learned from
    assert ("phone", "(487) 555-7209") in spans_of(field, "Phone +1 (487) 555-7209 today. Later the number was (487) 555-7209 as said.")
    assert spans_of(field, "There were 1234567890123456 rows, 17 tables and 3.5 units, 1234567890123456 again.") == []
    assert spans_of(field, "no number at all") == []
    # the same word alone is less sure than beside its repeat under a pattern
    alone, beside = (P.words_of([t], [P.patterns(t)]) for t in ("it was ann.7@host then", "it was ann.7@host then ann.7@host.example.com there"))
    k = 1 + P.KINDS.index("email")
    assert P.label_words(field, beside)[0, k] > P.label_words(field, alone)[0, k]


def test_evidence_and_added_spans_do_not_overlap():
    field, rng = learned(), np.random.default_rng(2)
    bits = ["+1 (487) 555-7209", "(487) 555-7209", "555-7209", "a.1@mail.example.com", "a.1@mail", "10.2.3.4", "4539578763621486", "and", "x", "\n", "17."]
    for _ in range(200):
        text = " ".join(bits[i] for i in rng.integers(len(bits), size=12))
        base = P.patterns(text)
        words = P.words_of([text], [base])
        added = P.added_spans(words, P.label_words(field, words), 1)[0]
        taken = sorted([s for kind in base for s in kind])
        assert all(e <= s2 or s >= e2 for _, s, e, _ in added for s2, e2 in taken)
        for (s, e), known, label in zip(words.core, words.known, words.label):
            hit = [k + 1 for k, kind in enumerate(base) for s2, e2 in kind if s2 < e and e2 > s]
            assert known == bool(label) and (label in hit if known else not hit)


def digest(text):
    base = plain(text or "")
    listed = ",".join(f"{k}:{s}:{e}" for k, spans in zip(P.KINDS, base) for s, e in spans)
    return *map(len, base), hashlib.sha256(listed.encode()).hexdigest(), listed


def test_query_base_equals_plain_and_spans_hold_it(spark):
    got = {r["doc_id"]: r for r in op12_personal_data(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r, (*counts, sha, listed) = got[d["doc_id"]], digest(d["text"])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == [*counts, sha]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(listed.split(",") if listed else []) <= set(spans)
        order = [(P.KINDS.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in spans)]
        assert order == sorted(order)


@pytest.mark.parametrize("clashing", [False, True])
def test_hard_rows(spark, clashing):
    docs = hard_docs(spark, clashing)
    got = P.find_personal_data(docs, P.fit(docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    have = sorted(((r["doc_id"], str([(s["kind"], s["start"], s["end"]) for s in r["base"]])) for r in got), key=key)
    want = sorted(((r[0], str([(k, *s) for k, spans in zip(P.KINDS, plain(r[1] or "")) for s in spans])) for r in HARD), key=key)
    assert have == want
    none = no_docs(spark)
    assert P.fit(none) is None and P.find_personal_data(none, None).count() == 0


def test_sample_is_bounded_whatever_repeats(spark):
    docs = spark.createDataFrame([(i, "one hot text +1 (487) 555-7209" if i % 2 else f"write a{i}@mail.example.com now") for i in range(3000)],
                                 "doc_id long, text string")
    field = P.fit(docs, fit_docs=50)
    assert field is not None and np.isfinite(field.unary).all()
