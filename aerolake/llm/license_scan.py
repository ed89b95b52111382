"""License scans by patience alignment.

A text and a template are aligned like this: words that occur once in both are anchors, their
longest increasing subsequence is kept, and the gaps between neighbouring anchors are aligned
again in the same way after equal words at their ends are matched. The share of the template's
words that end up matched is the coverage.

A notice can stand anywhere in a long text, and more than once, where no word of it would be
unique. So the whole text is searched for the template's telling words, and each occurrence that no
earlier notice covers gives a stretch of about the template's length, which is aligned by itself and
grows on both sides while that matches more words. Matched words further apart than a quarter of the template are not one notice.
A template is left out for a text only if more of its words are missing there than the coverage allows.

Defined cases: a NULL or empty text has no notice; a document without a notice gives one row with
NULL license; texts of any length are searched whole; the same notice twice gives two rows; rows that repeat are rows of their own; overlapping notices of two templates keep the one
with more matched words (ties: the smaller id). Only the id and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, small_batches

#: Notices searched for by default, as their licenses word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files, to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
LEAST_COVERAGE = 0.8
#: Words that say nothing about a license by themselves.
COMMON = frozenset("a an and are by for in is of or that the this to under use v with work".split())
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, of pairs in the order of their first place, whose second places increase."""
    tops, piles, before = [], [], []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        before.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[at], piles[at] = b, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs, increasing in both."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        mine, its = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if its[w] == 1}
        chain = _increasing([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place and mine[w] == 1])
        if chain:
            out += chain
            ends = [(a - 1, c - 1), *chain, (b, d)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


def _one_notice(words: list[str], lo: int, hi: int, template: tuple[str, ...], slack: int) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs of a stretch: the most that follow each other without a hole of over ``slack`` words
    beyond the template's own."""
    pairs = [(lo + i, j) for i, j in align(words[lo:hi], list(template))]
    cuts = [0, *[k for k in range(1, len(pairs)) if pairs[k][0] - pairs[k - 1][0] - (pairs[k][1] - pairs[k - 1][1]) > slack], len(pairs)]
    return max((pairs[a:b] for a, b in zip(cuts, cuts[1:])), key=len)


@dataclass(frozen=True)
class Template:
    license: str
    words: tuple[str, ...]

    def telling(self, allowed: int) -> dict[str, int]:
        """Place of each telling word: one that says something and stands there once, then any that stands there once, then any;
        more of them than the ``allowed`` missing words, so that every notice has one."""
        n = Counter(self.words)
        once = {w: i for i, w in enumerate(self.words) if n[w] == 1}
        for some in ({w: i for w, i in once.items() if w not in COMMON and len(w) > 1}, once):
            if len(some) > allowed:
                return some
        return {w: i for i, w in reversed(list(enumerate(self.words)))}


class Scanner:
    def __init__(self, templates: dict[str, str], least: float = LEAST_COVERAGE):
        self.least = least
        self.templates = [t for t in (Template(k, tuple(words_of(v))) for k, v in sorted(templates.items())) if t.words]
        self.allowed = [len(t.words) - math.ceil(least * len(t.words) - 1e-9) for t in self.templates]
        self.telling = [t.telling(n) for t, n in zip(self.templates, self.allowed)]
        self.vocabulary = {w for t in self.telling for w in t}

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, first word, past the last word, matched words) of each notice, by place."""
        words = words_of(text)
        places: dict[str, list[int]] = {}
        for w in self.vocabulary.intersection(words):
            places[w] = []
        if not places:
            return []
        for i, w in enumerate(words):
            if w in places:
                places[w].append(i)
        found = []
        for t, telling, allowed in zip(self.templates, self.telling, self.allowed):
            have = [w for w in telling if w in places]
            if not have or len(telling) - len(have) > allowed:
                continue
            size, slack, past = len(t.words), max(2, len(t.words) // 4), 0
            for at, w in sorted((i, w) for w in have for i in places[w]):
                if at < past:
                    continue
                lo, hi = max(past, at - telling[w] - slack), at - telling[w] + size + slack
                pairs = _one_notice(words, lo, hi, t.words, slack)
                while len(pairs) < size:
                    lo, hi = max(past, lo - size), hi + size
                    wider = _one_notice(words, lo, hi, t.words, slack)
                    begin, end = (pairs[0][0], pairs[-1][0]) if pairs else (at, at)  # none: each word stands there twice
                    if len(wider) <= len(pairs) or wider[0][0] > end or wider[-1][0] < begin:
                        break  # no more words, or those of another notice
                    pairs = wider
                if len(pairs) >= size - allowed:
                    first, past = pairs[0][0], pairs[-1][0] + 1
                    found.append((t.license, len(pairs) / size, first, past, len(pairs)))
        found.sort(key=lambda x: (-x[4], x[0], x[2]))
        kept: list[tuple[str, float, int, int, int]] = []
        for x in found:
            if all(x[3] <= y[2] or x[2] >= y[3] for y in kept):
                kept.append(x)
        return sorted(kept, key=lambda x: x[2])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
                  least: float = LEAST_COVERAGE) -> DataFrame:
    """``(doc_id, n_words, license, coverage, start_word, end_word, matched_words)``."""
    templates = TEMPLATES if templates is None else templates
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()),
                        ("start_word", pa.int64()), ("end_word", pa.int64()), ("matched_words", pa.int64())])

    def run(batches):
        scanner = Scanner(templates, least)
        for batch in batches:
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n = len(words_of(t))
                rows += [(i, n, *x) for x in scanner.scan(t)] or [(i, n, None, None, None, None, None)]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else
                                  [pa.array([], f.type) for f in schema], schema=schema)

    small_batches(docs.sparkSession)
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, license string, coverage double, start_word long, end_word long, matched_words long")
