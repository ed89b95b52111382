"""Hard rows shared by the tests: nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
PLAIN = "The quick brown fox jumps over the lazy dog while seven other animals watch it from behind a fence near the old mill. " * 2
DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named like the operators' own.
EXTRA = ("score", "fp", "kept", "quality", "length", "piece", "row", "t", "key", "_q_words", "Label", "u", "component_id")

HARD = [
    (1, PLAIN, "en", "a", 1), (2, PLAIN, "en", "a", 1), (2, PLAIN, "en", "a", 1), (3, None, "en", "a", None),
    (4, "", None, "a", 0), (None, PLAIN, "en", None, 1), (None, None, None, None, None), (5, " \t\n ", "en", "b", 4),
    (6, "one", "en", "b", 3), (7, "word " * 60_000, "en", "b", 300_000), (8, "é ß ñ 漢字 😀 \x00 \x85 x", "de", "b", 9),
    (9, "a b c a b c a b c " * 20, "en", "a", 1), (10, "#$% | <b> & * " * 30, "en", "a", 1), (11, "x\n\nx\n x\nx", "en", "a", 1),
]


def hard_docs(spark, clashing: bool = False):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(HARD, DOCS_SCHEMA)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(EXTRA)]) if clashing else docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
