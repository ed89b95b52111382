"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each text is measured in its own row. The ratios of the texts that pass the base rules go into
mergeable KLL quantile sketches per language and source, which are merged again per language
and over all; a group too small to judge by takes the next wider sketch. Thresholds are the
quartiles widened by ``spread`` times their distance (and a least distance, so that a group of
equal values does not reject its first odd one). The documents are joined with the thresholds
of their group and filtered.

Defined cases: a NULL or empty text has no words and fails the base rules; a NULL language or
source is a group of its own; repeated rows are measured, counted and kept alike; an empty table
has no thresholds and returns no rows. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import quoted, spare_name, staged

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Texts a group needs for thresholds of its own, quartile distances beyond the quartiles, and the least distance of each ratio.
GROUP_ROWS, SPREAD = 200, 4.0
#: ratio -> least quartile distance
RATIOS = {"word_length": 0.35, "symbol_ratio": 0.02, "dup_line_ratio": 0.1, "repeat_ratio": 0.1}
_SPACE, _SYMBOLS = r"[\x20\x09-\x0D]+", r"[#*$%&|<>]"


def measures(text: Column) -> dict[str, Column]:
    """The columns to add one after the other (later ones use earlier ones, prefixed by ``_q_``)."""
    words, grams, order = F.col("_q_words"), F.col("_q_grams"), F.col("_q_order")
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "_q_words": F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE, -1), ""),
        "_q_lines": lines,
        # One hash for each 3-word window: windows are equal in a text when their hashes are.
        "_q_grams": F.when(F.size(words) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>")),
        # Windows in the order of their hashes, only for texts that have any twice.
        "_q_order": F.when(F.size(F.array_distinct(grams)) < F.size(grams), F.sort_array(F.arrays_zip(
            grams.alias("h"), F.sequence(F.lit(0), F.size(grams) - 1).alias("i")))).otherwise(
                F.array().cast("array<struct<h:bigint,i:int>>")),
        "_q_twice": F.sort_array(F.filter(F.transform(order, lambda x, j: F.when(
            x["h"].eqNullSafe(F.get(order, j - 1)["h"]) | x["h"].eqNullSafe(F.get(order, j + 1)["h"]), x["i"])),
            lambda i: i.isNotNull())),
    }


def with_measures(docs: DataFrame, text_col: str = "text", out_col: str = "quality") -> DataFrame:
    """``docs`` with a struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    inner = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_q_row"), quoted(text_col).cast("string").alias("_q_text"))
    text = F.col("_q_text")
    for name, value in measures(text).items():
        inner = inner.withColumn(name, value)
    words, twice, lines = F.col("_q_words"), F.col("_q_twice"), F.col("_q_lines")
    n_words = F.size(words).cast("long")
    # A window covers three words; the next repeated window, if closer, covers the rest itself.
    repeat = F.aggregate(
        F.transform(twice, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(twice, j + 1) - i, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    quality = F.struct(
        n_words.alias("n_words"),
        F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(_SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"))
    inner = inner.select("_q_row", quality.alias("_q_out"), F.size(lines).alias("_q_n_lines"))
    q = F.col("_q_out")
    failed = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    some = F.greatest(q["n_words"], F.lit(1))
    ratios = {"word_length": q["word_chars"] / some, "symbol_ratio": q["n_symbols"] / some,
              "dup_line_ratio": q["n_dup_lines"] / F.greatest(F.col("_q_n_lines"), F.lit(1)), "repeat_ratio": q["n_repeat_words"] / some}
    full = F.struct(*[q[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    failed.alias("base_failed"), *[v.cast("double").alias(k) for k, v in ratios.items()])
    return inner.select("_q_row.*", full.alias(out_col))


def thresholds(measured: DataFrame, groups: tuple[str, ...] = ("lang", "source"), measure_col: str = "quality",
               group_rows: int = GROUP_ROWS, spread: float = SPREAD) -> DataFrame:
    """One row for each group: the group columns as ``g0, g1, ..`` (NULL-safe text keys) and ``low``/``high`` structs by ratio."""
    q = quoted(measure_col)
    keys = [f"g{i}" for i in range(len(groups))]
    passed = measured.where(~q["base_failed"])
    base = passed.select(*[quoted(g).cast("string").alias(k) for g, k in zip(groups, keys)], *[q[r].alias(r) for r in RATIOS])
    # Sketches of each task are merged in the shuffle: a hot group moves one sketch a task.
    finest = staged(base.groupBy(*keys).agg(*[F.kll_sketch_agg_double(r).alias(r) for r in RATIOS]), "quality-sketches")
    out = finest
    for width in range(len(keys) - 1, -1, -1):
        wider = finest.groupBy(*keys[:width]).agg(*[F.kll_merge_agg_double(r).alias(f"{r}_{width}") for r in RATIOS])
        if width:
            wider = wider.select(*[F.col(k).alias(f"_{k}") for k in keys[:width]], *[f"{r}_{width}" for r in RATIOS])
            matched = None
            for k in keys[:width]:
                c = F.col(k).eqNullSafe(F.col(f"_{k}"))
                matched = c if matched is None else matched & c
            out = out.join(wider, matched).drop(*[f"_{k}" for k in keys[:width]])
        else:  # one row over all groups, a few KB: it becomes literals
            one = wider.first()
            out = out.withColumns({f"{r}_0": F.lit(bytes(one[f"{r}_0"])) if one[f"{r}_0"] is not None else F.lit(None).cast("binary") for r in RATIOS})
    fences = []
    for r, least in RATIOS.items():
        sketch, n = F.col(f"{r}_0"), F.kll_sketch_get_n_double(F.col(f"{r}_0"))
        for c in [f"{r}_{w}" for w in range(1, len(keys))] + [r]:
            enough = F.kll_sketch_get_n_double(F.col(c)) >= group_rows
            sketch = F.when(enough, F.col(c)).otherwise(sketch)
        q1, q3 = (F.kll_sketch_get_quantile_double(sketch, F.lit(p)) for p in (0.25, 0.75))
        gap = F.greatest(q3 - q1, F.lit(least)) * spread
        fences += [(q1 - gap).alias(f"{r}_low"), (q3 + gap).alias(f"{r}_high")]
    return out.select(*keys, *fences)


def with_verdict(measured: DataFrame, groups: tuple[str, ...] = ("lang", "source"), measure_col: str = "quality",
                 out_col: str = "kept", **limits) -> DataFrame:
    """Staged ``measured`` rows with ``out_col``: false if the base rules fail, else whether every ratio is within its group's thresholds."""
    fences = staged(thresholds(measured, groups, measure_col, **limits), "quality-thresholds")
    taken = spare_name(measured, "_quality_fence")
    rows = measured.withColumn(taken, F.struct(*[quoted(g).cast("string").alias(f"g{i}") for i, g in enumerate(groups)]))
    side = fences.select(F.struct(*[f"g{i}" for i in range(len(groups))]).alias(f"{taken}k"),
                         F.struct(*[f"{r}_{e}" for r in RATIOS for e in ("low", "high")]).alias(f"{taken}v"))
    # The thresholds were written, so their size is known: Spark broadcasts them below its own limit and otherwise
    # shuffles both sides as they are, where a hot group can be split.
    joined = rows.join(side, F.col(taken).eqNullSafe(F.col(f"{taken}k")), "left")
    q, f = quoted(measure_col), F.col(f"{taken}v")
    inside = None
    for r in RATIOS:
        c = q[r].between(f[f"{r}_low"], f[f"{r}_high"])
        inside = c if inside is None else inside & c
    return joined.withColumn(out_col, ~q["base_failed"] & F.coalesce(inside, F.lit(True))).drop(taken, f"{taken}k", f"{taken}v")


def keep_good(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they are."""
    q, kept = spare_name(docs, "_quality"), spare_name(docs, "_kept")
    measured = staged(with_measures(docs, text_col, q), "quality-docs")
    return with_verdict(measured, groups, q, kept).where(quoted(kept)).select(*[quoted(c) for c in docs.columns])
