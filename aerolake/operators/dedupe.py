"""A2: deterministic keyed dedupe.

``dropDuplicates`` keeps an arbitrary survivor when one key carries different
payloads. Here the survivor is the row with the smallest
``(payload_hash, source_file, <all other columns>)`` - a total order, so reruns
and retries always keep the same row. It is an aggregation, not a window: the
partial (map-side) aggregate collapses copies of a key inside each task before
the shuffle, so a key with millions of copies still ships one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_by_key(
    df: DataFrame,
    key: str = "record_key",
    order: tuple[str, ...] = ("payload_hash", "source_file"),
) -> DataFrame:
    """One pass over ``df``: every row takes part in the aggregate at full width."""
    cols = df.columns
    rest = [c for c in cols if c != key and c not in order]
    ranked = [c for c in order if c in cols]
    fields = ", ".join(f"`{c}`" for c in ranked + rest)
    best = F.expr(f"min(struct({fields}))").alias("_best")
    return df.groupBy(key).agg(best).selectExpr(
        *[f"`{key}`" if c == key else f"`_best`.`{c}` AS `{c}`" for c in cols]
    )


def dedupe_repeated(
    df: DataFrame,
    key: str = "record_key",
    order: tuple[str, ...] = ("payload_hash", "source_file"),
    written: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The same rows in two phases, for an input that is cheap to read twice (a staged table).

    Eight-byte hashes of the keys are counted by a hash aggregate; rows of a key seen once pass where they lie,
    and only rows of repeated keys are shuffled and compared at full width. Two keys of one hash only
    make both take the longer way. A NULL key is one key, as in the aggregate.
    ``written`` stages the repeated hashes: Spark then plans both joins by how many there are, where it would go by the
    hashes of all keys and shuffle every row at full width once those are too many to broadcast.
    """
    marked = df.withColumn("_key_hash", F.xxhash64(key))
    repeated = marked.groupBy("_key_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key_hash")
    repeated = written(repeated) if written else repeated
    once = marked.join(repeated, "_key_hash", "left_anti").drop("_key_hash")
    again = marked.join(repeated, "_key_hash", "left_semi").drop("_key_hash")
    return once.unionByName(dedupe_by_key(again, key, order))
