"""Keyed upsert expressed as one full-outer equi-join.

Rules (per key):
  * in source only                      -> ``insert`` (source row)
  * in target only                      -> ``keep``   (target row)
  * in both, ``payload_hash`` equal     -> ``noop``   (target row: first writer's
                                            run id, ingestion time and file stay)
  * in both, ``payload_hash`` differs   -> ``update`` (source row)

Hash equality is null-safe (``<=>``). The source must already be unique per
key (see :mod:`aerolake.operators.dedupe`); the dedupe aggregate leaves it
hash-partitioned on the key, so only the target side is shuffled for the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION_INSERT = "insert"
ACTION_KEEP = "keep"
ACTION_NOOP = "noop"
ACTION_UPDATE = "update"


def _prefixed(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in cols])


def merge_action(t_key: Column, s_key: Column, t_hash: Column, s_hash: Column) -> Column:
    return (
        F.when(t_key.isNull(), F.lit(ACTION_INSERT))
        .when(s_key.isNull(), F.lit(ACTION_KEEP))
        .when(t_hash.eqNullSafe(s_hash), F.lit(ACTION_NOOP))
        .otherwise(F.lit(ACTION_UPDATE))
    )


def _joined(target: DataFrame, source: DataFrame, key: str, hash_col: str, cols: list[str]) -> DataFrame:
    t = _prefixed(target, "t__", cols)
    s = _prefixed(source, "s__", cols)
    j = t.join(s, F.col(f"t__{key}") == F.col(f"s__{key}"), "full_outer")
    return j.withColumn(
        "_action",
        merge_action(F.col(f"t__{key}"), F.col(f"s__{key}"), F.col(f"t__{hash_col}"), F.col(f"s__{hash_col}")),
    )


def classify_merge(
    target: DataFrame, source: DataFrame, key: str = "record_key", hash_col: str = "payload_hash"
) -> DataFrame:
    """One row per key in target ∪ source with its merge action."""
    j = _joined(target.select(key, hash_col), source.select(key, hash_col), key, hash_col, [key, hash_col])
    return j.select(F.coalesce(f"t__{key}", f"s__{key}").alias(key), F.col("_action").alias("action"))


def merge_action_counts(
    target: DataFrame, source: DataFrame, key: str = "record_key", hash_col: str = "payload_hash"
) -> DataFrame:
    return classify_merge(target, source, key, hash_col).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    key: str = "record_key",
    hash_col: str = "payload_hash",
    with_action: bool = False,
) -> DataFrame:
    """The table after the upsert, in the target's column order."""
    cols = target.columns
    j = _joined(target, source.select(*cols), key, hash_col, cols)
    take_source = F.col("_action").isin(ACTION_INSERT, ACTION_UPDATE)
    out = [F.when(take_source, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c) for c in cols]
    if with_action:
        out.append(F.col("_action").alias("merge_action"))
    return j.select(*out)


def classify_source(
    target: DataFrame, source: DataFrame, key: str = "record_key", hash_col: str = "payload_hash"
) -> DataFrame:
    """``(key, action)`` of every source key; both sides are read at two columns."""
    t = target.select(F.col(key).alias("t__key"), F.col(hash_col).alias("t__hash"))
    j = source.select(key, hash_col).join(t, F.col(key) == F.col("t__key"), "left")
    return j.select(key, merge_action(F.col("t__key"), F.lit(""), F.col("t__hash"), F.col(hash_col)).alias("action"))


def merge_by_action(target: DataFrame, source: DataFrame, actions: DataFrame, key: str = "record_key") -> DataFrame:
    """J1 from ``classify_source``: target rows that are not updated and source rows that are new or changed.

    Both joins carry only keys on one side, so Spark broadcasts a small batch's keys and leaves the
    target where it is. ``from_target`` tells the two kinds apart.
    """
    updated = actions.where(F.col("action") == ACTION_UPDATE).select(key)
    taken = actions.where(F.col("action").isin(ACTION_INSERT, ACTION_UPDATE)).select(key)
    stays = target.join(updated, key, "left_anti").select(*target.columns, F.lit(True).alias("from_target"))
    comes = source.join(taken, key, "left_semi").select(*target.columns, F.lit(False).alias("from_target"))
    return stays.unionByName(comes)


def merge_inserts(target: DataFrame, source: DataFrame, key: str = "record_key") -> DataFrame:
    """Source rows whose key is new."""
    return source.join(target.select(key), key, "left_anti")


def merge_changed(
    target: DataFrame, source: DataFrame, key: str = "record_key", hash_col: str = "payload_hash"
) -> DataFrame:
    """Source rows matching a target key with a different hash (F7 ``NOT (t <=> s)``)."""
    t = target.select(F.col(key).alias("_tkey"), F.col(hash_col).alias("target_hash"))
    j = source.join(t, F.col(key) == F.col("_tkey"), "inner")
    return j.filter(~F.col("target_hash").eqNullSafe(F.col(hash_col))).drop("_tkey")
