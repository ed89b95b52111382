"""Field counts, valid/rejected split, audit columns, reconciliation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.schema import (
    EXPECTED_STATE_FIELDS,
    REASON_FIELD_COUNT_PREFIX,
    REASON_NULL_STATE,
)
from aerolake.operators.literals import run_timestamp_literal


def field_count(state: Column) -> Column:
    """``size(state)`` with NULL pinned to -1 (Spark 3 non-ANSI value) in both ANSI modes."""
    return F.when(state.isNull(), F.lit(-1)).otherwise(F.size(state)).cast("int")


def is_valid(state: Column | None = None, count: Column | None = None) -> Column:
    state = F.col("state") if state is None else state
    count = F.col("field_count") if count is None else count
    return state.isNotNull() & (count == F.lit(EXPECTED_STATE_FIELDS))


def with_field_count(exploded: DataFrame) -> DataFrame:
    return exploded.withColumn("field_count", field_count(F.col("state")))


def rejection_reason(state: Column | None = None, count: Column | None = None) -> Column:
    state = F.col("state") if state is None else state
    count = F.col("field_count") if count is None else count
    return F.when(state.isNull(), F.lit(REASON_NULL_STATE)).otherwise(
        F.concat(F.lit(REASON_FIELD_COUNT_PREFIX), F.coalesce(count.cast("string"), F.lit("NULL")))
    )


def split_valid_rejected(exploded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Return ``(valid, rejected)``; rejected is the exact complement of valid."""
    counted = with_field_count(exploded) if "field_count" not in exploded.columns else exploded
    ok = is_valid()
    valid = counted.filter(ok)
    rejected = counted.filter(~ok).withColumn("rejection_reason", rejection_reason())
    return valid, rejected


def with_reject_audit(rejected: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    """run id, rejection timestamp and ``ingestion_date`` partition column."""
    ts = run_timestamp_literal(run_ts)
    return (
        rejected.withColumn("processing_run_id", F.lit(run_id))
        .withColumn("rejection_timestamp", ts)
        .withColumn("ingestion_date", F.to_date(ts))
    )


def reconcile_counts(exploded: DataFrame) -> DataFrame:
    """raw = valid + rejected, computed in one aggregation pass."""
    counted = with_field_count(exploded) if "field_count" not in exploded.columns else exploded
    ok = is_valid()
    agg = counted.agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(ok).alias("valid_count"),
        F.count_if(~ok).alias("rejected_count"),
    )
    return agg.withColumn(
        "balanced", F.col("raw_count") == F.col("valid_count") + F.col("rejected_count")
    )
