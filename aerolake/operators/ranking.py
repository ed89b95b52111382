"""Skew-safe ``row_number`` within a group.

``row_number() over (partition by g order by k)`` sends every row of a group
to one task; if one group holds a third of the data, one task does a third of
the work. Here the group is split into sub-buckets of at most ``bucket_width``
distinct values of the unique integer key ``k`` (``k div bucket_width``), the
local rank is computed per (group, bucket), and a small per-(group, bucket)
count table supplies the running offset. The result is exactly the global
rank, with every sort bounded by ``bucket_width`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 20


def rank_within(
    df: DataFrame,
    group_col: str,
    key_col: str,
    out_col: str,
    bucket_width: int = DEFAULT_BUCKET_WIDTH,
    most: int | None = None,
) -> DataFrame:
    """Add ``out_col`` = 0-based position of ``key_col`` within ``group_col``.

    ``key_col`` must be a unique integer key (e.g. an event id). Work per task
    is bounded by ``bucket_width`` rows regardless of group skew. A group of more than ``most`` rows raises, which is
    checked once for each (group, bucket), not for each row.
    """
    sub = F.expr(f"{key_col} div {int(bucket_width)}")
    bucketed = df.withColumn("_sub", sub)
    local = bucketed.withColumn(
        "_lrn",
        F.row_number().over(Window.partitionBy(group_col, "_sub").orderBy(key_col)),
    )
    # Per (group, sub-bucket) counts: at most (#rows / bucket_width + #groups) rows.
    # Partial aggregation runs map-side, so the shuffle carries one row per bucket per task.
    offsets = (
        bucketed.groupBy(group_col, "_sub")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_off",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy(group_col)
                    .orderBy("_sub")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
    )
    if most is not None:
        over = F.raise_error(F.lit(f"GROUP_OVERFLOW: over {most} rows in one {group_col}")).cast("long")
        offsets = offsets.withColumn("_off", F.when(F.col("_off") + F.col("_n") > most, over).otherwise(F.col("_off")))
    offsets = offsets.drop("_n")
    # No broadcast hint: the offsets side is small but its size is only known at
    # run time; AQE turns this into a broadcast join when the measured size is
    # under the threshold and keeps the co-partitioned sort-merge join otherwise.
    return (
        local.join(offsets, [group_col, "_sub"], "inner")
        .withColumn(out_col, (F.col("_off") + F.col("_lrn") - 1).cast("int"))
        .drop("_sub", "_lrn", "_off")
    )
