"""K2-K4, K6, K8: partitioned Parquet writers and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Files per partition value are bounded: AQE's rebalance splits a hot
# partition value over several tasks instead of one task writing a whole day.
MAX_RECORDS_PER_FILE = 5_000_000


def _rebalanced(df: DataFrame, partition_col: str) -> DataFrame:
    return df.hint("rebalance", partition_col)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str,
    mode: str = "overwrite",
    compression: str | None = None,
    rebalance: bool = True,
) -> None:
    """Write ``df`` partitioned by ``partition_col``.

    Unless the caller already arranged the data (e.g. ``clustered_for_write``),
    rows are rebalanced by the partition value so AQE can split a hot value
    over several tasks.

    With ``mode='overwrite'`` the session's dynamic partition-overwrite mode
    replaces only the partition values present in ``df``.
    """
    if rebalance:
        df = _rebalanced(df, partition_col)
    w = (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_col)
    )
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)


def write_processed(df: DataFrame, path: str) -> None:
    """K2: overwrite only the ``event_date`` partitions present in ``df``.

    The caller must pass complete days: a touched day is replaced as a whole.
    """
    write_partitioned(df, path, "event_date", mode="overwrite")


def write_rejected(df: DataFrame, path: str, mode: str = "append") -> int:
    """K3/K4: write rejects partitioned by ``ingestion_date``; returns the row count.

    The count is observed during the write (one pass over the data). ``append``
    keeps every run's audit rows; ``overwrite`` replaces the run's date.
    """
    obs = Observation("rejected")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    write_partitioned(observed, path, "ingestion_date", mode=mode)
    return int(obs.get.get("n", 0))


def create_table(df: DataFrame, name: str, provider: str = "parquet", path: str | None = None) -> None:
    """K6: unpartitioned create; fails if the table exists. With ``path`` the
    table is external at that (shared) location instead of the warehouse."""
    w = df.writeTo(name).using(provider)
    if path:
        w = w.option("path", path)
    w.create()


def preview_rows(df: DataFrame, columns: list[str], n: int = 20) -> DataFrame:
    """K8: bounded console preview (a top-n by design)."""
    return df.select(*columns).limit(n)
