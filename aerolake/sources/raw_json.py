"""Schema-safe scan of landed response documents.

The schema is explicit (``time LONG, states VARIANT, _corrupt_record STRING``):
``states`` keeps the type of its JSON value and is split into elements by
:func:`aerolake.operators.explode.parse_state_elements`, so one odd element
cannot turn the whole column into another type (what inference does), a string
that holds array text is not taken for an array, and a
corrupt document becomes one row with ``_corrupt_record`` set instead of
failing the scan. File lineage comes from ``_metadata.file_path``.

Numbers are kept by value: ``100.0`` reads as ``100``, ``-0.0`` as ``0``. A document whose ``states`` is too large for a
VARIANT is a corrupt document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.schema import RAW_SCHEMA

RAW_PARTITION_COLUMNS = ("year", "month", "day", "hour")


def read_raw(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Scan a whole raw prefix, one ``year=/month=/day=/hour=`` directory or one object.

    ``multiline=True`` is the landing layout (one document per file, one task
    per file); ``multiline=False`` reads JSON Lines and splits large files.
    Reading a prefix also yields the ``year, month, day, hour`` partition
    columns, which :func:`raw_partition_filter` prunes on.
    """
    reader = (
        spark.read.schema(RAW_SCHEMA)
        .option("multiLine", "true" if multiline else "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.json(paths)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def raw_partition_filter(
    year: int | None = None, month: int | None = None, day: int | None = None, hour: int | None = None
) -> Column:
    """Incremental selection as a partition predicate (pruned at planning time)."""
    cond = F.lit(True)
    for name, value in zip(RAW_PARTITION_COLUMNS, (year, month, day, hour)):
        if value is not None:
            cond = cond & (F.col(name) == F.lit(int(value)))
    return cond


def read_raw_partition(spark: SparkSession, base_path: str, **parts: int | None) -> DataFrame:
    return read_raw(spark, base_path).where(raw_partition_filter(**parts))


def payload_status(states_col: str = "states_raw") -> Column:
    """Tell apart what the explode treats alike (quirk: null / empty / corrupt all give one row); of a frame of
    :func:`aerolake.operators.explode.parse_state_elements`."""
    s = F.col(states_col)
    return (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("CORRUPT_DOCUMENT"))
        .when(s.isNull(), F.lit("STATES_NULL"))
        .when(F.size(s) == 0, F.lit("STATES_EMPTY"))
        .otherwise(F.lit("OK"))
    )
