"""Table sources."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Partitions named in one catalog statement.
STATEMENT_PARTITIONS = 500


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def register_parquet_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Schema + partition discovery over an existing Parquet folder (crawler equivalent).

    A later call looks for new and vanished partition folders only (:func:`sync_partitions`)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    sync_partitions(spark, name, path)
    return spark.table(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def partition_folders(spark: SparkSession, path: str, columns: list[str]) -> set[str]:
    """``a=1/b=2`` names of the partition folders below ``path``; their number is that of the catalog's partitions, not of files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = {""} if fs.exists(hadoop(path)) else set()
    for column in columns:
        found = {f"{above}/{s.getPath().getName()}".lstrip("/") for above in found
                 for s in fs.listStatus(hadoop(f"{path}/{above}" if above else path))
                 if s.isDirectory() and s.getPath().getName().lower().startswith(f"{column.lower()}=")}
    return found


def listed_partitions(spark: SparkSession, name: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}


def partition_spec(folder: str) -> str:
    """``PARTITION (a = '1', b = null)`` of a folder name ``a=1/b=__HIVE_DEFAULT_PARTITION__``."""
    parts = []
    for part in folder.split("/"):
        column, value = part.split("=", 1)
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{column}` = null" if value == DEFAULT_PARTITION else f"`{column}` = '{text}'")
    return f"PARTITION ({', '.join(parts)})"


def sync_partitions(spark: SparkSession, name: str, path: str) -> tuple[list[str], list[str]]:
    """Add the partitions whose folder is new, drop those whose folder is gone; returns both. No other partition is touched."""
    columns = partition_columns(spark, name)
    if not columns:
        return [], []
    there, known = partition_folders(spark, path, columns), listed_partitions(spark, name)
    new, gone = sorted(there - known), sorted(known - there)
    for i in range(0, len(new), STATEMENT_PARTITIONS):
        places = [f"{partition_spec(f)} LOCATION '{_quoted(path)}/{_quoted(f)}'" for f in new[i:i + STATEMENT_PARTITIONS]]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
    for i in range(0, len(gone), STATEMENT_PARTITIONS):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(partition_spec, gone[i:i + STATEMENT_PARTITIONS]))}")
    if new or gone:
        spark.catalog.refreshTable(name)
    return new, gone


def _quoted(text: str) -> str:
    return text.rstrip("/").replace("\\", "\\\\").replace("'", "\\'")
