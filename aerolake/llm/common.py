"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import contextlib
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import scratch_path

#: Rows and bytes of one Arrow batch handed to Python: whole texts stay whole, a batch of them stays small.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of one Arrow batch in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES):
    """Arrow batches of at most ``rows`` rows and ``size`` bytes for what runs inside; the caller's settings come back after it."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read again.

    Cuts the lineage like a reliable checkpoint: a lost executor costs a reread, never a
    recomputation, and every later pass sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a table of ``staged`` that no later step reads."""
    jvm, path = df.sparkSession._jvm, getattr(df, "_staged_path", None)
    if path:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows kept out of learning. A NULL id has no remainder: not held out, and never learned from."""
    return F.coalesce(id_remainder(doc_id, modulus) == remainder, F.lit(False))


def learns_from(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(id_remainder(doc_id, modulus) != remainder, F.lit(False))


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


@functools.cache
def single_threaded() -> None:
    """One task, one thread: Spark already runs a task per core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    for k in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(k, "1")
