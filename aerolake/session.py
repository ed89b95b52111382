"""Session configuration (C4) and shared scratch locations.

Scratch data (staged merge sources, written intermediate tables, test
landings) always lives under the shared folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset (local tests) is a fresh
directory created and registered.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Scratch folders of the open ``scratch_scope`` of this thread.
_SCOPE: ContextVar[list[str] | None] = ContextVar("aerolake_scratch", default=None)

# Settings every job relies on: UTC session time, dynamic partition overwrite,
# AQE (runtime coalescing and skew-join splitting).
JOB_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "aerolake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one is made only in local mode, where every task sees it."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("CHECKPOINT_DIR_UNSET: spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="aerolake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable directory."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/aerolake-scratch/{name}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch folders made inside are deleted when the block ends, also by an error."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared scratch folder and read again: every later pass sees the same rows, and a lost
    executor costs a reread of them. The hex digests of a row are half as long in zstd as in the default codec."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
