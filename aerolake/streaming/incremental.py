"""Process each landed document once, then upsert it into the curated data.

``readStream`` over the landing prefix; the file source's checkpoint remembers which
files were processed, so a second ``availableNow`` run with the same checkpoint yields no batch. Each
micro-batch runs the batch operators and the keyed upsert - rerunning a batch
after a failure is a no-op merge, which makes the sink idempotent. Rejected
vectors and unreadable documents go to ``rejected_path/batch_id=<id>``, which a
replay of that batch replaces as a whole, so no reject is lost or doubled.

With a ``quarantine_path`` every file passes an admission gate first (:func:`gate`): files that fail the
landing check go to ``quarantine_path/batch_id=<id>`` with their code, zero-byte ones too,
which Spark's scans never show but the source's own log names; only admitted documents are merged.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.jobs import RunSummary, stage_by_validity, validated
from aerolake.operators.dedupe import dedupe_repeated
from aerolake.operators.literals import new_run
from aerolake.operators.project import curate
from aerolake.operators.validate import with_reject_audit
from aerolake.schema import RAW_SCHEMA
from aerolake.session import scratch_scope, staged
from aerolake.sinks.curated import table_exists, write_curated
from aerolake.sources.landing import BINARY_FILE_SCHEMA, CODE_EMPTY, CODE_OK, landing_code, logged_files, path_exists, same_uri


def write_batch_rejects(rejected: DataFrame, rejected_path: str, batch_id: int, run_id: str, run_ts: datetime | None) -> None:
    """The audit rows of one micro-batch; the folder of the batch is replaced, whatever day a replay runs on."""
    audit = with_reject_audit(rejected.drop("state"), run_id, run_ts or new_run()[1])
    (audit.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("ingestion_date")
     .parquet(f"{rejected_path.rstrip('/')}/batch_id={int(batch_id)}"))


def upsert_batch(
    spark: SparkSession,
    raw_batch: DataFrame,
    table: str,
    out_path: str,
    run_id: str,
    run_ts: datetime | None,
    rejected_path: str,
    batch_id: int = 0,
) -> dict:
    with scratch_scope(spark):
        # One materialisation per micro-batch: the batch files are read once.
        valid, rejected = stage_by_validity(validated(raw_batch), RunSummary(run_id))
        # Rejects first: a batch without a valid vector must not lose its audit rows.
        write_batch_rejects(rejected, rejected_path, batch_id, run_id, run_ts)
        source = staged(dedupe_repeated(curate(valid, run_id, run_ts), written=lambda keys: staged(keys, "repeated-keys")), "batch-source")
        return write_curated(spark, source, table, out_path, count=source.count())


def gate(files: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The admission gate of one micro-batch: ``(uri, length, modification_time, code)`` of the files that fail the landing check,
    and the admitted documents in the shape of ``read_raw``. ``files`` is the scan, ``log`` what the source has found."""
    checked = files.select(same_uri(F.col("source_file")).alias("key"), "length", landing_code(F.col("length"), F.col("content")).alias("code"))
    failing = (
        log.withColumn("key", same_uri(F.col("uri")))
        .join(checked, "key", "left")
        .select("uri", F.coalesce("length", F.lit(0)).alias("length"), "modification_time", F.coalesce("code", F.lit(CODE_EMPTY)).alias("code"))
        .where(F.col("code") != CODE_OK)
    )
    document = F.try_parse_json(F.col("content").cast("string"))
    admitted = files.where(landing_code(F.col("length"), F.col("content")) == CODE_OK).select(
        F.try_variant_get(document, "$.time", "bigint").alias("time"), F.try_variant_get(document, "$.states", "variant").alias("states"),
        F.lit(None).cast("string").alias("_corrupt_record"), "source_file")
    return failing, admitted


def batch_log(spark: SparkSession, checkpoint_location: str, batch_id: int) -> DataFrame:
    """What the file source has logged for a batch (every tenth log file is a compacted one)."""
    base = f"{checkpoint_location.rstrip('/')}/sources/0/{int(batch_id)}"
    return logged_files(spark, base if path_exists(spark, base) else f"{base}.compact").where(F.col("batch_id") == int(batch_id))


def write_batch_quarantine(failing: DataFrame, quarantine_path: str, batch_id: int) -> None:
    (failing.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{quarantine_path.rstrip('/')}/batch_id={int(batch_id)}"))


def run_incremental(
    spark: SparkSession,
    raw_path: str,
    table: str,
    out_path: str,
    checkpoint_location: str,
    run_id: str,
    run_ts: datetime | None,
    rejected_path: str,
    max_files_per_trigger: int | None = None,
    quarantine_path: str | None = None,
) -> None:
    """One ``availableNow`` run into the catalog table ``table`` kept at ``out_path`` (created by the first batch).

    ``rejected_path`` and ``quarantine_path`` belong to this checkpoint alone (batch ids are its own);
    without ``max_files_per_trigger`` all new files are one batch and one merge. A checkpoint keeps to one of the two modes."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if quarantine_path is None:
        files = (reader.schema(RAW_SCHEMA).option("multiLine", "true").option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", "_corrupt_record").json(raw_path))
    else:
        files = reader.schema(BINARY_FILE_SCHEMA).format("binaryFile").load(raw_path)
    stream = files.withColumn("source_file", F.col("_metadata.file_path"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        session, documents = batch.sparkSession, batch
        if quarantine_path is not None:
            failing, documents = gate(batch, batch_log(session, checkpoint_location, epoch_id))
            write_batch_quarantine(failing, quarantine_path, epoch_id)
        upsert_batch(session, documents, table, out_path, run_id, run_ts, rejected_path, epoch_id)

    q = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if table_exists(spark, table):
        spark.catalog.refreshTable(table)  # batches run in a session of their own
