"""The two batch jobs as functions (session, run id, stage order, actions).

Operators stay pure ``DataFrame -> DataFrame``; only these wrappers run actions,
write and raise. Differences from the job they re-implement:

* rejects are written *before* the empty-batch error, so audit rows are never lost;
* the validated rows are written once, apart by validity, and counted by the same pass; both
  branches read that, so the valid and rejected counts always describe the same input;
* everything a job stages lies in the shared scratch folder (survives executor loss) and is
  deleted when the job ends, also by an error;
* the table is checked before the load and the load after it;
* data-quality rules can flag or quarantine rows (``dq``);
* the run timestamp is a UTC-aware literal, identical across actions.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.dedupe import dedupe_repeated
from aerolake.operators.explode import explode_states, parse_state_elements
from aerolake.operators.literals import new_run
from aerolake.operators.project import curate, processed_projection
from aerolake.operators.quality import CAST_FAILURES_COL, FLAG, QUARANTINE_REASON, check_actions, route, with_cast_failures
from aerolake.operators.validate import is_valid, rejection_reason, with_field_count, with_reject_audit
from aerolake.schema import CURATED_COLUMNS, PREVIEW_COLUMNS
from aerolake.session import configure, ensure_checkpoint_dir, scratch_path, scratch_scope, staged
from aerolake.sinks.curated import preflight, verify_load, write_curated
from aerolake.sinks.writers import preview_rows, write_processed, write_rejected
from aerolake.sources.landing import validate_latest
from aerolake.sources.raw_json import payload_status, read_raw

log = logging.getLogger(__name__)

CODE_NO_VALID_VECTORS = "NO_VALID_VECTORS"
#: Columns of an exploded row that its audit row keeps besides the reason.
AUDIT_COLUMNS = ("payload_status", "document_text", "field_count")


@dataclass
class RunSummary:
    run_id: str
    raw_count: int = 0
    valid_count: int = 0
    rejected_count: int = 0
    quarantined_count: int = 0
    merge_source_count: int = 0
    flagged: dict = field(default_factory=dict)
    actions: dict = field(default_factory=dict)

    @property
    def balanced(self) -> bool:
        return self.raw_count == self.valid_count + self.rejected_count + self.quarantined_count


def validated_rows(spark: SparkSession, raw_path: str | list[str], multiline: bool = True) -> DataFrame:
    """Scan -> parse elements -> explode (outer) -> field count."""
    return validated(read_raw(spark, raw_path, multiline))


def validated(raw: DataFrame) -> DataFrame:
    """Read documents -> one row per vector with its field count, and the document's status and unreadable text
    (NULL for a readable one) for the audit."""
    parsed = parse_state_elements(raw).withColumn("payload_status", payload_status()).withColumnRenamed(
        "_corrupt_record", "document_text")
    return with_field_count(explode_states(parsed, keep=["payload_status", "document_text"]))


def stage_by_validity(rows: DataFrame, summary: RunSummary) -> tuple[DataFrame, DataFrame]:
    """Write the validated rows once, valid and rejected ones apart, and count them in the same pass."""
    spark, seen = rows.sparkSession, Observation("validated")
    path = scratch_path(spark, "validated")
    marked = rows.withColumn("row_ok", is_valid())
    (marked.observe(seen, F.count(F.lit(1)).alias("raw"), F.count_if("row_ok").alias("valid"))
     .write.partitionBy("row_ok").option("compression", "zstd").parquet(path))
    summary.raw_count, summary.valid_count = int(seen.get["raw"]), int(seen.get["valid"])
    summary.rejected_count = summary.raw_count - summary.valid_count
    back = spark.read.schema(marked.schema).parquet(path)
    valid, rejected = (back.where(F.col("row_ok") == F.lit(ok)).drop("row_ok") for ok in (True, False))
    return valid, rejected.withColumn("rejection_reason", rejection_reason())


def route_by_rules(valid: DataFrame, summary: RunSummary, dq: dict[str, str], run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """Curated rows that no quarantining rule holds back, and audit rows of the others; counts go to the summary."""
    keep = (*AUDIT_COLUMNS, "state", CAST_FAILURES_COL)
    routed = route(curate(with_cast_failures(valid), summary.run_id, run_ts, keep=keep), dq)
    held = F.size("quarantined_by") > 0
    flags = [r for r, a in dq.items() if a == FLAG]
    counts = routed.agg(F.count_if(held).alias("held"),
                        *[F.count_if(~held & F.array_contains("flags", r)).alias(r) for r in flags]).first()
    summary.quarantined_count = int(counts["held"])
    summary.valid_count -= summary.quarantined_count
    summary.flagged = {r: int(counts[r]) for r in flags}
    audit = routed.where(held).select(
        "source_response_time", "source_file", *AUDIT_COLUMNS[:2], "state_position", F.to_json("state").alias("state_raw"), "field_count",
        F.concat(F.lit(QUARANTINE_REASON), F.array_join("quarantined_by", "+")).alias("rejection_reason"))
    return routed.where(~held).select(*CURATED_COLUMNS), audit


def run_curated(
    spark: SparkSession,
    raw_path: str | list[str],
    table: str,
    rejected_path: str,
    table_path: str | None = None,
    run_id: str | None = None,
    run_ts: datetime | None = None,
    dq: dict[str, str] | None = None,
) -> RunSummary:
    """Raw documents -> curated table (create on first run, keyed upsert afterwards) + reject audit.

    ``dq``: rule name -> ``flag`` (counted, loaded) or ``quarantine`` (to the audit instead of the table)."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    check_actions(dq or {})
    preflight(spark, table)
    rid, rts = new_run()
    run_id, run_ts = run_id or rid, run_ts or rts
    summary = RunSummary(run_id)
    with scratch_scope(spark):
        valid, rejected = stage_by_validity(validated_rows(spark, raw_path), summary)
        # Rejects first: an empty valid batch must not lose its audit rows.
        if summary.rejected_count:
            write_rejected(with_reject_audit(rejected.drop("state"), run_id, run_ts), rejected_path, mode="append")
        rows = curate(valid, run_id, run_ts)
        if dq:
            rows, held = route_by_rules(valid, summary, dq, run_ts)
            if summary.quarantined_count:
                write_rejected(with_reject_audit(held, run_id, run_ts), rejected_path, mode="append")
        source = staged(dedupe_repeated(rows, written=lambda keys: staged(keys, "repeated-keys")), "curated-source")
        summary.merge_source_count = source.count()
        if summary.merge_source_count == 0:
            raise RuntimeError(f"{CODE_NO_VALID_VECTORS}: {raw_path}")
        summary.actions = write_curated(spark, source, table, table_path, count=summary.merge_source_count)
        verify_load(spark, table, run_id, summary.actions.get("insert", 0) + summary.actions.get("update", 0))
        log.info("curated run %s: %s", run_id, summary)
        return summary


def run_latest(spark: SparkSession, landing_path: str, table: str, rejected_path: str, table_path: str | None = None,
               modified_after: datetime | None = None, **options) -> RunSummary:
    """The hand-over of a scheduled run: check the newest landed object, then load exactly that one."""
    return run_curated(spark, validate_latest(spark, landing_path, modified_after), table, rejected_path, table_path, **options)


def run_processed(
    spark: SparkSession,
    raw_path: str | list[str],
    processed_path: str,
    rejected_path: str,
    run_ts: datetime | None = None,
    show_preview: bool = False,
) -> RunSummary:
    """Raw documents -> day-partitioned processed Parquet + rejected Parquet (dynamic overwrite).

    The processed writer replaces whole ``event_date`` days, so ``raw_path``
    must cover every document of the days it touches (e.g. the whole prefix).
    """
    configure(spark)
    ensure_checkpoint_dir(spark)
    _, rts = new_run()
    run_ts = run_ts or rts
    summary = RunSummary(run_id="")
    with scratch_scope(spark):
        valid, rejected = stage_by_validity(validated_rows(spark, raw_path), summary)
        processed = processed_projection(curate(valid, None, run_ts))
        if show_preview:
            preview_rows(processed, PREVIEW_COLUMNS).show(20, truncate=False)
        if summary.valid_count:
            write_processed(processed, processed_path)
        else:
            log.warning("no valid records; processed output not written")
        if summary.rejected_count:
            audit = with_reject_audit(rejected.drop("state"), "", run_ts).drop("processing_run_id")
            write_rejected(audit, rejected_path, mode="overwrite")
        return summary
