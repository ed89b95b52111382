"""Named queries over the supplied tables (the registry behind ``__spark_entry__``).

Every query reads the whole ``events`` table, maps it onto state vectors /
response documents (``aerolake.sources.fixtures``) and runs one operator or
job slice on top. Run-level values (run id, run timestamp) are fixed literals
so results are reproducible; anything written goes to a fresh folder under
the shared checkpoint directory.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.dedupe import dedupe_by_key
from aerolake.operators.explode import explode_states, parse_state_elements
from aerolake.operators.merge import (
    classify_merge,
    merge_action_counts,
    merge_changed,
    merge_frames,
    merge_inserts,
)
from aerolake.operators.nested import light_transform
from aerolake.operators.project import (
    curate,
    derive_event_time,
    derive_units,
    narrow_projection,
    preview,
    processed_projection,
    project_state_vector,
    with_payload_hash,
    with_record_key,
)
from aerolake.operators.quality import CAST_FAILURES_COL, violation_summary, with_cast_failures, with_violations
from aerolake.operators.validate import (
    reconcile_counts,
    split_valid_rejected,
    with_field_count,
    with_reject_audit,
)
from aerolake.schema import LIGHT_SLOT_NAMES, PREVIEW_COLUMNS, RAW_PREFIX
from aerolake.session import configure, ensure_checkpoint_dir, scratch_path
from aerolake.sinks.curated import check_table, create_curated_table, merge_into_table, table_exists
from aerolake.sinks.writers import create_table, write_processed, write_rejected
from aerolake.sources.fixtures import (
    build_payloads,
    event_payloads,
    event_vectors,
    load_table,
    vectors_as_exploded,
)
from aerolake.sinks.landing import land_documents, land_json_lines
from aerolake.sources.landing import LISTING_SCHEMA, classify_landed, latest_object, list_files, payload_json
from aerolake.sources.raw_json import payload_status, read_raw, read_raw_partition
from aerolake.sources.tables import read_table, register_parquet_table

# Fixed literals that stand in for per-run values.
RUN_ID = "run-fixed-0001"
RUN_TS = datetime(2024, 2, 1, 0, 0, 0, tzinfo=timezone.utc)
RERUN_ID = "run-fixed-0002"
QUERY_DAY = date(2024, 1, 15)
LANDING_DELAY_S = 45
# Merge inputs are two overlapping time windows, like consecutive incremental
# batches: the existing table holds responses before 2024-01-22, the new batch
# re-delivers responses from 2024-01-16 on with corrected 'purchase' values.
# Responses before the overlap are kept, the overlap is no-op or update, later
# ones are inserts; together the two windows cover every event.
EDITED_VALUE_SQL = "case when event_type = 'purchase' then value + 1 else value end"
TARGET_SPLIT_SQL = "source_response_time < 1705881600"
SOURCE_SPLIT_SQL = "source_response_time >= 1705363200"
RELANDED_PREFIX = "events/relanded"
_KEY_HASH = ("record_key", "payload_hash")


def _session(spark: SparkSession) -> SparkSession:
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(_session(spark), sf_dir, "events")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_payloads(events(spark, sf_dir))


def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_states(payloads(spark, sf_dir), base_position_col="base_position")


def curated_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    return curate(valid, RUN_ID, RUN_TS)


def _curated_from_vectors(vectors: DataFrame, prefix: str, run_id: str) -> DataFrame:
    valid, _ = split_valid_rejected(vectors_as_exploded(vectors, prefix))
    return curate(valid, run_id, RUN_TS)


def _hour_window(sql: str) -> F.Column:
    """The response-time window on the events of whole hours (both split points are hour
    boundaries and a response lies less than an hour after its hour's end), so it can
    be pushed into the events scan ahead of the rank without changing any position."""
    return F.expr(sql.replace("source_response_time", "((unix_seconds(cast(ts as timestamp)) div 3600 + 1) * 3600)"))


def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing table: vectors of responses before 2024-01-22."""
    ev = events(spark, sf_dir).where(_hour_window(TARGET_SPLIT_SQL))
    vec = event_vectors(ev).where(F.expr(TARGET_SPLIT_SQL))
    return _curated_from_vectors(vec, "events/payload", RUN_ID)


def merge_source(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """New batch: responses from 2024-01-16 on; 'purchase' vectors carry a corrected value.

    ``columns`` (the key and the hash at least) are chosen ahead of the dedupe, whose aggregate would
    otherwise carry whole rows; the survivor has the smallest hash either way."""
    ev = events(spark, sf_dir).where(_hour_window(SOURCE_SPLIT_SQL))
    vec = event_vectors(ev, F.expr(EDITED_VALUE_SQL)).where(F.expr(SOURCE_SPLIT_SQL))
    rows = _curated_from_vectors(vec, RELANDED_PREFIX, RERUN_ID)
    return dedupe_by_key(rows.select(*columns) if columns else rows)


# --------------------------------------------------------------------------- queries


def q_explode_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_field_count(exploded(spark, sf_dir)).select(
        "source_response_time", "state_position", "field_count"
    )


def _ingested() -> F.Column:
    return F.timestamp_seconds(F.col("time") + F.lit(LANDING_DELAY_S))


def _land_payloads(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None, body: F.Column | None = None) -> str:
    """Land every document (its own JSON, or ``body``) and return the landing prefix."""
    base = scratch_path(spark, "landing")
    docs = payloads(spark, sf_dir) if docs is None else docs
    land_documents(docs, base, _ingested(), payload_json() if body is None else body)
    return f"{base}/{RAW_PREFIX}"


def q_raw_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _land_payloads(spark, sf_dir)
    raw = parse_state_elements(read_raw(spark, base))
    rows = with_field_count(explode_states(raw))
    return rows.groupBy("source_response_time").agg(
        F.count(F.lit(1)).alias("n_states"),
        F.count_if((F.col("field_count") == 17)).alias("n_valid"),
        F.count_distinct("source_file").alias("n_files"),
    )


def q_raw_day_partition_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental selection - one landing day of the raw prefix, chosen by a
    ``year/month/day`` partition filter (pruned at planning time, other days' files
    are never opened)."""
    base = _land_payloads(spark, sf_dir)
    d = QUERY_DAY
    raw = parse_state_elements(read_raw_partition(spark, base, year=d.year, month=d.month, day=d.day))
    rows = with_field_count(explode_states(raw))
    return rows.groupBy("source_response_time").agg(
        F.count(F.lit(1)).alias("n_states"),
        F.count_if(F.col("field_count") == 17).alias("n_valid"),
    )


def q_validate_split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    return valid.select("source_response_time", "state_position", "field_count")


def q_validate_split_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid_rejected(exploded(spark, sf_dir))
    return rejected.select("source_response_time", "state_position", "field_count", "rejection_reason")


def q_reject_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid_rejected(exploded(spark, sf_dir))
    audit = with_reject_audit(rejected, RUN_ID, RUN_TS).drop("state")
    path = scratch_path(spark, "rejected")
    write_rejected(audit, path, mode="append")
    back = spark.read.parquet(path)
    return back.select(
        "source_response_time",
        "state_position",
        "field_count",
        "rejection_reason",
        "processing_run_id",
        F.unix_seconds("rejection_timestamp").alias("rejection_epoch"),
        "ingestion_date",
    )


def q_project_state_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    p = project_state_vector(valid, RUN_ID, RUN_TS)
    return p.withColumn("sensors", F.col("sensors").cast("string")).drop(
        "source_file", "processing_run_id", "ingestion_timestamp"
    )


def q_derive_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    d = derive_event_time(project_state_vector(valid, RUN_ID, RUN_TS))
    return d.select(
        "source_response_time",
        "state_position",
        "event_timestamp_epoch",
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
        "event_date",
    )


def q_derive_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    d = derive_units(project_state_vector(valid, RUN_ID, RUN_TS))
    return d.select(
        "source_response_time", "state_position", "velocity_kmh", "barometric_altitude_ft", "geometric_altitude_ft"
    )


def q_record_key_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    d = with_record_key(project_state_vector(valid, RUN_ID, RUN_TS))
    return d.select("source_response_time", "state_position", "record_key")


def q_payload_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    d = project_state_vector(valid, RUN_ID, RUN_TS)
    d = with_payload_hash(derive_units(derive_event_time(d)))
    return d.select("source_response_time", "state_position", "payload_hash")


def q_dedupe_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    first = _curated_from_vectors(event_vectors(ev), "events/payload", RUN_ID)
    again = _curated_from_vectors(event_vectors(ev, F.expr(EDITED_VALUE_SQL)), RELANDED_PREFIX, RERUN_ID)
    return dedupe_by_key(first.unionByName(again)).select(
        "record_key", "payload_hash", "source_file", "velocity_m_s"
    )


def q_merge_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_merge(merge_target(spark, sf_dir), merge_source(spark, sf_dir, _KEY_HASH))


def q_merge_action_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_action_counts(merge_target(spark, sf_dir), merge_source(spark, sf_dir, _KEY_HASH))


_UPSERT_COLS = ["record_key", "payload_hash", "source_file", "processing_run_id", "velocity_m_s", "event_date"]


def q_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_frames(merge_target(spark, sf_dir), merge_source(spark, sf_dir)).select(*_UPSERT_COLS)


def q_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_inserts(merge_target(spark, sf_dir), merge_source(spark, sf_dir, _KEY_HASH)).select(
        "record_key", "payload_hash"
    )


def q_merge_changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_changed(merge_target(spark, sf_dir), merge_source(spark, sf_dir, _KEY_HASH)).select(
        "record_key", "target_hash", "payload_hash"
    )


def q_merge_idempotent_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = merge_source(spark, sf_dir)
    once = merge_frames(merge_target(spark, sf_dir), source)
    return merge_frames(once, source).select(*_UPSERT_COLS)


def q_reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_counts(exploded(spark, sf_dir))


def _write_processed_table(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "processed")
    write_processed(processed_projection(curated_all(spark, sf_dir)), path)
    return path


def q_processed_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_processed_table(spark, sf_dir)
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def q_dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_processed_table(spark, sf_dir)
    table = spark.read.parquet(path)
    first_day = table.agg(F.min("event_date")).first()[0]
    # Re-deliver the two earliest days with another source tag; other days stay as written.
    rerun = (
        processed_projection(curated_all(spark, sf_dir))
        .where(F.col("event_date") <= F.date_add(F.lit(first_day), 1))
        .withColumn("source", F.lit("opensky-rerun"))
    )
    write_processed(rerun, path)
    return spark.read.parquet(path).groupBy("event_date", "source").agg(F.count(F.lit(1)).alias("n"))


def q_processed_table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema and partition discovery over written Parquet (``CREATE TABLE ... LOCATION``
    + ``MSCK REPAIR``), then the per-day counts through the catalog."""
    path = _write_processed_table(spark, sf_dir)
    name = "processed_" + path.rsplit("-", 1)[-1]
    return register_parquet_table(spark, name, path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


def q_pruned_day_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_processed_table(spark, sf_dir)
    return narrow_projection(spark.read.parquet(path).where(F.col("event_date") == F.lit(QUERY_DAY)))


def q_country_counts_for_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_processed_table(spark, sf_dir)
    day = spark.read.parquet(path).where(F.col("event_date") == F.lit(QUERY_DAY))
    return day.groupBy("origin_country").agg(F.count(F.lit(1)).alias("n"))


def q_country_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day query as analysts write it - a named view and ``spark.sql``."""
    path = _write_processed_table(spark, sf_dir)
    view = "processed_states_" + path.rsplit("-", 1)[-1]
    spark.read.parquet(path).createOrReplaceTempView(view)
    return spark.sql(
        f"SELECT origin_country, COUNT(*) AS n FROM {view} "
        f"WHERE event_date = DATE '{QUERY_DAY.isoformat()}' GROUP BY origin_country"
    )


def q_preview_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = preview(curated_all(spark, sf_dir), 20)
    return p.withColumn("event_timestamp", F.col("event_timestamp").cast("string")).select(
        "record_key", *PREVIEW_COLUMNS
    )


def q_nested_light_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    light = light_transform(payloads(spark, sf_dir), RUN_TS)
    return light.select(
        "source_response_time",
        "base_position",
        "record_count",
        "skipped_count",
        F.get("states", 0)["callsign"].alias("first_callsign"),
        F.get("states", F.size("states") - 1)["callsign"].alias("last_callsign"),
    )


def q_landing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from aerolake.functions.timefmt import landing_key

    docs = payloads(spark, sf_dir)
    ts = F.timestamp_seconds(F.col("time") + F.lit(LANDING_DELAY_S))
    return docs.select(
        F.col("time").alias("source_response_time"), "base_position", landing_key(ts).alias("landing_key")
    )


def _at_hour(hour: int, body: F.Column) -> F.Column:
    """``body`` for documents landed in that UTC hour, their own JSON otherwise."""
    return F.when(F.hour(_ingested()) == hour, body).otherwise(payload_json())


TRUNCATED_SQL = "substring(to_json(struct(time, states)), 1, 40)"


def seeded_body() -> F.Column:
    """Every landing failure once a day: the document's hour decides (0 truncated, 1 zero bytes, 2 no UTF-8, 3 states an object,
    4 states empty, 5 a list, 6 no states)."""
    odd = [F.expr(TRUNCATED_SQL).cast("binary"), F.lit(b""), F.expr("unhex('7B22737461746573223A5B5B22C32822')")]
    odd += [F.lit(t).cast("binary") for t in ('{"states":{"a":1}}', '{"states":[]}', "[1,2]", '{"time":1}')]
    body = payload_json().cast("binary")
    for hour, text in enumerate(odd):
        body = F.when(F.hour(_ingested()) == hour, text).otherwise(body)
    return body


#: The document that lands last, a day after every other.
LAST_BODY = '{"time":1,"states":[["x"]]}'


def _seeded_landing(spark: SparkSession, sf_dir: str) -> str:
    """Land every payload, some of them broken by their hour, then one last document."""
    docs = payloads(spark, sf_dir)
    prefix = _land_payloads(spark, sf_dir, docs, seeded_body())
    last = docs.agg((F.max("time") + 86400).alias("time"))
    land_documents(last, prefix[: -len(RAW_PREFIX) - 1], _ingested(), F.lit(LAST_BODY))
    return prefix


def q_landing_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every landed object, by landing day."""
    base = _seeded_landing(spark, sf_dir)
    day = F.regexp_extract("path", r"year=(\d+)/month=(\d+)/day=(\d+)", 0)
    return classify_landed(spark, base).groupBy(day.alias("landing_day"), "code").agg(F.count(F.lit(1)).alias("n"))


def q_landed_object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the keys found in storage after landing, zero-byte objects included."""
    base = _seeded_landing(spark, sf_dir)
    return list_files(spark, base).select(F.regexp_extract("path", f"({RAW_PREFIX}/.*)$", 1).alias("landing_key"),
                                          (F.col("length") == 0).alias("is_empty"))


def q_json_lines_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 as JSON Lines: many documents a file, read back line by line."""
    base = scratch_path(spark, "landing-lines")
    land_json_lines(payloads(spark, sf_dir), base, _ingested(), payload_json())
    rows = with_field_count(explode_states(parse_state_elements(read_raw(spark, base, multiline=False))))
    return rows.groupBy("source_response_time").agg(F.count(F.lit(1)).alias("n_states"), F.count_if(F.col("field_count") == 17).alias("n_valid"))


def q_string_states_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed in the 00:00 hour hold their ``states`` as a JSON string; they are one rejected row each."""
    as_text = F.to_json(F.struct("time", F.to_json("states").alias("states")))
    base = _land_payloads(spark, sf_dir, body=_at_hour(0, as_text))
    rows = with_field_count(explode_states(parse_state_elements(read_raw(spark, base))))
    return rows.groupBy("source_response_time").agg(
        F.count_if(F.col("field_count") == 17).alias("n_valid"), F.count_if(F.col("field_count") != 17).alias("n_rejected"))


def q_corrupt_document_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents, the 00:00-hour ones truncated. A corrupt document flows to the
    rejects as one ``STATE_ARRAY_IS_NULL`` row without response time; ``payload_status``
    tells it apart from a NULL vector inside a good document."""
    base = _land_payloads(spark, sf_dir, body=_at_hour(0, F.expr(TRUNCATED_SQL)))
    docs = parse_state_elements(read_raw(spark, base)).withColumn("payload_status", payload_status())
    _, rejected = split_valid_rejected(explode_states(docs, keep=["payload_status"]))
    return rejected.groupBy("rejection_reason", "payload_status").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("source_response_time").isNull()).alias("n_no_time"),
    )


def q_latest_landed_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _seeded_landing(spark, sf_dir)
    latest = latest_object(list_files(spark, base)).first()
    one = spark.createDataFrame([latest], LISTING_SCHEMA)
    latest = classify_landed(spark, latest["path"], one)
    return latest.select(F.regexp_extract("path", r"(year=.*)$", 1).alias("key"), "length", "code")


def q_nested_missing_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed in the 06:00 hour have no ``states``."""
    base = _land_payloads(spark, sf_dir, body=_at_hour(6, F.to_json(F.struct("time"))))
    light = light_transform(parse_state_elements(read_raw(spark, base)), RUN_TS)
    return light.select("source_response_time", "error", "record_count", "skipped_count")


def q_nested_light_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field of every vector of the nested transform."""
    light = light_transform(payloads(spark, sf_dir), RUN_TS)
    rows = light.select(F.explode("states").alias("s"))
    return rows.select(*[F.col(f"s.{c}") for c in (*LIGHT_SLOT_NAMES, "source", "source_response_time", "ingestion_timestamp")])


def q_curated_create_or_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "curated_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    path = scratch_path(spark, "curated")
    create_curated_table(dedupe_by_key(merge_target(spark, sf_dir)), name, path)
    merge_into_table(spark, name, merge_source(spark, sf_dir))
    return spark.table(name).select(*_UPSERT_COLS)


def q_unpartitioned_table_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + F12 + F13 + S7: unpartitioned ``writeTo().using("parquet").create()`` of every
    curated vector's identity columns, post-load check, then a catalog scan."""
    name = "smoke_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    if table_exists(spark, name):
        raise RuntimeError(f"table {name} already exists")
    rows = curated_all(spark, sf_dir).select("record_key", "callsign", "origin_country")
    create_table(rows, name, path=scratch_path(spark, "smoke"))
    check_table(spark, name, "parquet")
    return read_table(spark, name).groupBy("origin_country").agg(
        F.count(F.lit(1)).alias("n"), F.count("callsign").alias("n_callsign")
    )


def q_curated_job_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated batch job on landed files, twice - the first run creates
    the table from the earlier response window, the second merges the overlapping,
    corrected later window (inserts, updates, no-ops)."""
    from aerolake.jobs import run_curated

    ev = events(spark, sf_dir)
    target_vec = event_vectors(ev.where(_hour_window(TARGET_SPLIT_SQL)), by_response=True).where(F.expr(TARGET_SPLIT_SQL))
    first = _land_payloads(spark, sf_dir, build_payloads(target_vec))
    edited = event_vectors(ev.where(_hour_window(SOURCE_SPLIT_SQL)), F.expr(EDITED_VALUE_SQL), by_response=True).where(
        F.expr(SOURCE_SPLIT_SQL)
    )
    second = _land_payloads(spark, sf_dir, build_payloads(edited, RELANDED_PREFIX))
    name = "curated_job_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    rejected = scratch_path(spark, "rejected")
    run_curated(spark, first, name, rejected, scratch_path(spark, "curated"), run_id=RUN_ID, run_ts=RUN_TS)
    run_curated(spark, second, name, rejected, run_id=RERUN_ID, run_ts=RUN_TS)
    return spark.table(name).select(*[c for c in _UPSERT_COLS if c != "source_file"])


def q_processed_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed batch job on every landed document, read back by day."""
    from aerolake.jobs import run_processed

    raw = _land_payloads(spark, sf_dir)
    out = scratch_path(spark, "processed")
    run_processed(spark, raw, out, scratch_path(spark, "rejected"), run_ts=RUN_TS)
    return spark.read.parquet(out).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("callsign").alias("n_callsign")
    )


def q_processed_job_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the rejects the processed job leaves when it runs twice on one day, read back."""
    from aerolake.jobs import run_processed

    raw, rejected = _land_payloads(spark, sf_dir), scratch_path(spark, "rejected")
    for _ in range(2):
        run_processed(spark, raw, scratch_path(spark, "processed"), rejected, run_ts=RUN_TS)
    return spark.read.parquet(rejected).select(
        "source_response_time", "state_position", "field_count", "rejection_reason", "payload_status", "ingestion_date")


def q_empty_batch_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a batch of the malformed vectors alone; the job raises, and its audit rows are there."""
    from aerolake.jobs import CODE_NO_VALID_VECTORS, run_curated

    vectors = event_vectors(events(spark, sf_dir)).where("state IS NULL OR size(state) != 17")
    raw, rejected = _land_payloads(spark, sf_dir, build_payloads(vectors)), scratch_path(spark, "rejected")
    name = "empty_batch_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    try:
        run_curated(spark, raw, name, rejected, scratch_path(spark, "curated"), run_id=RUN_ID, run_ts=RUN_TS)
    except RuntimeError as e:
        if CODE_NO_VALID_VECTORS not in str(e):
            raise
        outcome = CODE_NO_VALID_VECTORS
    else:
        outcome = "LOADED"
    return spark.read.parquet(rejected).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit(outcome))


DQ_ACTIONS = {"LATITUDE_OUT_OF_RANGE": "quarantine", "LAST_CONTACT_MISSING": "quarantine", "TRUE_TRACK_OUT_OF_RANGE": "flag"}


def q_curated_job_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 in the job: rows by where they went and why; the counts add up to the raw vectors."""
    from aerolake.jobs import run_curated

    raw, rejected = _land_payloads(spark, sf_dir), scratch_path(spark, "rejected")
    name = "curated_dq_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    run = run_curated(spark, raw, name, rejected, scratch_path(spark, "curated"), run_id=RUN_ID, run_ts=RUN_TS, dq=DQ_ACTIONS)
    loaded = spark.table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit("loaded").alias("outcome"), F.lit("").alias("reason"), "n")
    held = spark.read.parquet(rejected).groupBy(F.lit("held").alias("outcome"), F.col("rejection_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))
    counted = [("raw", "", run.raw_count), ("balanced", "", int(run.balanced))] + [("flagged", r, n) for r, n in run.flagged.items()]
    return loaded.unionByName(held).unionByName(spark.createDataFrame(counted, "outcome string, reason string, n long"))


def q_latest_object_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hand-over: the newest landed object is checked, and the curated job loads exactly that one."""
    from aerolake.jobs import run_latest

    docs = payloads(spark, sf_dir)
    prefix = _land_payloads(spark, sf_dir, docs, seeded_body())
    newest = docs.agg(F.max_by(F.struct("time", "states"), "time").alias("d")).select("d.*")
    land_documents(newest.withColumn("time", F.col("time") + 86400), prefix[: -len(RAW_PREFIX) - 1], _ingested(), payload_json())
    name = "latest_job_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    run_latest(spark, prefix, name, scratch_path(spark, "rejected"), scratch_path(spark, "curated"), run_id=RUN_ID, run_ts=RUN_TS)
    return spark.table(name).select("record_key", "payload_hash", "state_position", "source_response_time")


def q_gated_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + S6: seeded landing through the admission gate: quarantined files by code, merged and rejected vectors."""
    from aerolake.streaming.incremental import run_incremental

    base = _seeded_landing(spark, sf_dir)
    out, rejects, held, ckpt = (scratch_path(spark, f"gated{x}") for x in ("", "-rejects", "-quarantine", "-ckpt"))
    name = "gated_" + out.rsplit("-", 1)[-1]
    for _ in range(2):  # the second run finds nothing new: no batch
        run_incremental(spark, base, name, out, ckpt, RUN_ID, RUN_TS, rejects, quarantine_path=held)
    parts = [(spark.read.parquet(held), "quarantined", "code"), (spark.read.parquet(rejects), "rejected", "rejection_reason"),
             (spark.table(name), "merged", "source")]
    counts = [rows.groupBy(F.lit(kind).alias("outcome"), F.col(why).alias("reason")).agg(F.count(F.lit(1)).alias("n")) for rows, kind, why in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def _curated_with_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid_rejected(exploded(spark, sf_dir))
    return curate(with_cast_failures(valid), RUN_ID, RUN_TS, keep=(CAST_FAILURES_COL,))


def q_dq_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = with_violations(_curated_with_cast_failures(spark, sf_dir))
    return v.select("record_key", F.array_join("violations", ",").alias("violations"))


def q_dq_violation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violation_summary(_curated_with_cast_failures(spark, sf_dir))


def _run_incremental(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    from aerolake.streaming.incremental import run_incremental

    base = _land_payloads(spark, sf_dir)
    out, rejects, ckpt = (scratch_path(spark, f"incremental{x}") for x in ("", "-rejects", "-ckpt"))
    name = "incremental_" + out.rsplit("-", 1)[-1]
    for _ in range(2):  # the second run finds nothing new: no batch
        run_incremental(spark, base, name, out, ckpt, RUN_ID, RUN_TS, rejects)
    return name, rejects


def q_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested and rejected vectors of each response."""
    name, rejects = _run_incremental(spark, sf_dir)
    times = [rows.select("source_response_time", F.lit(k).alias("k"))
             for rows, k in ((spark.table(name), 0), (spark.read.parquet(rejects), 1))]
    return times[0].unionByName(times[1]).groupBy("source_response_time").agg(
        F.count_if(F.col("k") == 0).alias("n"), F.count_if(F.col("k") == 1).alias("n_rejected"))


def q_incremental_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit rows the incremental run leaves for rejected vectors."""
    _, rejects = _run_incremental(spark, sf_dir)
    return spark.read.parquet(rejects).select(
        "source_response_time", "state_position", "field_count", "rejection_reason", "payload_status", "processing_run_id",
        F.unix_seconds("rejection_timestamp").alias("rejection_epoch"))


def q_end_to_end_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """payloads -> validate -> project -> dedupe -> merge -> counts per country for one day."""
    merged = merge_frames(merge_target(spark, sf_dir), merge_source(spark, sf_dir))
    day = merged.where(F.col("event_date") == F.lit(QUERY_DAY))
    return day.groupBy("origin_country").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "explode_payloads": q_explode_payloads,
    "raw_json_scan": q_raw_json_scan,
    "raw_day_partition_read": q_raw_day_partition_read,
    "validate_split_valid": q_validate_split_valid,
    "validate_split_rejected": q_validate_split_rejected,
    "reject_audit": q_reject_audit,
    "project_state_vector": q_project_state_vector,
    "derive_event_time": q_derive_event_time,
    "derive_units": q_derive_units,
    "record_key_hash": q_record_key_hash,
    "payload_hash": q_payload_hash,
    "dedupe_record_key": q_dedupe_record_key,
    "merge_classify": q_merge_classify,
    "merge_action_summary": q_merge_action_summary,
    "merge_upsert": q_merge_upsert,
    "merge_insert_only": q_merge_insert_only,
    "merge_changed_only": q_merge_changed_only,
    "merge_idempotent_rerun": q_merge_idempotent_rerun,
    "reconcile_counts": q_reconcile_counts,
    "processed_parquet_roundtrip": q_processed_parquet_roundtrip,
    "dynamic_partition_overwrite": q_dynamic_partition_overwrite,
    "processed_table_discovery": q_processed_table_discovery,
    "pruned_day_projection": q_pruned_day_projection,
    "country_counts_for_day": q_country_counts_for_day,
    "country_counts_sql": q_country_counts_sql,
    "preview_top20": q_preview_top20,
    "nested_light_transform": q_nested_light_transform,
    "landing_key": q_landing_key,
    "landing_validation": q_landing_validation,
    "latest_landed_object": q_latest_landed_object,
    "corrupt_document_rejects": q_corrupt_document_rejects,
    "landed_object_keys": q_landed_object_keys,
    "json_lines_landing": q_json_lines_landing,
    "string_states_rejected": q_string_states_rejected,
    "nested_missing_states": q_nested_missing_states,
    "nested_light_fields": q_nested_light_fields,
    "processed_job_rejects": q_processed_job_rejects,
    "empty_batch_guard": q_empty_batch_guard,
    "curated_job_dq": q_curated_job_dq,
    "latest_object_job": q_latest_object_job,
    "gated_ingest": q_gated_ingest,
    "curated_create_or_merge": q_curated_create_or_merge,
    "unpartitioned_table_create": q_unpartitioned_table_create,
    "curated_job_two_runs": q_curated_job_two_runs,
    "processed_job": q_processed_job,
    "dq_rules": q_dq_rules,
    "dq_violation_summary": q_dq_violation_summary,
    "incremental_ingest": q_incremental_ingest,
    "incremental_rejects": q_incremental_rejects,
    "end_to_end_day_counts": q_end_to_end_day_counts,
}
