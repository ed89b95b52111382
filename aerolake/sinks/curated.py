"""K5, K7, F12, F13 and the table-backed upsert (plain Parquet, no MERGE support).

Upsert algorithm (see ``merge_into_table``):
  1. The source is unique per ``record_key`` and checkpointed (deterministic).
  2. Touched days = days of source rows ∪ days of target rows whose key is in
     the source (a key can move to another day when ``time_position`` changes).
     Found with a narrow semi-join (record_key, event_date only); the result is
     a set of dates, bounded by the calendar, not by the data.
  3. Source keys are classified against ``(record_key, payload_hash)`` of the
     touched days; the merged days are the target rows whose key is not updated
     (left anti) and the source rows that are new or changed (left semi), written
     once into a fresh folder inside the table location.
  4. The new place of every touched day is recorded in one small file, then the
     catalog's partitions are pointed at it. A run that dies in between is rolled
     forward by the next merge from that file, before it reads the table: the file
     is the commit, so the outcome of a merge never depends on where it stopped.

The same file keeps the table's zone map: for every day, the response days its rows come from. A target row
that shares a key with the batch shares its response time (part of the key), so only days whose zones meet the
batch's response days are searched for moved keys. Days the map does not know (a first merge, a lost file) are
looked up in the table once. Only merges may write the table.

The catalog table is what to read; folders of the location that no partition
points at are leftovers, removed by the merge that replaced them or the next one.
One merge at a time may run on a table.
"""

from __future__ import annotations

import json
import re
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolake.operators.merge import classify_source, merge_by_action
from aerolake.session import ensure_checkpoint_dir, scratch_scope, staged
from aerolake.sinks.writers import write_partitioned
from aerolake.sources.tables import listed_partitions, partition_spec, sync_partitions

PARTITION_COL = "event_date"
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
RESPONSE_COL = "source_response_time"
#: Folders of merged days, and the folder of the pointer file, inside the table location ("_": no partition discovery).
DATA_PREFIX, POINTERS = "_merge_data_", "_merge_pointers"


def namespace_exists(spark: SparkSession, name: str) -> bool:
    """F12."""
    return spark.catalog.databaseExists(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    """F12."""
    return spark.catalog.tableExists(name)


def check_table(spark: SparkSession, name: str, expected_provider: str = "parquet") -> None:
    """table exists, its name matches and its provider is the expected one."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"TABLE_MISSING: {name}")
    table = spark.catalog.getTable(name)
    if table.name.lower() != name.split(".")[-1].lower():
        raise RuntimeError(f"TABLE_NAME_DIFFERS: asked for {name}, catalog has {table.name}")
    provider = table_provider(spark, name)
    if provider != expected_provider.lower():
        raise RuntimeError(f"table {name} has provider {provider!r}, expected {expected_provider!r}")


def _described(spark: SparkSession, name: str, item: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == item).collect()
    return rows[0]["data_type"] if rows else ""


def table_location(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Location")


def clustered_for_write(df: DataFrame) -> DataFrame:
    """Rebalance by day (AQE splits hot days) and sort each task's rows by
    (day, response time) so Parquet row-group statistics on ``source_response_time``
    stay tight for later merges; the writer's own partition sort is then a no-op."""
    out = df.hint("rebalance", PARTITION_COL)
    order = [PARTITION_COL] + ([RESPONSE_COL] if RESPONSE_COL in df.columns else [])
    return out.sortWithinPartitions(*order)


def create_curated_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """K5: first run - Parquet/zstd, partitioned by ``event_date``."""
    w = clustered_for_write(df).write.format("parquet").option("compression", "zstd")
    if path:
        w = w.option("path", path)
    w.partitionBy(PARTITION_COL).saveAsTable(name)


def _day_name(d: date | None) -> str:
    return f"{PARTITION_COL}={DEFAULT_PARTITION if d is None else d.isoformat()}"


def _day_filter(days: list[date | None]) -> Column:
    real = [d for d in days if d is not None]
    cond = F.col(PARTITION_COL).isin(real) if real else F.lit(False)
    if any(d is None for d in days):
        cond = cond | F.col(PARTITION_COL).isNull()
    return cond


def response_time_filter(source: DataFrame) -> Column:
    """Pre-filter implied by key equality: a target row with a source key has the same
    ``source_response_time`` (it is part of the key text). The range goes to the
    Parquet reader as pushed filters, so row groups outside the batch's response-time
    range are skipped without reading the key column (the curated files are sorted by
    ``source_response_time`` within each day, which keeps the row-group ranges tight).
    """
    b = source.agg(
        F.min(RESPONSE_COL).alias("lo"),
        F.max(RESPONSE_COL).alias("hi"),
        F.count_if(F.col(RESPONSE_COL).isNull()).alias("nulls"),
    ).first()
    cond = F.lit(False)
    if b["lo"] is not None:
        cond = F.col(RESPONSE_COL).between(int(b["lo"]), int(b["hi"]))
    if b["nulls"]:
        cond = cond | F.col(RESPONSE_COL).isNull()
    return cond


#: The day of a response as a number of days, NULL for a row without response time.
RESPONSE_DAY = f"cast({RESPONSE_COL} div 86400 as int)"


def zones_of(df: DataFrame) -> dict[str, list[int | None]]:
    """Day name -> response days of its rows; bounded by the calendar."""
    out: dict[str, list[int | None]] = {}
    for day, response in df.select(PARTITION_COL, F.expr(RESPONSE_DAY)).distinct().collect():
        out.setdefault(_day_name(day), []).append(response)
    return out


def zone_map(spark: SparkSession, name: str, pointers: DayPointers) -> dict[str, list[int | None]]:
    """The zones of every day of the table; days that the pointer file does not know are read once."""
    listed = listed_partitions(spark, name)
    unknown = [_day_of(d) for d in listed if d not in pointers.zones]
    found = zones_of(spark.table(name).where(_day_filter(unknown))) if unknown else {}
    return {d: z for d, z in (pointers.zones | found).items() if d in listed}


def _day_of(name: str) -> date | None:
    value = name.split("=", 1)[1]
    return None if value == DEFAULT_PARTITION else date.fromisoformat(value)


def touched_days(target: DataFrame, source: DataFrame, key: str = "record_key",
                 zones: dict[str, list[int | None]] | None = None) -> list[date | None]:
    """Days of the source rows plus days of target rows whose key is in the source.

    The returned list is bounded by the calendar, not by the data.
    """
    return [r[0] for r in touched_days_frame(target, source, key, zones).collect()]


def touched_days_frame(target: DataFrame, source: DataFrame, key: str = "record_key",
                       zones: dict[str, list[int | None]] | None = None) -> DataFrame:
    src_days = source.select(PARTITION_COL)
    candidates = target
    if RESPONSE_COL in target.columns and RESPONSE_COL in source.columns:
        candidates = target.where(response_time_filter(source))
        if zones is not None:
            batch = {r[0] for r in source.select(F.expr(RESPONSE_DAY)).distinct().collect()}
            candidates = candidates.where(_day_filter([_day_of(d) for d, z in zones.items() if batch & set(z)]))
    moved = candidates.select(key, PARTITION_COL).join(source.select(key), key, "left_semi").select(PARTITION_COL)
    return src_days.union(moved).distinct()


class DayPointers:
    """Where each merged day of a table lives: one small JSON file in the table location.

    ``days`` maps a day folder name to the data folder that holds it ("" where a merge left the day
    empty); days never merged are at their usual place. ``switch`` lists the days of the last merge and
    ``old`` the folders it replaced. The file is ``<n>.pending`` until the catalog follows it, then
    ``<n>.done``; its size is bounded by the calendar. ``zones`` is the zone map of the days merged so far.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.location = location.rstrip("/")
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.read_text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString
        self.fs = self.path(self.location).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = self._names(f"{self.location}/{POINTERS}")
        files = sorted((int(n.split(".")[0]), n) for n in names if n.endswith((".pending", ".done")))
        self.number, self.name = files[-1] if files else (0, "")
        state = json.loads(self._read(self.name)) if self.name else {}
        self.days: dict[str, str] = state.get("days", {})
        self.switch: list[str] = state.get("switch", [])
        self.old: list[str] = state.get("old", [])
        self.zones: dict[str, list[int | None]] = state.get("zones", {})

    def _names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def _file(self, name: str):
        return self.path(f"{self.location}/{POINTERS}/{name}")

    def _read(self, name: str) -> str:
        stream = self.fs.open(self._file(name))
        try:
            return self.read_text(stream, "UTF-8")
        finally:
            stream.close()

    @property
    def pending(self) -> bool:
        return self.name.endswith(".pending")

    def place(self, day: str) -> str:
        """The folder of a day that holds rows."""
        data = self.days.get(day)
        return f"{self.location}/{data}/{day}" if data else f"{self.location}/{day}"

    def record(self, days: list[date | None], data: str, zones: dict[str, list[int | None]] | None = None) -> None:
        """The commit of a merge: ``days`` are now what the folder ``data`` holds of them; ``zones`` is the table's zone map."""
        present = set(self._names(f"{self.location}/{data}"))
        switch = [_day_name(d) for d in days]
        old = [self.place(d)[len(self.location) + 1:] for d in switch]
        self.days = self.days | {d: data if d in present else "" for d in switch}
        self.switch, self.old, before = switch, old, self.name
        self.number += 1
        self.zones = zones or {}
        text = json.dumps({"days": self.days, "switch": switch, "old": old, "zones": self.zones})
        draft = self._file(f"{self.number}.draft")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        self._rename(draft, f"{self.number}.pending")
        if before:
            self.fs.delete(self._file(before), False)

    def _rename(self, path, name: str) -> None:
        if not self.fs.rename(path, self._file(name)):
            raise RuntimeError(f"POINTERS_NOT_WRITTEN: {self.location}/{POINTERS}/{name}")
        self.name = name

    def finish(self) -> None:
        """The catalog follows the file: remove what the last merge replaced."""
        for folder in self.old:
            self.fs.delete(self.path(f"{self.location}/{folder}"), True)
        if self.pending:
            self._rename(self._file(self.name), f"{self.number}.done")

    def drop_leftovers(self) -> None:
        """Remove data folders no day lives in: of merges that died before their commit, or wholly replaced."""
        used = set(self.days.values())
        for name in self._names(self.location):
            if name.startswith(DATA_PREFIX) and name not in used:
                self.fs.delete(self.path(f"{self.location}/{name}"), True)


def point_partitions(spark: SparkSession, name: str, pointers: DayPointers, days: list[str]) -> None:
    """Point the catalog's partitions at the recorded folders; running it again changes nothing."""
    for day in days:
        spec = partition_spec(day)
        if pointers.days[day]:
            place = pointers.place(day).replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {spec} LOCATION '{place}'")
            spark.sql(f"ALTER TABLE {name} {spec} SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec}")
    spark.catalog.refreshTable(name)


def roll_forward(spark: SparkSession, name: str, location: str | None = None) -> DayPointers:
    """Finish a merge that was recorded but died before the catalog followed it all the way."""
    pointers = DayPointers(spark, location or table_location(spark, name))
    if pointers.pending:
        point_partitions(spark, name, pointers, pointers.switch)
        pointers.finish()
    return pointers


def merge_into_table(
    spark: SparkSession, name: str, source: DataFrame, key: str = "record_key", source_materialized: bool = False
) -> dict:
    """J1 against a catalog Parquet table partitioned by ``event_date``; returns action counts.

    ``source`` must be unique per key (dedupe first).
    """
    ensure_checkpoint_dir(spark)
    with scratch_scope(spark):
        return _merge_into_table(spark, name, source, key, source_materialized)


def _merge_into_table(spark: SparkSession, name: str, source: DataFrame, key: str, source_materialized: bool) -> dict:
    pointers = roll_forward(spark, name)
    pointers.drop_leftovers()
    target = spark.table(name)
    source = source.select(*target.columns)
    if not source_materialized:
        # Three actions read the source; materialise it so that all see the same rows.
        source = staged(source, "merge-source")
    zoned = RESPONSE_COL in target.columns
    zones = zone_map(spark, name, pointers) if zoned else None
    days = touched_days(target, source, key, zones)
    if not days:
        return {}
    target_days = target.where(_day_filter(days))
    actions = staged(classify_source(target_days, source, key), "merge-actions")
    counts = {r["action"]: r["n"] for r in actions.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    obs = Observation("merge_actions")
    merged = merge_by_action(target_days, source, actions, key).observe(
        obs, F.count_if("from_target").alias("stayed"))
    data = f"{DATA_PREFIX}{uuid.uuid4().hex}"
    write_partitioned(
        clustered_for_write(merged.drop("from_target")),
        f"{pointers.location}/{data}",
        PARTITION_COL,
        mode="overwrite",
        compression="zstd",
        rebalance=False,
    )
    counts["keep"] = int(obs.get.get("stayed", 0)) - counts.get("noop", 0)
    if zoned:
        switched = {_day_name(d) for d in days}
        merged_days = spark.read.schema(target.schema).parquet(f"{pointers.location}/{data}")
        zones = {d: z for d, z in zones.items() if d not in switched} | zones_of(merged_days)
    pointers.record(days, data, zones)
    point_partitions(spark, name, pointers, pointers.switch)
    pointers.finish()
    return {a: n for a, n in counts.items() if n}


def has_committed_days(spark: SparkSession, path: str) -> bool:
    """True once a write has committed at least one ``event_date=`` folder under ``path``
    (a write that died mid-way leaves only the committer's ``_temporary`` folder), or a
    merge its pointers. Lists only the top level (one entry per day)."""
    names = DayPointers(spark, path)._names(path)
    return any(n.startswith(f"{PARTITION_COL}=") or n == POINTERS for n in names)


def register_curated_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """A catalog entry for existing curated data: partition discovery, then every day merges have moved."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({PARTITION_COL}) "
              f"LOCATION '{path}'")
    location = table_location(spark, name)
    pointers = DayPointers(spark, location)
    sync_partitions(spark, name, location)
    point_partitions(spark, name, pointers, list(pointers.days))
    pointers.finish()


def preflight(spark: SparkSession, name: str) -> None:
    """F12 before a load: the table's namespace exists, and a table of that name is one that a load can merge into."""
    namespace = name.rpartition(".")[0]
    if namespace and not namespace_exists(spark, namespace):
        raise RuntimeError(f"NAMESPACE_MISSING: {namespace}")
    if not table_exists(spark, name):
        return
    provider = table_provider(spark, name)
    if provider not in ("parquet", *ROW_LEVEL_MERGE_PROVIDERS):
        raise RuntimeError(f"TABLE_NOT_MERGEABLE: {name} has provider {provider}")
    days = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if provider == "parquet" and days != [PARTITION_COL]:
        raise RuntimeError(f"TABLE_NOT_MERGEABLE: {name} is partitioned by {days}, not by {PARTITION_COL}")


def _plain_place(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri).rstrip("/")


def verify_load(spark: SparkSession, name: str, run_id: str, written: int) -> None:
    """F13 after a load: the table is there with its provider, the catalog follows the pointer file for every day of the load,
    and the table holds the rows that the run says it has written."""
    provider = table_provider(spark, name) if table_exists(spark, name) else "parquet"
    check_table(spark, name, provider if provider in ROW_LEVEL_MERGE_PROVIDERS else "parquet")
    loaded = spark.table(name)
    if provider == "parquet":
        pointers = DayPointers(spark, table_location(spark, name))
        if pointers.pending:
            raise RuntimeError(f"LOAD_NOT_FINISHED: {name} has a merge that the catalog does not follow")
        listed = listed_partitions(spark, name)
        for day in pointers.switch:
            if bool(pointers.days[day]) != (day in listed):
                raise RuntimeError(f"PARTITIONS_DIFFER: {name} {day} is {'not ' if pointers.days[day] else ''}in the catalog")
            if day in listed and _plain_place(partition_location(spark, name, day)) != _plain_place(pointers.place(day)):
                raise RuntimeError(f"PARTITIONS_DIFFER: {name} {day} does not point at {pointers.place(day)}")
        if pointers.switch:
            loaded = loaded.where(_day_filter([_day_of(d) for d in pointers.switch]))
    rows = loaded.where(F.col("processing_run_id") == run_id).count()
    if rows < written:
        raise RuntimeError(f"ROWS_MISSING: {name} holds {rows} rows of run {run_id}, which has written {written}")


def partition_location(spark: SparkSession, name: str, day: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} {partition_spec(day)}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


ROW_LEVEL_MERGE_PROVIDERS = ("iceberg", "delta")


def table_provider(spark: SparkSession, name: str) -> str:
    return _described(spark, name, "Provider").lower()


def merge_into_row_level(source: DataFrame, name: str, key: str = "record_key", hash_col: str = "payload_hash") -> None:
    """J1 where the catalog supports row-level MERGE (table formats): Spark's own
    ``DataFrame.mergeInto`` with the same three rules - matched and hash differs ->
    update all columns, matched and equal -> nothing, not matched -> insert."""
    s, t = source.alias("s"), name
    (
        s.mergeInto(t, F.expr(f"{t}.{key} = s.{key}"))
        .whenMatched(F.expr(f"NOT ({t}.{hash_col} <=> s.{hash_col})"))
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def write_curated(
    spark: SparkSession, df: DataFrame, name: str, path: str | None = None, count: int | None = None
) -> dict:
    """K7: create on the first run (deduped rows only), merge afterwards.

    ``count`` (rows of ``df``, when the caller already knows it) avoids a re-scan.
    """
    if table_exists(spark, name):
        if table_provider(spark, name) in ROW_LEVEL_MERGE_PROVIDERS:
            merge_into_row_level(df, name)
            return {"merged": count if count is not None else df.count()}
        return merge_into_table(spark, name, df, source_materialized=count is not None)
    if path and has_committed_days(spark, path):
        # The catalog entry is gone but the data is not: register the folder again and merge instead of re-creating.
        register_curated_table(spark, name, path, df.schema)
        return merge_into_table(spark, name, df, source_materialized=count is not None)
    if path:
        # Overwrites what a first write that died has left.
        write_partitioned(clustered_for_write(df), path, PARTITION_COL, mode="overwrite", compression="zstd", rebalance=False)
        register_curated_table(spark, name, path, df.schema)
    else:
        create_curated_table(df, name)
    return {"insert": count if count is not None else df.count()}
