"""File listing and landing validation, as frames.

* Spark file scans drop zero-byte files, which would hide an empty latest object. The streaming
  file source logs every file it finds, empty or not, with its modification time; one
  micro-batch that reads nothing leaves that log, and the log is read as a table. What the log has and the
  ``binaryFile`` scan has not is a zero-byte file: a join, with no list of paths in Python.
* Validation classifies *every* landed file in parallel (one failure code per
  file); "latest object" is a top-1 over the listing.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.session import scratch_path

# Landing failure codes, in check order.
CODE_OK = "OK"
CODE_EMPTY = "EMPTY_OBJECT"
CODE_INVALID_UTF8 = "INVALID_UTF8"
CODE_INVALID_JSON = "INVALID_JSON"
CODE_STATES_NOT_LIST = "STATES_NOT_LIST"
CODE_NO_STATES = "NO_STATES"
# Errors of the landing check.
CODE_NOTHING_LANDED = "NOTHING_LANDED"
CODE_NOT_ADMITTED = "LATEST_NOT_ADMITTED"

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("modification_time", T.LongType(), False),
    ]
)


def _binary_scan(spark: SparkSession, path: str, modified_after: datetime | None = None) -> DataFrame:
    """Recursive ``binaryFile`` scan. ``modified_after`` filters files by modification
    time while listing (the ``modifiedAfter`` file-source option), so older files are
    never opened - an incremental check reads only what landed since the last run."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", _session_local_text(spark, modified_after))
    return reader.load(path)


def _session_local_text(spark: SparkSession, ts: datetime) -> str:
    """``modifiedAfter`` takes wall-clock text in the session time zone."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))).replace(tzinfo=None)
    return ts.strftime("%Y-%m-%dT%H:%M:%S")


def _file_log(spark: SparkSession, path: str) -> DataFrame | None:
    """``(uri, modification_time ms)`` of every file below ``path``; None without one. Bodies are not read."""
    log = scratch_path(spark, "file-log")
    found = (
        spark.readStream.schema(BINARY_FILE_SCHEMA)
        .format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")
        .load(path)
    )
    query = (
        found.writeStream.foreachBatch(lambda batch, number: None)
        .option("checkpointLocation", log)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, f"{log}/sources/0"):
        return None
    return logged_files(spark, f"{log}/sources/0").drop("batch_id")


def logged_files(spark: SparkSession, log: str) -> DataFrame:
    """``(uri, modification_time ms, batch_id)`` of the files in a log of the streaming file source."""
    entry = F.from_json("value", "path string, timestamp long, batchId long")
    return (
        spark.read.text(log)
        .where(F.col("value").startswith("{"))
        .select(entry.alias("e"))
        .select(F.col("e.path").alias("uri"), F.col("e.timestamp").alias("modification_time"), F.col("e.batchId").alias("batch_id"))
    )


def same_uri(uri: Column) -> Column:
    """One spelling of a URI without authority: ``file:///a`` and ``file:/a``."""
    return F.regexp_replace(uri, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _plain_path(uri: Column) -> Column:
    return F.url_decode(F.replace(same_uri(uri), F.lit("+"), F.lit("%2B")))


def _scanned(spark: SparkSession, path: str, columns: dict[str, Column], modified_after: datetime | None) -> DataFrame:
    """Every file below ``path`` with ``columns`` of its scan (NULL for a zero-byte file)."""
    log = _file_log(spark, path) if path_exists(spark, path) else None
    if log is None:
        empty = spark.createDataFrame([], "path string, modification_time long")
        return empty.select("path", "modification_time", *[F.lit(None).alias(n) for n in columns])
    if modified_after is not None:
        log = log.where(F.col("modification_time") > int(modified_after.timestamp() * 1000))
    scan = _binary_scan(spark, path, modified_after).select(same_uri(F.col("_metadata.file_path")).alias("key"), "path", *[c.alias(n) for n, c in columns.items()])
    seen = log.withColumn("key", same_uri(F.col("uri"))).join(scan, "key", "left")
    return seen.select(F.coalesce("path", _plain_path(F.col("uri"))).alias("path"), "modification_time", *columns)


def list_files(spark: SparkSession, path: str, modified_after: datetime | None = None) -> DataFrame:
    """Recursive listing ``(path, length, modification_time ms)`` including zero-byte files; no body is read."""
    found = _scanned(spark, path, {"length": F.col("length")}, modified_after)
    return found.select("path", F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"), "modification_time")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def landing_code(length: Column, content: Column) -> Column:
    """Ordered checks: size > 0, UTF-8, JSON, ``states`` is a list, non-empty."""
    text = content.cast("string")
    doc = F.try_parse_json(text)
    states = F.try_variant_get(doc, "$.states", "variant")
    is_list = F.coalesce(F.schema_of_variant(states).startswith("ARRAY"), F.lit(False))
    n_states = F.size(F.try_variant_get(doc, "$.states", "array<variant>"))
    return (
        F.when((length <= 0) | content.isNull(), F.lit(CODE_EMPTY))
        .when(~F.is_valid_utf8(text), F.lit(CODE_INVALID_UTF8))
        .when(doc.isNull(), F.lit(CODE_INVALID_JSON))
        .when(~is_list, F.lit(CODE_STATES_NOT_LIST))
        .when(F.coalesce(n_states, F.lit(0)) == 0, F.lit(CODE_NO_STATES))
        .otherwise(F.lit(CODE_OK))
    )


def classify_landed(
    spark: SparkSession, path: str, listing: DataFrame | None = None, modified_after: datetime | None = None
) -> DataFrame:
    """S6 for every file below ``path`` (or only the files in ``listing``, or only
    files modified after ``modified_after``): ``path, length, modification_time, code``.

    File bodies are read and checked by the executors (``binaryFile``), never
    by the driver; zero-byte files, which the scan skips, are reported as
    ``EMPTY_OBJECT``.
    """
    code = landing_code(F.col("length"), F.col("content"))
    if listing is None:
        found = _scanned(spark, path, {"length": F.col("length"), "code": code}, modified_after)
    else:
        checked = _binary_scan(spark, path, modified_after).select("path", code.alias("code"))
        found = listing.select("path", "length", "modification_time").join(checked, "path", "left")
    return found.select(
        "path",
        F.coalesce(F.col("length").cast("long"), F.lit(0)).alias("length"),
        "modification_time",
        F.coalesce(F.col("code").cast("string"), F.lit(CODE_EMPTY)).alias("code"),
    )


def latest_object(listing: DataFrame) -> DataFrame:
    """Newest modification time; ties go to the first path in listing order."""
    return listing.orderBy(F.col("modification_time").desc(), F.col("path").asc()).limit(1)


def validate_latest(spark: SparkSession, path: str, modified_after: datetime | None = None) -> str:
    """Return the URI of the latest landed object, or raise with its failure code.

    Only the latest object's bytes are read; ``modified_after`` (e.g. the previous
    run's start) keeps the listing to recently landed files.
    """
    latest = latest_object(list_files(spark, path, modified_after)).first()
    if latest is None:
        raise RuntimeError(f"{CODE_NOTHING_LANDED}: {path}")
    if latest["length"] <= 0:
        raise RuntimeError(f"{CODE_NOT_ADMITTED} ({CODE_EMPTY}): {latest['path']}")
    one = spark.createDataFrame([latest], LISTING_SCHEMA)
    row = classify_landed(spark, latest["path"], one).first()
    if row["code"] != CODE_OK:
        raise RuntimeError(f"{CODE_NOT_ADMITTED} ({row['code']}): {row['path']}")
    return row["path"]


def payload_json(time_col: str = "time", states_col: str = "states") -> Column:
    """Serialize a payload row back to the response document text."""
    return F.to_json(F.struct(F.col(time_col).alias("time"), F.col(states_col).alias("states")))
