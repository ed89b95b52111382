"""Map the supplied ``events`` table onto OpenSky-style state vectors.

One event becomes one 17-slot string vector; the events of one UTC hour form
the response payloads of that hour (``time`` = end of the hour, + k seconds for
the k-th response when an hour holds more than ``MAX_STATES_PER_PAYLOAD``
vectors), so no payload (and no task) grows with the table. A few vectors are deliberately malformed by fixed id rules so the
validation paths see NULL, short and long vectors.

The slot expressions are SQL text; the same text runs in Spark and in the
DuckDB oracle (see ``aerolake.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.operators.ranking import rank_within

# ---------------------------------------------------------------------------
# Events -> state-vector mapping (slot 0..16), malformation rules
# ---------------------------------------------------------------------------

SLOT_SQL: list[str] = [
    "lpad(cast(user_id as string), 6, '0')",
    "case when event_id % 7 = 0 then null else concat(event_type, '  ') end",
    "concat('C', cast(user_id % 25 as string))",
    "case when event_id % 5 = 0 then null else cast(ep as string) end",
    "case when event_id % 11 = 0 then null else cast(ep + 1 as string) end",
    "cast(cast((event_id * 37) % 36000 as double) / 100 - 180 as string)",
    "cast(cast((event_id * 53) % 20000 as double) / 100 - 100 as string)",
    "case when event_id % 13 = 0 then null else cast(value * 10 as string) end",
    "case when event_id % 9 = 0 then 'true' else 'false' end",
    "cast(value as string)",
    "cast(cast((event_id * 7) % 400 as double) as string)",
    "cast(cast(event_id % 41 as double) / 2 - 10 as string)",
    "case when event_id % 4 = 0 then '[1, 2, 30]' else null end",
    "cast(value * 10 + 25 as string)",
    "lpad(cast(event_id % 7777 as string), 4, '0')",
    "'false'",
    "cast(event_id % 4 as string)",
]
NULL_VECTOR_MOD = 97
SHORT_VECTOR_MOD = 89
LONG_VECTOR_MOD = 83
EXTRA_SLOT_VALUE = "x"

# Upper bound of vectors per landed payload document (an API response holds ~14k).
MAX_STATES_PER_PAYLOAD = 16384

EVENTS_BASE_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_with_epoch(events: DataFrame, value: F.Column | None = None) -> DataFrame:
    """Project the columns the mapping needs and add whole epoch seconds ``ep``.

    ``value`` optionally replaces the ``value`` column (used to derive an
    edited re-delivery of the same vectors).
    """
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        (F.col("value") if value is None else value).alias("value"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ep"),
    ).withColumn("hour_bucket", F.expr("ep div 3600"))


def state_array_expr() -> F.Column:
    full = F.array(*[F.expr(s) for s in SLOT_SQL])
    eid = F.col("event_id")
    return (
        F.when(eid % NULL_VECTOR_MOD == 0, F.lit(None).cast("array<string>"))
        .when(eid % SHORT_VECTOR_MOD == 0, F.slice(full, 1, 16))
        .when(eid % LONG_VECTOR_MOD == 0, F.concat(full, F.array(F.lit(EXTRA_SLOT_VALUE))))
        .otherwise(full)
    )


def event_vectors(events: DataFrame, value: F.Column | None = None, by_response: bool = False) -> DataFrame:
    """events -> (event_id, source_response_time, state_position, state).

    The events of one UTC hour, ranked by ``event_id`` (skew-safe rank), form
    the responses of that hour: response ``k`` (time = end of the hour + ``k``
    seconds) holds ranks ``k * MAX_STATES_PER_PAYLOAD`` onwards, and
    ``state_position`` is the position inside that response - exactly what
    exploding the landed document gives back. An hour needs a second response
    only beyond ``MAX_STATES_PER_PAYLOAD`` events; more responses than fit in the next hour raise instead of mixing two hours.

    ``by_response`` deals the events to tasks by response before their vectors are made, an eighth of the width:
    :func:`build_payloads` then gathers documents where the vectors lie. A response has a bounded number of them.
    """
    base = events_with_epoch(events, value)
    per_doc = int(MAX_STATES_PER_PAYLOAD)
    ranked = rank_within(base, "hour_bucket", "event_id", "_rn", most=3600 * per_doc)
    placed = ranked.withColumns({
        "source_response_time": (F.col("hour_bucket") + 1) * 3600 + F.expr(f"_rn div {per_doc}"),
        "state_position": F.expr(f"_rn % {per_doc}").cast("int"),
    })
    if by_response:
        parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.repartition(parts, "source_response_time")
    return placed.select("event_id", "source_response_time", "state_position", state_array_expr().alias("state"))


def build_payloads(
    vectors: DataFrame,
    source_prefix: str = "events/payload",
    max_states: int = MAX_STATES_PER_PAYLOAD,
) -> DataFrame:
    """Group vectors into response documents ``(time, base_position, states, source_file)``.

    A document holds at most ``max_states`` vectors, so ``collect_list`` never
    gathers an unbounded group; within an hour the chunks keep the global
    position order (``base_position`` is the position of the first element).
    """
    chunk = F.expr(f"state_position div {int(max_states)}")
    grouped = vectors.groupBy(F.col("source_response_time"), chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("state_position", "state"))).alias("items")
    )
    return grouped.select(
        F.col("source_response_time").alias("time"),
        (F.col("chunk") * max_states).cast("int").alias("base_position"),
        F.transform("items", lambda x: x["state"]).alias("states"),
        F.concat(
            F.lit(f"{source_prefix}/"),
            F.col("source_response_time").cast("string"),
            F.lit("-"),
            F.col("chunk").cast("string"),
            F.lit(".json"),
        ).alias("source_file"),
    )


def event_payloads(
    events: DataFrame, value: F.Column | None = None, source_prefix: str = "events/payload"
) -> DataFrame:
    return build_payloads(event_vectors(events, value, by_response=True), source_prefix)


def payload_source_file(source_prefix: str = "events/payload", max_states: int = MAX_STATES_PER_PAYLOAD) -> F.Column:
    """The ``source_file`` a vector gets from :func:`build_payloads` (for vector-level inputs)."""
    return F.concat(
        F.lit(f"{source_prefix}/"),
        F.col("source_response_time").cast("string"),
        F.lit("-"),
        F.expr(f"state_position div {int(max_states)}").cast("string"),
        F.lit(".json"),
    )


def vectors_as_exploded(vectors: DataFrame, source_prefix: str = "events/payload") -> DataFrame:
    """Vectors in the exploded-row shape (what exploding their payloads yields)."""
    return vectors.select(
        "source_response_time",
        payload_source_file(source_prefix).alias("source_file"),
        "state_position",
        "state",
        "event_id",
    )
