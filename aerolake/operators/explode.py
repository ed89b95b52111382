"""Explode response documents into one row per state vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.schema import EXPECTED_STATE_FIELDS


def parse_state_elements(raw: DataFrame, states_col: str = "states") -> DataFrame:
    """Turn the raw ``states`` value into array<array<string>>.

    ``states`` is the VARIANT of :func:`aerolake.sources.raw_json.read_raw`, or JSON text of the whole array.
    Anything that is not a JSON array gives a NULL ``states``; a string, number or
    object element becomes a NULL vector (and only that element); a good
    element keeps its values as text. The elements are kept as they are in
    ``states_raw`` for the explode and the rejection audit.
    """
    col = F.col(states_col)
    if isinstance(raw.schema[states_col].dataType, T.StringType):
        col = F.try_parse_json(col)
    return raw.withColumn("states_raw", F.try_variant_get(col, "$", "array<variant>")).withColumn(
        states_col, F.transform(F.col("states_raw"), element_values)
    )


def element_values(element: Column) -> Column:
    """The values of one element as text; NULL unless it is an array."""
    return F.try_variant_get(element, "$", "array<string>")


def explode_states(
    payloads: DataFrame,
    time_col: str = "time",
    states_col: str = "states",
    source_file_col: str | None = "source_file",
    base_position_col: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per element of ``states``, outer: a NULL or empty array still
    yields one row with NULL ``state_position`` and NULL ``state``.

    Output: ``source_response_time, source_file, state_position, state`` plus
    ``state_raw`` (the JSON text of an element that is no vector of 17 fields) when the input came from
    :func:`parse_state_elements` and any ``keep`` columns. ``base_position_col`` offsets positions of chunked documents.
    """
    has_raw = "states_raw" in payloads.columns
    if has_raw:
        items = F.col("states_raw")
    else:
        items = F.col(states_col)
    cols = [F.col(time_col).cast("long").alias("source_response_time")]
    if source_file_col is not None:
        cols.append(F.col(source_file_col).alias("source_file"))
    if base_position_col is not None:
        cols.append(F.col(base_position_col).alias("_base"))
    cols += [F.col(c) for c in (keep or [])]
    exploded = payloads.select(*cols, F.posexplode_outer(items).alias("_pos", "_item"))
    pos = F.col("_pos")
    if base_position_col is not None:
        pos = F.when(pos.isNotNull(), pos + F.col("_base"))
    out = [c for c in exploded.columns if c not in ("_pos", "_item", "_base")]
    rows = exploded.select(*out, pos.cast("int").alias("state_position"), "_item")
    if not has_raw:
        return rows.withColumnRenamed("_item", "state")
    vectors = rows.withColumn("state", element_values(F.col("_item")))
    odd = F.col("state").isNull() | (F.size("state") != EXPECTED_STATE_FIELDS)
    return vectors.withColumn("state_raw", F.when(odd, F.to_json("_item"))).drop("_item")
