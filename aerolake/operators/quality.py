"""documented data-quality rules as one array of violated rule names per row.

Off by default in the jobs (the production validity rule is only the field
count); callers opt in by naming rules, each to flag or to quarantine its rows
(:func:`route`). NULL passes the range rules, as documented.

"Mandatory type conversion fails" needs the raw slot text, which projection
drops: :func:`cast_failure_slots` lists, per raw vector, the typed slots whose
text is present but does not convert; carried as ``cast_failures`` (e.g.
``curate(rows, ..., keep=("cast_failures",))``) it adds the
``TYPE_CONVERSION_FAILED`` rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.functions.casts import cast_slot, slot
from aerolake.schema import STATE_SLOTS

# Rule names and their violation predicates (None-safe: a NULL
# predicate means "not violated").
LAST_CONTACT_TOLERANCE_S = 0
CAST_FAILURES_COL = "cast_failures"
TYPE_CONVERSION_FAILED = "TYPE_CONVERSION_FAILED"


def cast_failure_slots(state: Column) -> Column:
    """Names of the typed slots whose raw text is present but converts to NULL
    (the same ANSI-independent casts as the projection); empty when all convert."""
    checks = [
        F.when(slot(state, index).isNotNull() & cast_slot(state, index, type_name).isNull(), F.lit(name))
        for index, name, type_name in STATE_SLOTS
        if type_name != "string"
    ]
    return F.array_compact(F.array(*checks))


def with_cast_failures(valid: DataFrame, state_col: str = "state") -> DataFrame:
    return valid.withColumn(CAST_FAILURES_COL, cast_failure_slots(F.col(state_col)))


def rule_predicates(tolerance_s: int = LAST_CONTACT_TOLERANCE_S) -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("ICAO24_MISSING", c("icao24").isNull()),
        ("LAST_CONTACT_MISSING", c("last_contact").isNull()),
        ("LATITUDE_OUT_OF_RANGE", ~c("latitude").between(-90, 90)),
        ("LONGITUDE_OUT_OF_RANGE", ~c("longitude").between(-180, 180)),
        ("VELOCITY_NEGATIVE", c("velocity_m_s") < 0),
        ("TRUE_TRACK_OUT_OF_RANGE", ~c("true_track_degrees").between(0, 360)),
        ("LAST_CONTACT_AFTER_RESPONSE", c("last_contact") > c("source_response_time") + F.lit(tolerance_s)),
        ("EVENT_TIME_MISSING", c("event_timestamp_epoch").isNull()),
    ]


def _rules_for(df: DataFrame, tolerance_s: int) -> list[tuple[str, Column]]:
    rules = rule_predicates(tolerance_s)
    if CAST_FAILURES_COL in df.columns:
        rules.append((TYPE_CONVERSION_FAILED, F.size(F.col(CAST_FAILURES_COL)) > 0))
    return rules


def with_violations(df: DataFrame, tolerance_s: int = LAST_CONTACT_TOLERANCE_S) -> DataFrame:
    flags = [F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in _rules_for(df, tolerance_s)]
    return df.withColumn("violations", F.array_compact(F.array(*flags)))


FLAG, QUARANTINE = "flag", "quarantine"
QUARANTINE_REASON = "DQ_"


def check_actions(actions: dict[str, str]) -> None:
    known = {name for name, _ in rule_predicates()} | {TYPE_CONVERSION_FAILED}
    odd = {r: a for r, a in actions.items() if r not in known or a not in (FLAG, QUARANTINE)}
    if odd:
        raise ValueError(f"DQ_ACTIONS: {odd} are no rules with the action {FLAG} or {QUARANTINE}")


def route(df: DataFrame, actions: dict[str, str], tolerance_s: int = LAST_CONTACT_TOLERANCE_S) -> DataFrame:
    """Rows with the violated rules that flag them (``flags``) and the ones that quarantine them (``quarantined_by``); rules
    without an action are not looked at."""
    check_actions(actions)

    def violated(action: str) -> Column:
        named = [F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in _rules_for(df, tolerance_s) if actions.get(name) == action]
        return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")

    return df.withColumns({"flags": violated(FLAG), "quarantined_by": violated(QUARANTINE)})


def violation_summary(df: DataFrame, tolerance_s: int = LAST_CONTACT_TOLERANCE_S) -> DataFrame:
    """Rows violating each rule (rules with no violation are listed with 0)."""
    rules = _rules_for(df, tolerance_s)
    counts = [F.count_if(F.coalesce(p, F.lit(False))).alias(name) for name, p in rules]
    agg = df.agg(*counts)
    names = [name for name, _ in rules]
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return agg.selectExpr(f"stack({len(names)}, {stack}) as (rule, n)")
