"""Landing-layout formatting of UTC instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import RAW_PREFIX


def landing_partitions(ts: Column) -> dict[str, Column]:
    """Zero-padded ``year/month/day/hour`` strings of a timestamp (session TZ = UTC)."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def landing_key(ts: Column, prefix: str = RAW_PREFIX) -> Column:
    """Object key ``<prefix>/year=YYYY/month=MM/day=DD/hour=HH/YYYYMMDDTHHMMSSZ.json``."""
    p = landing_partitions(ts)
    return F.concat(
        F.lit(f"{prefix}/year="),
        p["year"],
        F.lit("/month="),
        p["month"],
        F.lit("/day="),
        p["day"],
        F.lit("/hour="),
        p["hour"],
        F.lit("/"),
        F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"),
        F.lit(".json"),
    )
