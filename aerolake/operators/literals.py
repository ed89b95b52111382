"""Run-level literal columns (P4): run id and a timezone-safe run timestamp."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def new_run() -> tuple[str, datetime]:
    """A fresh run id and a UTC-aware run timestamp, fixed for the whole job."""
    return str(uuid.uuid4()), datetime.now(timezone.utc)


def run_timestamp_literal(run_ts: datetime) -> Column:
    """TIMESTAMP literal of ``run_ts``.

    A naive datetime is read as UTC (not as the Python process time zone), so
    the stored instant does not depend on where the driver runs.
    """
    return F.timestamp_micros(F.lit(to_micros(run_ts)))


def to_micros(run_ts: datetime) -> int:
    """Microseconds since the epoch; a naive datetime is taken as UTC."""
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=timezone.utc)
    return (run_ts - _EPOCH) // timedelta(microseconds=1)
