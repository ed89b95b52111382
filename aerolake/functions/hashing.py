"""Digest helpers: SHA-256 over a NULL-safe, separator-joined text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake.schema import HASH_SEPARATOR, NULL_TOKEN


def null_safe_text(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(NULL_TOKEN))


def sha256_concat_sql(columns: list[str]) -> str:
    parts = ", ".join(f"coalesce(cast(`{c}` as string), '{NULL_TOKEN}')" for c in columns)
    return f"sha2(concat_ws('{HASH_SEPARATOR}', {parts}), 256)"


def sha256_concat(columns: list[str]) -> Column:
    """Lower-hex SHA-256 of ``col1||col2||...`` with NULL rendered as ``NULL``.

    Built as one SQL expression (a single round trip to the JVM instead of
    four per column).
    """
    return F.expr(sha256_concat_sql(columns))
