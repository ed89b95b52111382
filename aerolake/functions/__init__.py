"""Column-expression helpers (built-in Spark expressions only, no UDFs)."""

from aerolake.functions.casts import (
    lenient_bool,
    lenient_double,
    lenient_int,
    lenient_long,
    parse_int_array,
    slot,
    strip_whitespace,
)
from aerolake.functions.hashing import null_safe_text, sha256_concat
from aerolake.functions.timefmt import landing_key, landing_partitions

__all__ = [
    "lenient_bool",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "parse_int_array",
    "slot",
    "strip_whitespace",
    "null_safe_text",
    "sha256_concat",
    "landing_key",
    "landing_partitions",
]
