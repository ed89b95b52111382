"""ANSI-independent casts for positional string slots.

The jobs must give the same answer with ``spark.sql.ansi.enabled`` on or off.
Plain ``cast`` raises under ANSI for junk text and ``col[i]`` raises for an
out-of-range index, so every slot access goes through ``get`` and every cast
through ``try_cast``. The integer casts go via ``decimal(38,6)`` so that text
such as ``"1784188214.0"`` still yields ``1784188214`` (the lenient,
non-ANSI behaviour the stored data was produced with).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DEC = T.DecimalType(38, 6)


def slot(state: Column | str, index: int) -> Column:
    """Element ``index`` (0-based) of an array, NULL when out of range."""
    col = F.col(state) if isinstance(state, str) else state
    return F.get(col, F.lit(index))


def lenient_long(c: Column) -> Column:
    return c.try_cast(_DEC).try_cast(T.LongType())


def lenient_int(c: Column) -> Column:
    return c.try_cast(_DEC).try_cast(T.IntegerType())


def lenient_double(c: Column) -> Column:
    return c.try_cast(T.DoubleType())


def lenient_bool(c: Column) -> Column:
    return c.try_cast(T.BooleanType())


def parse_int_array(c: Column) -> Column:
    """JSON text such as ``[1, 2, 30]`` -> array<int>; invalid text -> NULL."""
    return F.from_json(c, T.ArrayType(T.IntegerType()))


def strip_whitespace(c: Column) -> Column:
    """Remove leading/trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def cast_slot_sql(state: str, index: int, type_name: str) -> str:
    """SQL text of :func:`cast_slot` (ANSI-independent)."""
    raw = f"get(`{state}`, {int(index)})"
    if type_name == "string":
        return raw
    if type_name == "bigint":
        return f"try_cast(try_cast({raw} as decimal(38,6)) as bigint)"
    if type_name == "int":
        return f"try_cast(try_cast({raw} as decimal(38,6)) as int)"
    if type_name == "double":
        return f"try_cast({raw} as double)"
    if type_name == "boolean":
        return f"try_cast({raw} as boolean)"
    if type_name == "array<int>":
        return f"from_json({raw}, 'array<int>')"
    raise ValueError(f"unsupported slot type {type_name}")


def cast_slot(state: Column | str, index: int, type_name: str) -> Column:
    """Slot ``index`` of ``state`` cast to ``type_name`` without ever raising."""
    if isinstance(state, str):
        return F.expr(cast_slot_sql(state, index, type_name))
    raw = slot(state, index)
    if type_name == "string":
        return raw
    if type_name == "bigint":
        return lenient_long(raw)
    if type_name == "int":
        return lenient_int(raw)
    if type_name == "double":
        return lenient_double(raw)
    if type_name == "boolean":
        return lenient_bool(raw)
    if type_name == "array<int>":
        return parse_int_array(raw)
    raise ValueError(f"unsupported slot type {type_name}")
