"""Plan inspection: what Catalyst chose, as text, plus the checks the tests assert.

Uses only ``DataFrame.explain`` output (no internal APIs): pruning shows up as
``PartitionFilters`` / ``ReadSchema`` on the scan, shuffles as ``Exchange``,
Python UDFs as ``BatchEvalPython`` / ``ArrowEvalPython``.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

_PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def exchanges(df: DataFrame) -> list[str]:
    """Shuffle exchanges in the physical plan (before adaptive re-planning)."""
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)[^\n]*",
                      plan_text(df, "simple"))


def python_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "simple")
    return [n for n in _PY_NODES if n in text]


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_text(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df))


def assert_pruned(df: DataFrame, partition_col: str, read_columns: set[str] | None = None) -> None:
    """The scan filters partitions on ``partition_col`` and reads only ``read_columns``."""
    pf = partition_filters(df)
    if not any(partition_col in f for f in pf):
        raise AssertionError(f"no partition filter on {partition_col}: {pf}")
    if read_columns is not None:
        for schema in read_schemas(df):
            names = set(re.findall(r"(\w+):", schema))
            if not names <= read_columns:
                raise AssertionError(f"scan reads {names - read_columns} beyond {read_columns}")


def assert_no_python(df: DataFrame) -> None:
    found = python_nodes(df)
    if found:
        raise AssertionError(f"Python evaluation in plan: {found}")
