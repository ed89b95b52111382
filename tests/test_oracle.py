"""Every registered query against its DuckDB oracle (row count, columns, value hash)."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry
from aerolake.plans.queries import QUERIES
from support import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import duck, table_digest  # noqa: E402

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) >= 1
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert table_digest(df.columns, rows) == table_digest(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origin_country", "n"]
    assert df.count() >= 0
