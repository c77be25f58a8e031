"""Every registered query against its DuckDB statement (sf0.001)."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from claimwright.queries import QUERIES  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_of_the_library_has_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    s_multi, s_cols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(entry.oracle_sql()[key])
    d_multi, d_cols = rows_of([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert sum(s_multi.values()) == sum(d_multi.values())
    assert s_multi == d_multi


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "avg_fraud_score" in df.columns
