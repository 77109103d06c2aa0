"""Registered queries against their DuckDB oracle.

The default run checks every key at sf0.001; set SPINDLE_ORACLE_SF=/root/testdata/sf0.01 for the driver's scale.
"""

from __future__ import annotations

import os

import pytest
from support import SF001

from spindle.plans.catalog import registry
from spindle.plans.verify import compare, duckdb_con

SF = os.environ.get("SPINDLE_ORACLE_SF", SF001)
NAMES = sorted(registry())


@pytest.fixture(scope="module")
def con():
    return duckdb_con(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["status"] in ("match", "rows-only"), r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["n", "n_a", "n_b", "phi_standard", "phi_fair"]
    assert df.count() == 1
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
