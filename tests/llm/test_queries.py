"""The registered queries: names, columns and, where SQL can say it, the DuckDB oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from spindle.llm import queries


def test_registered():
    found = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert [int(n[2:].split("_")[0]) for n in found if n != "pipeline"] == list(range(1, 14)) and "pipeline" in found
    assert set(queries.sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.sql()))
def test_oracle(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.OPERATORS[name](spark, sf)
    columns = sorted(got.columns)
    want = con.sql(queries.sql()[name])
    assert sorted(want.columns) == columns
    rows = sorted(tuple(r) for r in got.select(*columns).collect())
    assert rows == sorted(con.sql(f"SELECT {', '.join(columns)} FROM want").fetchall())
