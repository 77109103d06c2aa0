"""What the core tests share; a module of its own, as `conftest` is the name of every folder's fixtures."""

from __future__ import annotations

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def points_df(spark, rows):
    """rows: (id, [coords], grp)."""
    return spark.createDataFrame(
        [(i, [float(x) for x in f], g) for i, f, g in rows], "id BIGINT, features ARRAY<DOUBLE>, grp STRING"
    )
