"""Two-group Gaussian-mixture point generator, as a distributed Spark job.

floor(a_share * n) A-points are N(0, sigma^2) per axis; the remaining B-points pick a component c uniformly in
0..k-1 centred at (spacing * c, 0) with the same sigma.  Coordinates are rounded to 5 decimals.  Values depend
on the seed and on ``num_partitions`` (Spark's random columns are seeded per partition), so both are fixed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.sources.points import GROUP_A, GROUP_B


def synthetic_points(
    spark: SparkSession,
    n: int,
    k: int,
    seed: int = 48,
    a_share: float = 0.75,
    spacing: float = 10.0,
    sigma: float = 6.0,
    num_partitions: int = 8,
) -> DataFrame:
    if n <= 0 or k <= 0:
        raise ValueError("n and k must be positive")
    n_a = int(math.floor(n * a_share))
    is_a = F.col("id") < F.lit(n_a)
    comp = F.floor(F.rand(seed + 2) * F.lit(k))
    cx = F.when(is_a, F.lit(0.0)).otherwise(comp * F.lit(spacing))
    x = F.round(cx + F.lit(sigma) * F.randn(seed), 5)
    y = F.round(F.lit(sigma) * F.randn(seed + 1), 5)
    return spark.range(0, n, 1, num_partitions).select(
        F.col("id"),
        F.array(x, y).alias("features"),
        F.when(is_a, F.lit(GROUP_A)).otherwise(F.lit(GROUP_B)).alias("grp"),
    )
