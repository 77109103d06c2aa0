"""Seeded universal hash family h(x) = ((a*x + b) mod P) mod C for the frequency sketches.

The family is a parameter table of D rows (D is a user parameter), drawn on the driver from a seed so that runs
are repeatable.  Hashes are evaluated as JVM column expressions; ``x`` is first reduced modulo P so the product
never overflows 64 bits, which gives the textbook value for every non-negative item and a valid cell for
negative ones.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the default prime modulus of the hash family.
DEFAULT_PRIME = 8191


@dataclass(frozen=True)
class HashRow:
    row: int
    a_cm: int
    b_cm: int
    a_cs: int
    b_cs: int
    a_sg: int
    b_sg: int


@dataclass(frozen=True)
class HashFamily:
    rows: tuple[HashRow, ...]
    width: int
    prime: int = DEFAULT_PRIME

    @property
    def depth(self) -> int:
        return len(self.rows)

    def to_df(self, spark: SparkSession) -> DataFrame:
        schema = "row INT, a_cm BIGINT, b_cm BIGINT, a_cs BIGINT, b_cs BIGINT, a_sg BIGINT, b_sg BIGINT"
        return spark.createDataFrame([tuple(r.__dict__.values()) for r in self.rows], schema)


def hash_family(depth: int, width: int, seed: int = 48, prime: int = DEFAULT_PRIME) -> HashFamily:
    """D independent triples of hash functions: Count-Min column, Count-Sketch column, Count-Sketch sign."""
    if depth <= 0 or width <= 0:
        raise ValueError("depth and width must be positive")
    rng = random.Random(seed)
    rows = []
    for i in range(depth):
        vals = []
        for _ in range(3):
            vals.append(rng.randint(1, prime - 1))
            vals.append(rng.randint(0, prime - 1))
        rows.append(HashRow(i, *vals))
    return HashFamily(tuple(rows), width, prime)


def hash_col(x: Column, a: int, b: int, c: int, prime: int = DEFAULT_PRIME) -> Column:
    """((a*x + b) mod P) mod c as a BIGINT column expression."""
    reduced = F.pmod(x, F.lit(prime).cast("bigint"))
    return F.pmod(F.lit(a).cast("bigint") * reduced + F.lit(b).cast("bigint"), F.lit(prime).cast("bigint")) % F.lit(
        c
    ).cast("bigint")


def sign_col(x: Column, a: int, b: int, prime: int = DEFAULT_PRIME) -> Column:
    """Count-Sketch sign: -1 when the 2-way hash is 0, else +1."""
    return F.when(hash_col(x, a, b, 2, prime) == 0, F.lit(-1)).otherwise(F.lit(1)).cast("bigint")
