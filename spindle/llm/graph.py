"""Connected components of a link table by alternating large-star and small-star steps (a published method)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's larger (small step: smaller or equal) neighbours are linked to its least neighbour or itself."""
    if small:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = near.join(least, "u")
    if small:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    else:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)``; the root is the least node of its component.

    Rounds until nothing changes; every round is written to the shared folder, so a lost executor costs one round.
    Aggregations combine before their shuffle and the joins may be split, so a node with very many links is no burden
    for one task.  Without edges there are no rows.
    """
    key = F.xxhash64("u", "v")
    mark = [F.count(F.lit(1)), F.coalesce(F.bit_xor(key), F.lit(0)), F.coalesce(F.sum(F.pmod(key, F.lit(2**31))), F.lit(0))]
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = edges.agg(*mark).first()
    while seen[0]:
        edges = stored(_star(_star(edges, small=False), small=True), "cc")
        now = edges.agg(*mark).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
