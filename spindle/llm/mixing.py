"""Mixing sources to target weights by systematic sampling.

Every source gets a target (see :func:`source_targets`).  A document of a source is expected ``e = target / size of the
source`` times.  The documents of a source are put in an order, expected copies are summed up along it, one random
offset ``u`` per source (a hash of the source's name) is added, and a document is emitted once per integer that its
stretch of the sum crosses: ``floor(e)`` copies, and one more for every boundary that the fractions' sum crosses.  The
order is by size, so what is left out at one place is as long as what is taken at the next, and the words taken come
within about one document of the target.

The running count is exact and needs no task that sees a whole source: rows are dealt into cells (source, size, step of
a hash of doc_id), a cell holds at most about the square root of all rows, cells get offsets from their totals and rows
their number inside the cell.

Edge cases: a null text has size 0; a null source is a source of its own and comes last; a null doc_id is a value; rows
equal in doc_id, source, size and text are counted with a multiplicity; an empty table gives no rows; a source without
words has target 0 and nothing is taken from it; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.llm.common import pick, sheltered, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_COPIES = 2.0
LEAST_CELL = 64
BROADCAST_SOURCES = 100_000  # rows of the source table that are broadcast at most; beyond, a shuffled join
SEED = "mix"
TWO32 = float(2**32)


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share=TOTAL_SHARE, most=MOST_COPIES) -> DataFrame:
    """``source, source_size, target, e`` from ``source, source_size``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``total_share`` of all sizes.  No
    target exceeds ``most`` times its source's size; the excess is shared again by weight until none does.  That
    fixed point is ``min(most * size, level * weight)`` with one level for all.  Going through the sources in the order
    in which a rising level fills them, ``v`` is the level if exactly the sources before were full; it rises as long as
    the next source is full too and falls afterwards, so the level is the largest ``v``.
    """
    w = "CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {n} {cases} END".format(
        n=len(weights), cases=" ".join(f"WHEN {i} THEN {float(x)}D" for i, x in enumerate(weights))
    )
    fill = "ORDER BY {most}D * source_size / w, source NULLS LAST ROWS BETWEEN".format(most=most)
    return (
        sizes.selectExpr("source", "source_size", f"{w} AS w")
        .selectExpr(
            "*",
            f"({total_share}D * sum(source_size) OVER () - {most}D * coalesce(sum(source_size) OVER ({fill} "
            f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0D)) / sum(w) OVER ({fill} CURRENT ROW AND UNBOUNDED FOLLOWING) AS v",
        )
        .selectExpr("*", "max(v) OVER () AS level")
        .selectExpr("source", "source_size", f"least({most}D * source_size, coalesce(level, 0D) * w) AS target")
        .selectExpr("*", "CASE WHEN source_size > 0 THEN target / source_size ELSE 0D END AS e")
    )


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, th, n``: word counts, the text's digest, and how many equal rows there are."""
    return (
        pick(docs, "doc_id", "text", "source")
        .select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.md5(F.coalesce("text", F.lit(""))).alias("th"),
        )
        .groupBy("doc_id", "source", "size", "th")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def hex32(col) -> F.Column:
    """The first 32 bits of an md5 of ``col`` as a number."""
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")


def copies_of(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, th, n, source_size, target, e, u, at``: ``at`` rows of the source come before."""
    rows = stored(sized(docs), "mix-rows")
    n_rows, n_sources = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_distinct(F.struct("source"))).first()
    cell = max(LEAST_CELL, int(n_rows**0.5))
    sources = source_targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    name = F.coalesce(F.col("source"), F.lit("\0"))
    sources = stored(sources.withColumn("u", hex32(F.concat(F.lit(SEED), name)) / F.lit(TWO32)), "mix-sources")
    if n_sources <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    # How many steps a (source, size) is divided into; only divided ones are listed, each has over sqrt(rows) rows,
    # so there are fewer than sqrt(rows) of them.
    over = rows.groupBy("source", "size").agg(F.ceil(F.sum("n") / cell).alias("steps")).where("steps > 1")
    over = F.broadcast(over.select(F.col("source").alias("os"), F.col("size").alias("oz"), "steps"))
    dealt = rows.withColumn("h", hex32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    dealt = dealt.join(over, F.col("source").eqNullSafe(F.col("os")) & (F.col("size") == F.col("oz")), "left")
    dealt = dealt.withColumn("step", F.floor(F.col("h") * F.coalesce("steps", F.lit(1)) / F.lit(TWO32)))
    dealt = dealt.drop("os", "oz", "steps")
    along = Window.partitionBy("source").orderBy("size", "step").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("source", "size", "step")
        .agg(F.sum("n").alias("rows"))
        .select(
            F.col("source").alias("cs"),
            F.col("size").alias("cz"),
            F.col("step").alias("cstep"),
            F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("before"),
        )
    )
    inside = Window.partitionBy("source", "size", "step").orderBy("h", "doc_id", "th")
    numbered = dealt.withColumn(
        "inside", F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    here = F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz")) & (F.col("step") == F.col("cstep"))
    numbered = numbered.join(offsets, here).withColumn("at", F.col("before") + F.col("inside"))
    sources = sources.withColumnRenamed("source", "ss")
    return numbered.join(sources, F.col("source").eqNullSafe(F.col("ss"))).select(
        "doc_id", "source", "size", "th", "n", "source_size", "target", "e", "u", "at"
    )


#: Copies of the row number ``at + i`` (from 0) of a source.
COPIES = "floor(e) + floor((at + i + 1) * (e - floor(e)) + u) - floor((at + i) * (e - floor(e)) + u)"


def mix_plan(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every row of ``docs``."""
    each = copies_of(docs).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    each = each.withColumn("copies", F.expr(COPIES).cast("bigint"))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0, 1 or 2 times)."""
    docs, names = sheltered(docs, "doc_id", "text", "source")
    plan = copies_of(docs).select(
        F.col("doc_id").alias("p_id"), F.col("source").alias("p_source"), F.col("th").alias("p_th"), "e", "u", "at"
    )
    columns = docs.columns
    th = F.md5(F.coalesce("text", F.lit("")))
    same = (
        (th == F.col("p_th"))
        & F.col("doc_id").eqNullSafe(F.col("p_id"))
        & F.col("source").eqNullSafe(F.col("p_source"))
    )
    equal_rows = Window.partitionBy("p_th", "p_id", "p_source").orderBy(F.lit(0))
    return (
        docs.join(plan, same)
        .withColumn("i", F.row_number().over(equal_rows) - 1)
        .withColumn("copies", F.expr(COPIES).cast("int"))
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(*columns)
        .toDF(*names)
    )
