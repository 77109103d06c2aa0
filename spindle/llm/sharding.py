"""Sharding by sampled splitters (law ``bytes``: shard sizes near equal), DataFrame functions only.

Rows are ordered by a key (hash of the text, then hash of the doc_id), so equal texts stand together.

1. A size-weighted sample of keys is drawn (a row's chance is its share of all bytes), without any random state: the
   draw is a hash of the row.
2. Its quantiles are the splitters of ``RANGES`` ranges; every row is dealt into its range.
3. Rows and bytes are counted per range.  An overfull range is subdivided into equal steps of the key, and a cell that
   one key still overfills (a text that a third of all rows share) into equal steps of the second key.  No cell then
   holds more than about the square root of all rows.
4. Cells get exact offsets from their totals, rows exact offsets inside their cell.  A shard is an equal share of the
   bytes in this order.  Equal texts move together into the shard of their middle, unless they hold more than
   ``GROUP_SHARE`` of a shard: then they are divided too.

Only doc_id, size and hashes travel; the texts are read once and never shuffled.

Edge cases: a null text counts 1 byte and has the CRC of the empty text; a null doc_id is a value like any other;
repeated rows are counted once with a multiplicity and dealt out again at the end, one slot each; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.llm.common import pick, stored

RANGES = 1024
SAMPLE_PER_RANGE = 64
LEAST_CELL = 64  # rows; cells are not made smaller than this
GROUP_SHARE = 0.01  # a text's rows stay together up to this share of a shard
CHUNK = 1000  # copies of one repeated row that one task deals out
BUCKET_BITS = 12  # of the key, for the join of rows with ranges

HASH_MIN, HASH_SPAN = float(-(2**63)), float(2**64)


def sized_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, k1, k2, n``: one row per distinct document row with its multiplicity."""
    text = F.coalesce("text", F.lit(""))
    return (
        pick(docs, "doc_id", "text")
        .select(
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
        )
        .groupBy("doc_id", "size", "text_crc32", "k1")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("k2", F.xxhash64("doc_id", "text_crc32"))
    )


def unit_hash(*cols: str | Column) -> Column:
    """A number in [0, 1) from a row's values."""
    return (F.xxhash64(F.lit(7), *cols).cast("double") - F.lit(HASH_MIN)) / F.lit(HASH_SPAN)


def ranges_of(rows: DataFrame, total_bytes: int, ranges: int) -> DataFrame:
    """Size-weighted splitters as ``r, lo, hi`` over all 64-bit keys; at most ``ranges`` rows."""
    chance = F.col("size") * F.col("n") * F.lit(ranges * SAMPLE_PER_RANGE / max(total_bytes, 1))
    sample = rows.where(unit_hash("k1", "k2") < chance)
    quantiles = F.percentile_approx("k1", [i / ranges for i in range(1, ranges)], 20 * ranges)
    ends = f"array_sort(array_distinct(concat(array({-(2**63) + 1}L), coalesce(b, array()), array({2**63 - 1}L))))"
    return (
        sample.agg(quantiles.alias("b"))
        .select(F.expr(ends).alias("b"))
        .select(F.expr("inline(transform(sequence(0, size(b) - 2), i -> struct(i AS r, b[i] AS lo, b[i + 1] AS hi)))"))
    )


def steps(value: Column, lo: Column, hi: Column, n: Column) -> Column:
    """Which of ``n`` equal steps of [lo, hi) a key falls into."""
    at = F.floor((value.cast("double") - lo.cast("double")) * n / (hi.cast("double") - lo.cast("double")))
    return F.greatest(F.lit(0), F.least(n - 1, at)).cast("bigint")


def shard_documents(docs: DataFrame, shards: int = 8, ranges: int = RANGES) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    rows = stored(sized_rows(docs), "shard-rows")
    total = rows.agg(
        F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    ).first()
    cell_rows = max(LEAST_CELL, int(total["rows"] ** 0.5))
    # The splitters' quantiles are computed once; at most `ranges` rows, so broadcasting them is safe at any size.
    split = stored(ranges_of(rows, total["bytes"], ranges).coalesce(1), "shard-ranges")
    shift = 64 - BUCKET_BITS
    lookup = split.select(
        "*", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))).alias("bucket")
    )
    key = F.greatest(F.col("k1"), F.lit(-(2**63) + 1))
    key = F.least(key, F.lit(2**63 - 2))
    dealt = (
        rows.withColumn("k1", key)
        .withColumn("bucket", F.shiftright("k1", shift))
        .join(F.broadcast(lookup), "bucket")
        .where("k1 >= lo AND k1 < hi")
        .drop("bucket")
    )
    # Overfull ranges: equal steps of the key.  Counts per range: at most `ranges` rows.
    per_range = dealt.groupBy("r").agg(F.ceil(F.sum("n") / cell_rows).alias("n1"))
    dealt = dealt.join(F.broadcast(per_range), "r").withColumn("c1", steps(F.col("k1"), F.col("lo"), F.col("hi"), F.col("n1")))
    dealt = dealt.select("doc_id", "size", "text_crc32", "k1", "k2", "n", "r", "c1")
    # Cells that one key overfills: equal steps of the second key.  Only overfull cells are kept: at most about
    # sqrt(rows) of them, as each holds more than sqrt(rows) rows.
    over = dealt.groupBy("r", "c1").agg(F.ceil(F.sum("n") / cell_rows).alias("n2")).where("n2 > 1")
    dealt = dealt.join(F.broadcast(over), ["r", "c1"], "left")
    n2 = F.coalesce("n2", F.lit(1))
    dealt = dealt.withColumn("c2", steps(F.col("k2"), F.lit(HASH_MIN), F.lit(-HASH_MIN), n2)).drop("n2")
    cells = stored(dealt, "shard-cells")

    by_cell = ["r", "c1", "c2"]
    in_order = Window.orderBy(*by_cell).rowsBetween(Window.unboundedPreceding, -1)
    # One row per cell (about `ranges` + sqrt(rows)): the only place where one task sees all of anything.
    offsets = (
        cells.groupBy(*by_cell)
        .agg(F.sum("n").alias("cell_rows"), F.sum(F.col("size") * F.col("n")).alias("cell_bytes"))
        .select(
            *by_cell,
            F.coalesce(F.sum("cell_rows").over(in_order), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("cell_bytes").over(in_order), F.lit(0)).alias("bytes_before"),
        )
    )
    inside = Window.partitionBy(*by_cell).orderBy("k1", "k2", "doc_id", "text_crc32", "size")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by_cell, "k1")
    placed = (
        cells.join(offsets, by_cell)
        .withColumn("at", F.col("rows_before") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("b0", F.col("bytes_before") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0)))
        .withColumn("g0", F.min("b0").over(group))
        .withColumn("g", F.sum(F.col("size") * F.col("n")).over(group))
        .select("doc_id", "size", "text_crc32", "n", "at", "b0", "g0", "g")
    )
    # Repeated rows: one row per copy; many copies go through chunks that are spread over tasks first.
    single = placed.where(F.col("n") <= CHUNK).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    chunked = (
        placed.where(F.col("n") > CHUNK)
        .withColumn("c", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CHUNK))))
        .repartition("at", "c")
        .withColumn("i", F.explode(F.expr(f"sequence(c * {CHUNK}, least(n, (c + 1) * {CHUNK}) - 1)")))
        .drop("c")
    )
    limit = int(GROUP_SHARE * total["bytes"] / shards)
    middle = F.when(F.col("g") <= limit, 2 * F.col("g0") + F.col("g"))
    middle = middle.otherwise(2 * (F.col("b0") + F.col("i") * F.col("size")) + F.col("size"))
    share = F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * max(total["bytes"], 1))))
    rows = single.unionByName(chunked).select(
        "doc_id", "size", "text_crc32", (F.col("at") + F.col("i")).alias("at"), share.cast("int").alias("shard")
    )
    rows = stored(rows, "shard-rows-placed")
    starts = rows.groupBy("shard").agg(F.min("at").alias("start"))  # one row per shard
    return rows.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("at") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
