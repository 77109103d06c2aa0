"""Exact frequencies, Count-Min and Count-Sketch tables, top-K heavy hitters with ties, and error reports.

Inputs are item relations with a nullable ``item BIGINT`` (NULL = a line that did not parse; it still counts as
processed).  The sketches are relations ``(row INT, col BIGINT, v BIGINT)`` of at most D*W rows, so they merge
by a plain ``SUM`` and can be broadcast: their size is fixed by the parameters, not by the data.  Building them
is one map-side ``inline`` of D cells per item followed by a hash aggregation whose partial stage holds at most
D*W groups per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, TimestampNTZType, TimestampType

from spindle.functions.hashing import HashFamily, hash_col, sign_col
from spindle.session import ensure_checkpoint_dir


def valid(items: DataFrame) -> DataFrame:
    return items.where(F.col("item").isNotNull())


def item_frequency(items: DataFrame) -> DataFrame:
    """``(item, n)``: exact frequency of every parsed item."""
    return valid(items).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def stored_frequency(items: DataFrame) -> DataFrame:
    """The histogram checkpointed into the shared folder, for uses that read it more than once: the input is then scanned
    once, and a lost executor costs a re-read of the histogram."""
    ensure_checkpoint_dir(items.sparkSession)
    return item_frequency(items).checkpoint(eager=True)


def kth_frequency(freq: DataFrame, k: int) -> Column:
    """Scalar subquery: the k-th largest frequency (the smallest one when there are fewer than k items).

    ``orderBy().limit(k)`` runs as a per-task top-k followed by a merge of k rows per task, so no task sees more
    than k rows per input partition.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    return freq.select("n").orderBy(F.desc("n")).limit(k).agg(F.min("n")).scalar()


def top_k(freq: DataFrame, k: int) -> DataFrame:
    """Every item whose frequency is at least the k-th largest one (ties kept; all items if fewer than k)."""
    return freq.where(F.col("n") >= kth_frequency(freq, k))


# Counters of one task's summary (16 bytes each), and the most candidates broadcast to the recount.
SUMMARY_COUNTERS = 8192
BROADCAST_CANDIDATES = 1_000_000


def frequent_summary(items: DataFrame, capacity: int = SUMMARY_COUNTERS) -> DataFrame:
    """``(item, low, err)``: the Misra–Gries summaries of all tasks added up.  For every item ``low <= n <= low + E`` with E
    the ``err`` of the NULL row (an item without a row has ``low`` 0); E is at most lines / (capacity + 1)."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    from pyspark import cloudpickle

    from spindle.functions import frequent

    cloudpickle.register_pickle_by_value(frequent)
    parts = valid(items).select("item").mapInArrow(frequent.summary_kernel(capacity), frequent.SUMMARY_SCHEMA)
    return parts.groupBy("item").agg(F.sum("low").alias("low"), F.sum("err").alias("err"))


def top_k_items(items: DataFrame, k: int, capacity: int = SUMMARY_COUNTERS) -> DataFrame:
    """``(item, n)``: the rows of ``top_k(item_frequency(items), k)``, without a shuffle of the rare items.

    The summaries leave a candidate set that is proven to hold the answer: the k-th largest ``low`` is at most the k-th
    frequency T, so an item of the answer has ``low + E >= T``, and one without a counter is ruled out where T > E.
    Candidates are then counted exactly in a second scan, by a broadcast up to ``BROADCAST_CANDIDATES`` of them (counted
    here) and by a shuffled semi-join beyond.  Where E is 0 the summary is the histogram; where the bound rules nothing out
    (near-uniform items), the full histogram is built.  The summary is kept in the shared folder: building this starts a job.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    ensure_checkpoint_dir(items.sparkSession)
    summary = frequent_summary(items, capacity).checkpoint(eager=True)
    counted = summary.where(F.col("item").isNotNull())
    error = int(summary.where(F.col("item").isNull()).agg(F.coalesce(F.sum("err"), F.lit(0))).first()[0])
    if error == 0:
        return top_k(counted.select("item", F.col("low").alias("n")), k)
    largest = counted.select("low").orderBy(F.desc("low")).limit(k).agg(F.count(F.lit(1)), F.min("low")).first()
    if largest[0] < k or largest[1] <= error:
        return top_k(item_frequency(items), k)
    candidates = counted.where(F.col("low") >= largest[1] - error).select("item")
    if candidates.count() <= BROADCAST_CANDIDATES:
        candidates = F.broadcast(candidates)
    freq = item_frequency(items.join(candidates, "item", "left_semi")).checkpoint(eager=True)
    return top_k(freq, k)


def _cells(item: Column, fam: HashFamily, kind: str) -> Column:
    structs = []
    for h in fam.rows:
        if kind == "cm":
            col, w = hash_col(item, h.a_cm, h.b_cm, fam.width, fam.prime), F.lit(1).cast("bigint")
        else:
            col, w = hash_col(item, h.a_cs, h.b_cs, fam.width, fam.prime), sign_col(item, h.a_sg, h.b_sg, fam.prime)
        structs.append(F.struct(F.lit(h.row).cast("int").alias("row"), col.alias("col"), w.alias("w")))
    return F.array(*structs)


def sketch_cells(items: DataFrame, fam: HashFamily, kind: str = "cm") -> DataFrame:
    """Count-Min (``kind="cm"``: +1 per item and row) or Count-Sketch (``"cs"``: ±1) table as ``(row, col, v)``."""
    if kind not in ("cm", "cs"):
        raise ValueError("kind must be 'cm' or 'cs'")
    return (
        valid(items)
        .select(F.inline(_cells(F.col("item"), fam, kind)))
        .groupBy("row", "col")
        .agg(F.sum("w").cast("bigint").alias("v"))
    )


def sketch_from_freq(freq: DataFrame, fam: HashFamily, kind: str = "cm") -> DataFrame:
    """The same table built from an exact histogram ``(item, n)``: each distinct item adds ``n`` (or ``n * sign``)
    to its D cells, so the work is D per distinct item instead of D per line."""
    if kind not in ("cm", "cs"):
        raise ValueError("kind must be 'cm' or 'cs'")
    return (
        freq.select("n", F.inline(_cells(F.col("item"), fam, kind)))
        .groupBy("row", "col")
        .agg(F.sum(F.col("w") * F.col("n")).cast("bigint").alias("v"))
    )


def count_min_cells(items: DataFrame, fam: HashFamily) -> DataFrame:
    return sketch_cells(items, fam, "cm")


def count_sketch_cells(items: DataFrame, fam: HashFamily) -> DataFrame:
    return sketch_cells(items, fam, "cs")


def _probe(keys: DataFrame, fam: HashFamily) -> DataFrame:
    """Every key column plus ``(row, col_cm, col_cs, sign)``: the D cells each key reads."""
    item = F.col("item")
    structs = [
        F.struct(
            F.lit(h.row).cast("int").alias("row"),
            hash_col(item, h.a_cm, h.b_cm, fam.width, fam.prime).alias("col_cm"),
            hash_col(item, h.a_cs, h.b_cs, fam.width, fam.prime).alias("col_cs"),
            sign_col(item, h.a_sg, h.b_sg, fam.prime).alias("sign"),
        )
        for h in fam.rows
    ]
    return keys.select(*keys.columns, F.inline(F.array(*structs)))


def _unique_keys(keys: DataFrame, unique: bool) -> DataFrame:
    return keys if unique else keys.select("item").distinct()


# Largest sketch (D*W cells, about 24 bytes each) broadcast to the estimate lookup; a larger one is joined by a
# shuffle on (row, col) instead.
BROADCAST_SKETCH_CELLS = 4_000_000


def _bounded_broadcast(df: DataFrame, fam: HashFamily) -> DataFrame:
    # A sketch table holds at most D*W rows: a bound fixed by the parameters, checked here.
    return F.broadcast(df) if fam.depth * fam.width <= BROADCAST_SKETCH_CELLS else df


def _cm_cells(cm: DataFrame, fam: HashFamily) -> DataFrame:
    return _bounded_broadcast(cm.select("row", F.col("col").alias("col_cm"), F.col("v").alias("v_cm")), fam)


def _cs_cells(cs: DataFrame, fam: HashFamily) -> DataFrame:
    return _bounded_broadcast(cs.select("row", F.col("col").alias("col_cs"), F.col("v").alias("v_cs")), fam)


def _est_cm() -> Column:
    return F.min(F.coalesce(F.col("v_cm"), F.lit(0))).cast("bigint").alias("est_cm")


def _est_cs(fam: HashFamily) -> Column:
    signed = F.coalesce(F.col("v_cs"), F.lit(0)) * F.col("sign")
    return F.sort_array(F.collect_list(signed)).getItem(fam.depth // 2).cast("bigint").alias("est_cs")


# Largest sketch looked up as one array held by every task (8 bytes a cell).
ARRAY_SKETCH_CELLS = 1_000_000


def _cell_array(table: DataFrame, fam: HashFamily) -> Column:
    """Scalar subquery: all D*W cells as one array, cell (row, col) at row * W + col, a missing one 0.  Its size is
    fixed by the parameters."""
    slot = (F.col("row") * F.lit(fam.width) + F.col("col")).cast("bigint").alias("i")
    blank = table.sparkSession.range(fam.depth * fam.width).select(F.col("id").alias("i"), F.lit(0).cast("bigint").alias("v"))
    full = table.select(slot, F.col("v").cast("bigint").alias("v")).unionAll(blank).groupBy("i").agg(F.sum("v").alias("v"))
    cells = full.agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("c"))
    return cells.select(F.col("c.v").alias("v")).scalar()


def _map_side(k: DataFrame, cm: DataFrame | None, cs: DataFrame | None, fam: HashFamily) -> DataFrame:
    """Estimates by array lookup in the task that holds the key: no explode, join or shuffle of the keys."""
    item = F.col("item")

    def cell(table: Column, row: int, col: Column) -> Column:
        return F.get(table, F.lit(row * fam.width) + col)

    cols = list(k.columns)
    if cm is not None:
        table = _cell_array(cm, fam)
        read = [cell(table, h.row, hash_col(item, h.a_cm, h.b_cm, fam.width, fam.prime)) for h in fam.rows]
        cols.append(F.array_min(F.array(*read)).alias("est_cm"))
    if cs is not None:
        table = _cell_array(cs, fam)
        read = [
            cell(table, h.row, hash_col(item, h.a_cs, h.b_cs, fam.width, fam.prime))
            * sign_col(item, h.a_sg, h.b_sg, fam.prime)
            for h in fam.rows
        ]
        cols.append(F.sort_array(F.array(*read)).getItem(fam.depth // 2).cast("bigint").alias("est_cs"))
    return k.select(*cols)


def _estimated(keys: DataFrame, cm: DataFrame | None, cs: DataFrame | None, fam: HashFamily, unique: bool) -> DataFrame:
    k = _unique_keys(keys, unique)
    if fam.depth * fam.width <= ARRAY_SKETCH_CELLS:
        return _map_side(k, cm, cs, fam)
    probe, aggs = _probe(k, fam), []
    if cm is not None:
        probe, aggs = probe.join(_cm_cells(cm, fam), ["row", "col_cm"], "left"), [*aggs, _est_cm()]
    if cs is not None:
        probe, aggs = probe.join(_cs_cells(cs, fam), ["row", "col_cs"], "left"), [*aggs, _est_cs(fam)]
    return probe.groupBy(*k.columns).agg(*aggs)


def estimates(keys: DataFrame, cm: DataFrame, cs: DataFrame, fam: HashFamily, unique: bool = False) -> DataFrame:
    """Key columns plus ``(est_cm, est_cs)``: Count-Min = min over rows, Count-Sketch = upper median of the D
    signed cells (the element at index D div 2 of the sorted values).  A missing cell reads as 0.  With
    ``unique=True`` the keys are taken as distinct items and every key column is carried through.

    Up to ``ARRAY_SKETCH_CELLS`` cells the sketch is an array in the plan, looked up map-side; beyond, it is joined on
    (row, col).  Both give the same rows."""
    return _estimated(keys, cm, cs, fam, unique)


def count_min_estimate(keys: DataFrame, cm: DataFrame, fam: HashFamily, unique: bool = False) -> DataFrame:
    return _estimated(keys, cm, None, fam, unique)


def count_sketch_estimate(keys: DataFrame, cs: DataFrame, fam: HashFamily, unique: bool = False) -> DataFrame:
    return _estimated(keys, None, cs, fam, unique)


@dataclass
class HeavyHitters:
    """Every relation of a heavy-hitter run; lazy DataFrames over one aggregated state (see :func:`cell_state`)."""

    freq: DataFrame
    cm: DataFrame
    cs: DataFrame
    top: DataFrame
    report: DataFrame
    summary: DataFrame
    listing: DataFrame
    state: DataFrame | None = None

    def release(self) -> None:
        """Drop cached blocks of the state, if any (checkpoint files are left to the cleaner)."""
        if self.state is not None:
            self.state.unpersist()


def error_report(top: DataFrame, cm: DataFrame, cs: DataFrame, fam: HashFamily) -> DataFrame:
    """``(item, n, est_cm, est_cs, err_cm, err_cs)`` for the top-K items; err = |n - est| / n.  The true count
    rides along through the estimate aggregation, so no join back to the top-K is needed."""
    est = estimates(top.select("item", "n"), cm, cs, fam, unique=True)
    n = F.col("n").cast("double")
    return est.select(
        "item",
        "n",
        "est_cm",
        "est_cs",
        (F.abs(F.col("n") - F.col("est_cm")) / n).alias("err_cm"),
        (F.abs(F.col("n") - F.col("est_cs")) / n).alias("err_cs"),
    )


# ---------------------------------------------------------------------------------------------------------------
# One pass for every table: tagged cells
# ---------------------------------------------------------------------------------------------------------------

CELL_SCHEMA = "tag INT, a BIGINT, b BIGINT, v BIGINT"
TAG_P, TAG_F, TAG_CM, TAG_CS, TAG_N = 0, 1, 2, 3, 4


def tagged_cells(items: DataFrame, fam: HashFamily, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every line's contributions ``(tag, a, b, v)``:

    * ``(TAG_P, 0, 0, 1)``              a processed line, parsed or not;
    * ``(TAG_F, item, 0, 1)``           the exact histogram;
    * ``(TAG_CM, row, col, 1)`` x D     Count-Min;
    * ``(TAG_CS, row, col, ±1)`` x D    Count-Sketch.

    One ``groupBy(tag, a, b).sum(v)`` over them builds all four relations from a single scan and a single shuffle;
    map-side partial aggregation collapses a hot item to one row per task.
    """
    item = F.col("item")
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def cell(tag: int, a: Column, b: Column, v: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), a.alias("a"), b.alias("b"), v.alias("v"))

    parsed = [cell(TAG_F, item, zero, one)]
    for h in fam.rows:
        r = F.lit(h.row).cast("bigint")
        parsed.append(cell(TAG_CM, r, hash_col(item, h.a_cm, h.b_cm, fam.width, fam.prime), one))
        parsed.append(
            cell(
                TAG_CS,
                r,
                hash_col(item, h.a_cs, h.b_cs, fam.width, fam.prime),
                sign_col(item, h.a_sg, h.b_sg, fam.prime),
            )
        )
    processed = F.array(cell(TAG_P, zero, zero, one))
    all_cells = F.when(item.isNotNull(), F.concat(processed, F.array(*parsed))).otherwise(processed)
    return items.select(*keep, F.inline(all_cells))


def cell_state(items: DataFrame, fam: HashFamily, by: tuple[str, ...] = ()) -> DataFrame:
    """``([by...,] tag, a, b, v)``: the summed cells (optionally per batch) -- in batch, the same relation the
    streaming query keeps as its state."""
    return (
        tagged_cells(items, fam, keep=by)
        .groupBy(*by, "tag", "a", "b")
        .agg(F.sum("v").cast("bigint").alias("v"))
    )


def _small_state(counts: DataFrame, fam: HashFamily) -> DataFrame:
    """``(tag, a, b, v)`` of the processed lines, the distinct items and both sketches, from the histogram
    ``(item, n)`` whose NULL group holds the unparsed lines."""
    item, n = F.col("item"), F.col("n")
    zero = F.lit(0).cast("bigint")

    def cell(tag: int, a: Column, b: Column, v: Column) -> Column:
        return F.struct(F.lit(tag).alias("tag"), a.alias("a"), b.alias("b"), v.cast("bigint").alias("v"))

    parsed = [cell(TAG_N, zero, zero, F.lit(1))]
    for h in fam.rows:
        row = F.lit(h.row).cast("bigint")
        sign = sign_col(item, h.a_sg, h.b_sg, fam.prime)
        parsed.append(cell(TAG_CM, row, hash_col(item, h.a_cm, h.b_cm, fam.width, fam.prime), n))
        parsed.append(cell(TAG_CS, row, hash_col(item, h.a_cs, h.b_cs, fam.width, fam.prime), n * sign))
    processed = F.array(cell(TAG_P, zero, zero, n))
    cells = F.when(item.isNotNull(), F.concat(processed, F.array(*parsed))).otherwise(processed)
    return counts.select(F.inline(cells)).groupBy("tag", "a", "b").agg(F.sum("v").cast("bigint").alias("v"))


def tables_from_cells(state: DataFrame):
    """``(processed, freq, cm, cs)`` relations from a ``(tag, a, b, v)`` state table."""
    processed = state.where(F.col("tag") == TAG_P).agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("processed")
    )
    freq = state.where(F.col("tag") == TAG_F).select(F.col("a").alias("item"), F.col("v").alias("n"))
    cm = state.where(F.col("tag") == TAG_CM).select(F.col("a").cast("int").alias("row"), F.col("b").alias("col"), "v")
    cs = state.where(F.col("tag") == TAG_CS).select(F.col("a").cast("int").alias("row"), F.col("b").alias("col"), "v")
    return processed, freq, cm, cs


def heavy_hitters(items: DataFrame, fam: HashFamily, k: int, threshold: int | None = None) -> HeavyHitters:
    """The full batch report over an item relation (every line counts as processed, parsed or not).

    One scan and one shuffle build the exact histogram, with unparsed lines kept as the NULL group.  Every relation
    of the report reads it, so it is checkpointed into the shared ``spark.checkpoint.dir``: a lost executor then
    costs a re-read of the histogram, not a rescan of the input.  One pass over its distinct items gives both sketches
    and both counts, at most 2*D*W + 2 rows, kept the same way; all relations of the report come from that small table
    and the top-K items.  With ``threshold`` the items carry a ``batch`` column and only the batches taken under the stop rule
    count (see :func:`bounded_items`).
    """
    if threshold is not None:
        items = bounded_items(items, threshold)
    ensure_checkpoint_dir(items.sparkSession)
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    freq = counts.where(F.col("item").isNotNull())
    cells = _small_state(counts, fam).checkpoint(eager=True)
    processed, _, cm, cs = tables_from_cells(cells)
    distinct = cells.where(F.col("tag") == TAG_N).agg(F.coalesce(F.sum("v"), F.lit(0)).cast("bigint")).scalar()
    hh = hh_from_tables(processed, freq, cm, cs, fam, k, distinct)
    hh.state = counts
    return hh


def hh_from_tables(
    processed: DataFrame,
    freq: DataFrame,
    cm: DataFrame,
    cs: DataFrame,
    fam: HashFamily,
    k: int,
    distinct: Column | None = None,
) -> HeavyHitters:
    """Report from already-built tables (used by the batch and the streaming paths); ``distinct`` is the number of
    distinct items as a scalar, where it is known."""
    top = top_k(freq, k)
    rep = error_report(top, cm, cs, fam)
    stats = rep.agg(
        F.struct(
            F.count(F.lit(1)).alias("n_top"), F.avg("err_cm").alias("avg_err_cm"), F.avg("err_cs").alias("avg_err_cs")
        ).alias("s")
    ).scalar()
    if distinct is None:
        distinct = freq.agg(F.count(F.lit(1))).scalar()
    # One-row relation; the report is evaluated once, as a single scalar subquery returning a struct.
    summary = processed.select(
        F.col("processed").cast("bigint").alias("processed"),
        distinct.alias("n_distinct"),
        stats.getField("n_top").alias("n_top"),
        stats.getField("avg_err_cm").alias("avg_err_cm"),
        stats.getField("avg_err_cs").alias("avg_err_cs"),
    )
    listing = rep.select("item", "n", "est_cm").orderBy("item")
    return HeavyHitters(freq, cm, cs, top, rep, summary, listing)


# ---------------------------------------------------------------------------------------------------------------
# Bounded consumption (batch twin of the streaming stop rule)
# ---------------------------------------------------------------------------------------------------------------


# Width of the blocks of a running total, in batch numbers or days.
TOTAL_BLOCK = 1024


def _block(batch: str, kind: DataType) -> Column:
    """A key that rises with the batch and groups neighbours; a constant for types without a number."""
    if isinstance(kind, DateType):
        return F.floor(F.unix_date(batch) / F.lit(TOTAL_BLOCK)).cast("bigint")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_date(F.to_date(batch)).cast("bigint")
    if isinstance(kind, IntegralType):
        wide = F.col(batch).cast("bigint")
        return F.when(wide.isNotNull(), (wide - F.pmod(wide, F.lit(TOTAL_BLOCK))))
    return F.lit(0).cast("bigint")


def _taken(sizes: DataFrame, threshold: int) -> DataFrame:
    """The batches with fewer than ``threshold`` items before them, by a running total of two levels: over blocks of
    batches, then inside each block that begins below the threshold.  A null batch comes first."""
    sizes = sizes.withColumn("block", _block("batch", sizes.schema["batch"].dataType))
    totals = sizes.groupBy("block").agg(F.sum("size").alias("total"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("block").alias("b"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("block").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    open_blocks = sizes.join(starts.where(F.col("start") < F.lit(threshold)), F.col("block").eqNullSafe(F.col("b")))
    before = (F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))).cast("bigint")
    return open_blocks.withColumn("before", before).where(F.col("before") < F.lit(threshold)).select("batch", "size", "before")


def batch_sizes(items: DataFrame, threshold: int) -> DataFrame:
    """``(batch, size, before)`` for the batches that are taken: a batch is taken whole iff the items of all
    earlier batches number fewer than ``threshold``."""
    sizes = items.groupBy("batch").agg(F.count(F.lit(1)).alias("size"))
    return _taken(sizes, threshold)


def bounded_items(items: DataFrame, threshold: int) -> DataFrame:
    """Items of the batches taken under the stop rule.  Taken batches form a prefix in batch order, so a scalar
    bound replaces a join.  Items without a batch key are the first batch."""
    last = batch_sizes(items, threshold).agg(F.max("batch")).scalar()
    return items.where((F.col("batch") <= last) | (F.col("batch").isNull() & F.lit(threshold > 0)))
