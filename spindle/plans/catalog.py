"""Registered queries over the driver's test tables, each paired with its DuckDB oracle (or none).

Every query reads whole tables.  Doubles are rounded to 6 decimals on both sides; centre sets are returned in
long form ``(ci, j, value)`` so that no array column has to be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.functions.hashing import hash_family
from spindle.operators import clustering as clu
from spindle.operators import fair
from spindle.operators import sketch as sk
from spindle.operators import words as wc
from spindle.plans import oracle as orc
from spindle.session import spread
from spindle.sources.points import (
    embeddings_points,
    lineitem_points,
    parse_point_lines,
    point_lines,
    read_points,
    write_points,
)
from spindle.sources.text import documents, event_items, lineitem_items, parse_items, read_docs

R = orc.R
# Fixed parameters of the registered queries.
K = 4  # clusters
LARGE_K, OFFSET = 40, 1.7e9  # the far large-K assignment
M = 2  # rounds
HH_DEPTH = 7
HH_WIDTH = 100
HH_K = 20
HH_SEED = 48
STREAM_T = 5000
FAM = hash_family(HH_DEPTH, HH_WIDTH, seed=HH_SEED)

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: Query
    sql: str | None


def rnd(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, R).alias(name or (c if isinstance(c, str) else "value"))


POINT_SETS = {"embeddings": embeddings_points, "lineitem": lineitem_points}


def _points(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return POINT_SETS[dataset](spark, sf_dir)


def _cores(spark: SparkSession) -> int:
    """The layout of the test tables, which are single-split files."""
    return spark.sparkContext.defaultParallelism


def _init(p: DataFrame, k: int = K) -> list[list[float]]:
    return clu.first_k_centers(p, k, ["id", "features"])


def _long(spark: SparkSession, centers) -> DataFrame:
    return clu.centers_df(spark, centers).select("ci", "j", rnd("value"))


# ---------------------------------------------------------------------------------------------------------------
# Clustering
# ---------------------------------------------------------------------------------------------------------------


def q_points_from_table(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        fsum = F.aggregate("features", F.lit(0.0), lambda s, x: s + x)
        return p.select("id", "grp", F.size("features").cast("int").alias("dim"), rnd(fsum, "fsum"))

    return q


def q_points_from_lines(spark, sf):
    lines = point_lines(lineitem_points(spark, sf))
    p = parse_point_lines(lines)
    return p.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("features")[0]), 4).alias("sum_x0"),
        F.round(F.sum(F.col("features")[1]), 4).alias("sum_x1"),
    )


def q_group_counts(dataset):
    return lambda spark, sf: clu.group_counts(_points(spark, sf, dataset))


def q_assign_nearest(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return clu.assign(p, _init(p)).select("id", "grp", "ci", rnd("d2"))

    return q


def q_objective(dataset, what):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        o = clu.objectives(p, _init(p))
        if what == "all":
            return o.select("n", "n_a", "n_b", rnd("delta"), rnd("phi"))
        return o.select(rnd(what))

    return q


def q_cluster_group_stats(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return clu.cluster_stats(p, _init(p)).select("ci", "n_a", "n_b")

    return q


def q_kmeans_lloyd(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return _long(spark, clu.lloyd(p, _init(p), M, partitions=_cores(spark)))

    return q


def q_clustering_report(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        rep = clu.clustering_report(p, K, M, init=_init(p), partitions=_cores(spark))
        return rep.summary.select("n", "n_a", "n_b", rnd("delta"), rnd("phi"))

    return q


def q_cluster_ab_outer_join(dataset):
    """Per-group vector sums joined per cluster with a full outer join, in long form ``(ci, j, ...)``."""

    def q(spark, sf):
        p = _points(spark, sf, dataset)
        j = clu.cluster_ab_outer_join(p, _init(p))
        z = j.select("ci", "n_a", "n_b", F.posexplode(F.arrays_zip("s_a", "s_b")).alias("j", "s"))
        return z.select(
            "ci", F.col("j").cast("int").alias("j"), "n_a", "n_b", rnd("s.s_a", "sum_a"), rnd("s.s_b", "sum_b")
        )

    return q


def q_fair_cluster_stats(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        df = fair.fair_cluster_stats_df(p, _init(p))
        z = df.select(
            "ci", "n_a", "n_b", "alpha", "beta", "ell", F.posexplode(F.arrays_zip("mu_a", "mu_b")).alias("j", "m")
        )
        return z.select(
            "ci",
            F.col("j").cast("int").alias("j"),
            "n_a",
            "n_b",
            rnd("alpha"),
            rnd("beta"),
            rnd("ell"),
            rnd("m.mu_a", "mu_a"),
            rnd("m.mu_b", "mu_b"),
        )

    return q


def q_fair_scatter(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return fair.fair_scatter_df(p, _init(p)).select(rnd("fixed_a"), rnd("fixed_b"))

    return q


def q_fair_balance(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return fair.fair_balance_df(p, _init(p)).select("ci", rnd("x"))

    return q


def q_fair_step(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return _long(spark, fair.fair_step(p, _init(p)))

    return q


def q_fair_lloyd(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        return _long(spark, fair.fair_lloyd(p, K, M, init=_init(p), partitions=_cores(spark)))

    return q


def q_fair_vs_standard(dataset):
    def q(spark, sf):
        p = _points(spark, sf, dataset)
        summary, _, _ = fair.fair_vs_standard(p, K, M, init=_init(p), partitions=_cores(spark))
        return summary.select("n", "n_a", "n_b", rnd("phi_standard"), rnd("phi_fair"))

    return q


def q_fair_vs_standard_seeded(dataset):
    """The flagship from its own start: hash-drawn k-means|| seeding, then standard and fair centres."""

    def q(spark, sf):
        summary, _, _ = fair.fair_vs_standard(_points(spark, sf, dataset), K, M, partitions=_cores(spark))
        return summary.select("n", "n_a", "n_b", rnd("phi_standard"), rnd("phi_fair"))

    return q


def q_kmeans_parallel(spark, sf):
    p = embeddings_points(spark, sf)
    return _long(spark, clu.lloyd(p, clu.kmeans_init(p, K), M, partitions=_cores(spark), tol=1e-4))


def q_kmeans_init(spark, sf):
    return _long(spark, clu.kmeans_init(embeddings_points(spark, sf), K))


def q_assign_nearest_large_k(dataset):
    """More centres than the unrolled expression takes, and points far from the origin."""

    def q(spark, sf):
        moved = F.transform("features", lambda x: x + F.lit(OFFSET)).alias("features")
        p = _points(spark, sf, dataset).select("id", moved, "grp")
        return clu.assign(p, _init(p, LARGE_K)).select("id", "grp", "ci", rnd("d2"))

    return q


def q_clustering_report_stats(dataset):
    """The report's per-centre group counts, one row per centre and coordinate."""

    def q(spark, sf):
        p = _points(spark, sf, dataset)
        rep = clu.clustering_report(p, K, M, init=_init(p), partitions=_cores(spark))
        z = rep.stats.select("ci", "n_a", "n_b", F.posexplode("center").alias("j", "v"))
        return z.select("ci", F.col("j").cast("int").alias("j"), rnd("v", "value"), "n_a", "n_b")

    return q


def q_points_from_files(spark, sf):
    """Points written as text part files by the writer and scanned back."""
    from spindle.session import work_path

    path = work_path(spark, "points")
    write_points(lineitem_points(spark, sf), path)
    p = read_points(spark, path, dim=2)
    return p.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(F.col("features")[0]), 4).alias("sum_x0"),
        F.round(F.sum(F.col("features")[1]), 4).alias("sum_x1"),
    )


def q_words_from_files(spark, sf):
    """Documents written as text files, one line per document, and scanned back."""
    from spindle.session import work_path

    path = work_path(spark, "docs")
    line = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\r\\n]", " ")
    documents(spark, sf).select(line.alias("value")).write.text(path)
    return wc.word_count(read_docs(spark, path))


# ---------------------------------------------------------------------------------------------------------------
# Word count
# ---------------------------------------------------------------------------------------------------------------


def q_words(kind):
    def q(spark, sf):
        d = spread(documents(spark, sf), _cores(spark))
        if kind == "doc_count":
            return wc.doc_count(d)
        if kind == "word_count":
            return wc.word_count(d)
        if kind == "per_doc":
            return wc.word_count_per_doc(d)
        if kind == "salted":
            return wc.word_count_salted(d, 8)
        if kind == "salted_pairs":
            return wc.word_count_salted_pairs(d, 8)
        if kind == "partition":
            return wc.word_count_partition(d)
        if kind == "distinct":
            return wc.distinct_words(wc.word_count(d))
        if kind == "avg_len":
            return wc.avg_word_length(wc.word_count(d)).select("n_words", rnd("avg_length"))
        raise ValueError(kind)

    return q


# ---------------------------------------------------------------------------------------------------------------
# Items and sketches
# ---------------------------------------------------------------------------------------------------------------

ITEMS = {
    "lineitem_partkey": lambda spark, sf: lineitem_items(spark, sf, "l_partkey"),
    "lineitem_orderkey": lambda spark, sf: lineitem_items(spark, sf, "l_orderkey"),
    "events": event_items,
}


def q_items_parse(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    # A dirty line stream derived from events: error events carry their JSON props instead of a user id.
    value = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("user_id").cast("string"))
    return parse_items(ev.select("event_id", value.alias("value")))


def q_hh(source, what):
    def q(spark, sf):
        items = ITEMS[source](spark, sf)
        if what == "freq":
            return sk.item_frequency(items)
        if what == "top":
            return sk.top_k_items(items, HH_K)
        if what == "cm":
            return sk.count_min_cells(items, FAM)
        if what == "cs":
            return sk.count_sketch_cells(items, FAM)
        if what == "cm_est":
            freq = sk.stored_frequency(items)
            return sk.count_min_estimate(freq.select("item"), sk.sketch_from_freq(freq, FAM, "cm"), FAM, unique=True)
        if what == "cs_est":
            freq = sk.stored_frequency(items)
            return sk.count_sketch_estimate(freq.select("item"), sk.sketch_from_freq(freq, FAM, "cs"), FAM, unique=True)
        hh = sk.heavy_hitters(items, FAM, HH_K)
        if what == "report":
            return hh.report.select("item", "n", "est_cm", "est_cs", rnd("err_cm"), rnd("err_cs"))
        if what == "summary":
            return hh.summary.select("processed", "n_distinct", "n_top", rnd("avg_err_cm"), rnd("avg_err_cs"))
        if what == "listing":
            return hh.listing
        raise ValueError(what)

    return q


def q_bounded_stream(spark, sf):
    items = event_items(spark, sf)
    return sk.batch_sizes(items, STREAM_T).select(F.col("batch").cast("string").alias("batch"), "size", "before")


def q_bounded_hh_summary(spark, sf):
    hh = sk.heavy_hitters(event_items(spark, sf), FAM, HH_K, threshold=STREAM_T)
    return hh.summary.select("processed", "n_distinct", "n_top", rnd("avg_err_cm"), rnd("avg_err_cs"))


# ---------------------------------------------------------------------------------------------------------------
# Registry
# ---------------------------------------------------------------------------------------------------------------


def registry() -> dict[str, Entry]:
    from spindle.plans import stream_queries as sq

    e, li = "embeddings", "lineitem"
    reg: dict[str, Entry] = {
        # sources
        "points_from_table": Entry(q_points_from_table(e), orc.points_from_table(e)),
        "points_from_lines": Entry(q_points_from_lines, orc.points_from_lines(li)),
        "points_from_files": Entry(q_points_from_files, orc.points_from_lines(li)),
        # clustering quality
        "group_counts": Entry(q_group_counts(e), orc.group_counts(e)),
        "assign_nearest": Entry(q_assign_nearest(e), orc.assign_nearest(e, K)),
        "standard_objective": Entry(q_objective(li, "delta"), orc.objectives_at_init(li, K, "delta")),
        "fair_objective": Entry(q_objective(e, "phi"), orc.objectives_at_init(e, K, "phi")),
        "fair_objective_lineitem": Entry(q_objective(li, "phi"), orc.objectives_at_init(li, K, "phi")),
        "objectives_lineitem": Entry(q_objective(li, "all"), orc.objectives_at_init(li, K, "all")),
        "cluster_group_stats": Entry(q_cluster_group_stats(li), orc.cluster_group_stats(li, K)),
        "clustering_report": Entry(q_clustering_report(e), orc.clustering_report(e, K, M)),
        "cluster_ab_outer_join": Entry(q_cluster_ab_outer_join(e), orc.cluster_ab_outer_join(e, K)),
        "kmeans_lloyd": Entry(q_kmeans_lloyd(li), orc.kmeans_lloyd(li, K, M)),
        "kmeans_parallel": Entry(q_kmeans_parallel, orc.kmeans_parallel(e, K, M)),
        "kmeans_init": Entry(q_kmeans_init, orc.kmeans_init(e, K)),
        "assign_nearest_large_k": Entry(
            q_assign_nearest_large_k(li), orc.assign_nearest_large_k(li, LARGE_K, OFFSET)
        ),
        "clustering_report_stats": Entry(q_clustering_report_stats(e), orc.clustering_report_stats(e, K, M)),
        "fair_vs_standard_seeded": Entry(q_fair_vs_standard_seeded(e), orc.fair_vs_standard(e, K, M, seeded=True)),
        # fair clustering
        "fair_cluster_stats": Entry(q_fair_cluster_stats(e), orc.fair_cluster_stats(e, K)),
        "fair_scatter": Entry(q_fair_scatter(e), orc.fair_scatter(e, K)),
        "fair_balance": Entry(q_fair_balance(e), orc.fair_balance(e, K)),
        "fair_step": Entry(q_fair_step(e), orc.fair_step(e, K)),
        "fair_lloyd": Entry(q_fair_lloyd(e), orc.fair_lloyd(e, K, M)),
        "fair_lloyd_lineitem": Entry(q_fair_lloyd(li), orc.fair_lloyd(li, K, M)),
        "fair_vs_standard": Entry(q_fair_vs_standard(e), orc.fair_vs_standard(e, K, M)),
        "fair_vs_standard_lineitem": Entry(q_fair_vs_standard(li), orc.fair_vs_standard(li, K, M)),
        # word count
        "doc_count": Entry(q_words("doc_count"), orc.doc_count()),
        "word_count": Entry(q_words("word_count"), orc.word_count()),
        "word_count_files": Entry(q_words_from_files, orc.word_count_files()),
        "word_count_per_doc": Entry(q_words("per_doc"), orc.word_count_per_doc()),
        "word_count_salted": Entry(q_words("salted"), orc.word_count()),
        "word_count_salted_pairs": Entry(q_words("salted_pairs"), orc.word_count()),
        "word_count_partition": Entry(q_words("partition"), orc.word_count()),
        "distinct_words": Entry(q_words("distinct"), orc.distinct_words()),
        "avg_word_length": Entry(q_words("avg_len"), orc.avg_word_length()),
        # items and sketches
        "items_parse": Entry(q_items_parse, orc.items_parse()),
        "item_frequency": Entry(q_hh("lineitem_partkey", "freq"), orc.item_frequency("lineitem_partkey")),
        "top_k_events": Entry(q_hh("events", "top"), orc.top_k("events", HH_K)),
        "top_k_heavy_hitters": Entry(q_hh("lineitem_partkey", "top"), orc.top_k("lineitem_partkey", HH_K)),
        "count_min_cells": Entry(q_hh("lineitem_partkey", "cm"), orc.count_min_cells("lineitem_partkey", FAM)),
        "count_sketch_cells": Entry(q_hh("lineitem_partkey", "cs"), orc.count_sketch_cells("lineitem_partkey", FAM)),
        "count_min_cells_orderkey": Entry(
            q_hh("lineitem_orderkey", "cm"), orc.count_min_cells("lineitem_orderkey", FAM)
        ),
        "count_min_estimate": Entry(
            q_hh("lineitem_partkey", "cm_est"), orc.count_min_estimate("lineitem_partkey", FAM)
        ),
        "count_sketch_estimate": Entry(
            q_hh("lineitem_partkey", "cs_est"), orc.count_sketch_estimate("lineitem_partkey", FAM)
        ),
        "hh_error_report": Entry(q_hh("lineitem_partkey", "report"), orc.hh_error_report("lineitem_partkey", FAM, HH_K)),
        "hh_error_report_orderkey": Entry(
            q_hh("lineitem_orderkey", "report"), orc.hh_error_report("lineitem_orderkey", FAM, HH_K)
        ),
        "hh_summary": Entry(q_hh("lineitem_partkey", "summary"), orc.hh_summary("lineitem_partkey", FAM, HH_K)),
        "hh_listing": Entry(q_hh("lineitem_partkey", "listing"), orc.hh_listing("lineitem_partkey", FAM, HH_K)),
        "bounded_stream": Entry(q_bounded_stream, orc.bounded_stream("events", STREAM_T)),
        "bounded_hh_summary": Entry(q_bounded_hh_summary, orc.hh_summary("events", FAM, HH_K, bounded=STREAM_T)),
    }
    reg.update(sq.registry())
    return reg
