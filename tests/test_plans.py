"""Plan-shape guards: the properties that matter at scale, checked on the physical plans."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest
from support import SF001

from spindle.functions.hashing import hash_family
from spindle.operators import clustering as clu
from spindle.operators import sketch as sk
from spindle.operators import words as wc
from spindle.sources.points import embeddings_points, lineitem_points
from spindle.sources.text import documents, event_items, lineitem_items

FAM = hash_family(7, 100, seed=48)
C2 = [[1.0, 0.0], [10.0, 5.0], [30.0, 2.0], [45.0, 8.0]]


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def cases(spark):
    li = lineitem_points(spark, SF001)
    emb = embeddings_points(spark, SF001)
    items = lineitem_items(spark, SF001, "l_partkey")
    freq = sk.item_frequency(items)
    return {
        "residual_sums_2d": clu.residual_sums(li, C2),
        "residual_sums_64d": clu.residual_sums(emb, clu.first_k_centers(emb, 4)),
        "objectives": clu.objectives(li, C2),
        "cluster_stats": clu.cluster_stats(li, C2),
        "word_count": wc.word_count(documents(spark, SF001)),
        "word_count_salted": wc.word_count_salted(documents(spark, SF001), 8),
        "count_min_cells": sk.count_min_cells(items, FAM),
        "top_k": sk.top_k(freq, 20),
        "estimates": sk.estimates(
            sk.top_k(freq, 20), sk.sketch_from_freq(freq, FAM, "cm"), sk.sketch_from_freq(freq, FAM, "cs"), FAM, True
        ),
        "batch_sizes": sk.batch_sizes(event_items(spark, SF001), 300),
    }


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(df) for name, df in cases(spark).items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_every_exchange_of_an_aggregation_is_preceded_by_a_partial_aggregate(plans):
    for name in ("residual_sums_2d", "residual_sums_64d", "objectives", "word_count", "count_min_cells"):
        p = plans[name]
        assert re.search(r"Functions \[\d+\]: \[partial_", p), name


def test_scans_read_only_needed_columns(plans):
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in plans["residual_sums_2d"]
    assert "ReadSchema: struct<embedding:array<float>,label:int>" in plans["residual_sums_64d"]
    assert "ReadSchema: struct<text:string>" in plans["word_count"]
    assert "ReadSchema: struct<l_partkey:bigint>" in plans["count_min_cells"]
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plans["batch_sizes"]


def test_estimates_are_looked_up_without_join(plans):
    main = plans["estimates"].split("===== Subqueries =====")[0]
    assert "Join" not in plans["estimates"]
    assert "Generate" not in main  # the keys are not exploded


def test_larger_sketches_broadcast_only_their_tables(spark, monkeypatch):
    monkeypatch.setattr(sk, "ARRAY_SKETCH_CELLS", 10)
    p = plan(cases(spark)["estimates"])
    assert "SortMergeJoin" not in p
    # the two broadcast sides are the sketch tables (aggregations keyed by row, col)
    assert len(re.findall(r"^\(\d+\) BroadcastExchange", p, re.M)) == 2


def test_estimates_of_all_items_scan_the_input_once(spark):
    from spindle.plans.catalog import q_hh

    df = q_hh("lineitem_partkey", "cm_est")(spark, SF001)
    p = plan(df)
    assert "lineitem" not in p and "Scan parquet" not in p  # both the keys and the sketch read the stored histogram


def test_assignment_needs_no_join(plans):
    for name in ("residual_sums_2d", "residual_sums_64d", "objectives"):
        assert "Join" not in plans[name], name


@pytest.mark.parametrize("k, kernel", [(24, False), (25, True)])
def test_assignment_leaves_the_expression_before_its_size_slows_it(spark, k, kernel):
    """48 cells are written out in whole-stage codegen, 50 go to the Arrow kernel."""
    p = plan(clu.assign(lineitem_points(spark, SF001), [[float(i), float(i)] for i in range(k)]))
    assert ("MapInArrow" in p) is kernel
