from __future__ import annotations

import random

import pytest
from support import SF001, SF01
from pyspark.sql import functions as F

from spindle.functions.hashing import HashFamily, HashRow, hash_col, hash_family
from spindle.operators import sketch as sk
from spindle.sources.text import event_items, lineitem_items, parse_items


def lines(spark, values, batch=None):
    if batch is None:
        return parse_items(spark.createDataFrame([(v,) for v in values], "value STRING"))
    return parse_items(spark.createDataFrame(list(zip(values, batch)), "value STRING, batch INT"))


def test_f6_item_parsing(spark):
    vals = ["5", "+5", " 5", "5.0", "x", "9223372036854775808", "-7", "5\n"]
    got = [r.item for r in lines(spark, vals).collect()]
    assert got == [5, 5, None, None, None, None, -7, None]


F7 = ["5", "5", "5", "7", "7", "9", "9", "x"]


def test_f7_heavy_hitters_keep_ties(spark):
    items = lines(spark, F7)
    fam = hash_family(3, 10)
    hh = sk.heavy_hitters(items, fam, 2)
    s = hh.summary.first()
    assert (s.processed, s.n_distinct, s.n_top) == (8, 3, 3)
    assert sorted(r.item for r in hh.top.collect()) == [5, 7, 9]
    freq = sk.item_frequency(items)
    assert freq.select(sk.kth_frequency(freq, 2).alias("t")).first().t == 2


F8_FAM = HashFamily((HashRow(0, 1, 0, 1, 0, 1, 0),), width=2)


def test_f8_count_min(spark):
    items = lines(spark, F7)
    cm = {(r.row, r.col): r.v for r in sk.count_min_cells(items, F8_FAM).collect()}
    assert cm == {(0, 1): 7}
    rep = {r.item: r for r in sk.heavy_hitters(items, F8_FAM, 2).report.collect()}
    assert {i: r.est_cm for i, r in rep.items()} == {5: 7, 7: 7, 9: 7}
    assert rep[5].err_cm == pytest.approx(4 / 3) and rep[7].err_cm == pytest.approx(5 / 2)
    avg = sk.heavy_hitters(items, F8_FAM, 2).summary.first().avg_err_cm
    assert avg == pytest.approx((4 / 3 + 5 / 2 + 5 / 2) / 3)


def test_f9_count_sketch_upper_median_for_even_depth(spark):
    fam = HashFamily((HashRow(0, 1, 0, 1, 0, 1, 1), HashRow(1, 1, 0, 1, 1, 1, 1)), width=4)
    cs = spark.createDataFrame([(0, 0, 1), (1, 1, 3)], "row INT, col BIGINT, v BIGINT")
    keys = spark.createDataFrame([(0,)], "item BIGINT")
    assert sk.count_sketch_estimate(keys, cs, fam).first().est_cs == 3


def test_f10_items_equal_mod_p_collide(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(1,), (8192,)], "x BIGINT")
    for _ in range(5):
        a, b = rng.randint(1, 8190), rng.randint(0, 8190)
        got = [r.h for r in df.select(hash_col(F.col("x"), a, b, 100).alias("h")).collect()]
        assert got[0] == got[1]


def test_f11_bounded_batches(spark):
    items = lines(spark, ["1"] * 12, [0] * 3 + [1] * 4 + [2] * 5)
    sizes = sk.batch_sizes(items, 6).orderBy("batch").collect()
    assert [(r.batch, r.size, r.before) for r in sizes] == [(0, 3, 0), (1, 4, 3)]
    assert sk.bounded_items(items, 6).count() == 7


def test_f11_events_by_day(spark):
    items = event_items(spark, SF01)
    assert sk.batch_sizes(items, 5000).count() == 16
    assert sk.bounded_items(items, 5000).count() == 5320


def test_count_min_invariants(spark):
    items = lineitem_items(spark, SF001, "l_partkey")
    fam = hash_family(5, 50, seed=3)
    n_valid = sk.valid(items).count()
    rows = sk.count_min_cells(items, fam).groupBy("row").agg(F.sum("v").alias("s")).collect()
    assert all(r.s == n_valid for r in rows) and len(rows) == 5
    est = sk.count_min_estimate(sk.valid(items), sk.count_min_cells(items, fam), fam)
    bad = est.join(sk.item_frequency(items), "item").where(F.col("est_cm") < F.col("n")).count()
    assert bad == 0


def test_empty_stream_and_large_k(spark):
    empty = lines(spark, [])
    hh = sk.heavy_hitters(empty, hash_family(3, 10), 5)
    assert hh.top.count() == 0
    s = hh.summary.first()
    assert s.processed == 0 and s.n_top == 0 and s.avg_err_cm is None
    few = lines(spark, ["1", "2", "2"])
    assert sk.heavy_hitters(few, hash_family(3, 10), 10).top.count() == 2


def test_hash_family_is_seeded():
    assert hash_family(7, 100, seed=48) == hash_family(7, 100, seed=48)
    fam = hash_family(7, 100, seed=48)
    assert all(1 <= r.a_cm <= 8190 and 0 <= r.b_cm <= 8190 for r in fam.rows)


def test_top_k_size_invariant(spark):
    items = lineitem_items(spark, SF001, "l_orderkey")
    freq = sk.item_frequency(items)
    distinct = freq.count()
    for k in (1, 5, 50, distinct + 10):
        top = sk.top_k(freq, k)
        assert top.count() >= min(k, distinct)
        kth = freq.select(sk.kth_frequency(freq, k).alias("t")).first().t
        assert top.agg(F.min("n")).first()[0] == kth


def skewed_items(spark, seed):
    """60 items with many copies, two of them tied, among thousands that occur a few times; some lines do not parse."""
    rng = random.Random(seed)
    many = [i for i in range(60) for _ in range(40 + 10 * (i // 2))]
    rows = many + [rng.randrange(1000, 9000) for _ in range(6000)] + [None] * 50
    rng.shuffle(rows)
    return spark.createDataFrame([(r,) for r in rows], "item BIGINT").repartition(7)


@pytest.mark.parametrize("capacity", [1, 20, 400, 10_000])
def test_frequent_summary_bounds(spark, capacity):
    items = skewed_items(spark, 3)
    exact = {r.item: r.n for r in sk.item_frequency(items).collect()}
    rows = sk.frequent_summary(items, capacity).collect()
    low = {r.item: r.low for r in rows if r.item is not None}
    (error,) = [r.err for r in rows if r.item is None]
    assert error <= sum(exact.values()) / (capacity + 1)
    assert all(low.get(i, 0) <= n <= low.get(i, 0) + error for i, n in exact.items())
    assert (error == 0) == (capacity == 10_000)


@pytest.mark.parametrize(("capacity", "k"), [(1, 5), (20, 5), (400, 1), (400, 5), (400, 7), (10_000, 5), (400, 20_000)])
def test_top_k_items_equals_histogram(spark, capacity, k, monkeypatch):
    items = skewed_items(spark, capacity + k)
    expect = sorted(map(tuple, sk.top_k(sk.item_frequency(items), k).collect()))
    for limit in (sk.BROADCAST_CANDIDATES, 0):
        monkeypatch.setattr(sk, "BROADCAST_CANDIDATES", limit)
        assert sorted(map(tuple, sk.top_k_items(items, k, capacity).collect())) == expect


def test_top_k_items_recounts_candidates_only(spark, monkeypatch):
    items = skewed_items(spark, 9)
    seen = []
    build = sk.item_frequency
    monkeypatch.setattr(sk, "item_frequency", lambda df: seen.append(build(df)) or seen[-1])
    top = sorted(r.item for r in sk.top_k_items(items, 5, 400).collect())
    assert top == [54, 55, 56, 57, 58, 59]  # the third pair ties at the fifth place
    assert seen[0].count() < 200  # of some 4,000 distinct items


def test_top_k_items_of_nothing(spark):
    for rows in ([], [(None,)] * 5):
        assert sk.top_k_items(spark.createDataFrame(rows, "item BIGINT"), 3).count() == 0
    with pytest.raises(ValueError):
        sk.top_k_items(spark.createDataFrame([], "item BIGINT"), 0)


@pytest.mark.parametrize("kind", ["INT", "BIGINT", "DATE", "TIMESTAMP", "STRING"])
def test_running_total_in_blocks(spark, kind, monkeypatch):
    monkeypatch.setattr(sk, "TOTAL_BLOCK", 4)
    rng = random.Random(8)
    n = {b: rng.randrange(1, 9) for b in range(-20, 40)}
    lines_ = [(b, 1) for b, c in n.items() for _ in range(c)] + [(None, 1)] * 3
    items = spark.createDataFrame(lines_, "b INT, item BIGINT")
    day = F.date_add(F.lit("2024-01-31").cast("date"), F.col("b"))
    batch = {"DATE": day, "TIMESTAMP": day.cast("timestamp"), "STRING": F.format_string("%04d", F.col("b") + 100)}
    key = F.when(F.col("b").isNotNull(), batch.get(kind, F.col("b").cast("string"))).cast(kind)
    items = items.select("item", key.alias("batch"))
    order = sorted(n)
    before, expect = 3, [(3, 0)]
    for b in order:
        if before < 150:
            expect.append((n[b], before))
        before += n[b]
    got = sk.batch_sizes(items, 150).orderBy(F.col("batch").asc_nulls_first()).collect()
    assert [(r["size"], r["before"]) for r in got] == expect
    assert sk.batch_sizes(items, 0).count() == 0


def test_large_sketches_are_joined_without_broadcast(spark, monkeypatch):
    items = lineitem_items(spark, SF001, "l_partkey")
    fam = hash_family(3, 50, seed=5)
    hh = sk.heavy_hitters(items, fam, 5)
    expect = sorted(tuple(r) for r in hh.report.collect())
    for limit in ("ARRAY_SKETCH_CELLS", "BROADCAST_SKETCH_CELLS"):  # array, then broadcast join, then shuffle join
        monkeypatch.setattr(sk, limit, 10)
        hh2 = sk.heavy_hitters(items, fam, 5)
        assert sorted(tuple(r) for r in hh2.report.collect()) == expect
