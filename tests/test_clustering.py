from __future__ import annotations

import math
import os

import numpy as np
import pytest
from support import SF001, points_df
from pyspark.sql import functions as F

from spindle.functions import vectors as V
from spindle.operators import clustering as clu
from spindle.operators import fair
from spindle.sources.generate import synthetic_points
from spindle.sources.points import embeddings_points, read_points, write_points

F1 = [(0, [0, 0], "A"), (1, [2, 0], "A"), (2, [10, 0], "B"), (3, [10, 4], "B")]
C1 = [[1.0, 0.0], [10.0, 2.0]]


@pytest.mark.parametrize("strategy", ["unrolled", "lambda"])
def test_f1_objectives_and_stats(spark, strategy):
    p = points_df(spark, F1)
    a = clu.assign(p, C1, strategy).orderBy("id").collect()
    assert [r.ci for r in a] == [0, 0, 1, 1]
    assert [r.d2 for r in a] == [1.0, 1.0, 4.0, 4.0]
    o = clu.objectives(p, C1).first()
    assert (o.n, o.n_a, o.n_b) == (4, 2, 2)
    assert o.delta == 2.5 and o.phi == 4.0
    st = {r.ci: (r.n_a, r.n_b) for r in clu.cluster_stats(p, C1).collect()}
    assert st == {0: (2, 0), 1: (0, 2)}


def test_f1_phi_zero_without_b(spark):
    p = points_df(spark, F1[:2])
    assert clu.fair_objective(p, C1).first().phi == 0.0


@pytest.mark.parametrize("strategy", ["unrolled", "lambda"])
def test_f2_ties_go_to_lowest_index(spark, strategy):
    p = points_df(spark, [(0, [0, 0], "A")])
    r = clu.assign(p, [[1.0, 0.0], [-1.0, 0.0]], strategy).first()
    assert (r.ci, r.d2) == (0, 1.0)


def test_f3_one_group_clusters_keep_centres(spark):
    p = points_df(spark, F1)
    st = fair.fair_stats(p, C1)
    assert [c.ell for c in st.clusters] == [0.0, 0.0]
    assert st.clusters[0].mu_b == [1.0, 0.0] and st.clusters[1].mu_a == [10.0, 2.0]
    assert fair.fair_step(p, C1) == C1


@pytest.mark.parametrize(
    "fa,fb,x,rounds", [(0.0, 0.0, 1.0, 1), (4.0, 0.0, 0.001953125, 10), (0.0, 4.0, 1.998046875, 10)]
)
def test_f4_balance_single_cluster(fa, fb, x, rounds):
    got, r = fair.balance(fa, fb, [1.0], [1.0], [2.0])
    assert got == [x] and r == rounds


def test_f4_balance_two_clusters():
    got, r = fair.balance(1.0, 4.0, [1.0, 0.0], [0.0, 1.0], [0.0, 0.0])
    assert got == [0.0, 0.0] and r == 10


def test_f12_identical_points_kmeans_returns_fewer_centres(spark):
    p = points_df(spark, [(i, [3.0, 3.0], "A" if i % 2 else "B") for i in range(10)])
    cs = clu.kmeans(p, 5, 3)
    assert cs == [[3.0, 3.0]]


def test_empty_cluster_keeps_centre(spark):
    p = points_df(spark, F1)
    far = [[1.0, 0.0], [10.0, 2.0], [1000.0, 1000.0]]
    assert clu.lloyd_step(p, far)[2] == [1000.0, 1000.0]
    assert fair.fair_step(p, far)[2] == [1000.0, 1000.0]
    st = {r.ci: (r.n_a, r.n_b) for r in clu.cluster_stats(p, far).collect()}
    assert st[2] == (0, 0)


def test_third_label_rejected(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "pts.csv")
    with open(path, "w") as f:
        f.write("1.0,2.0,A\n3.0,4.0,C\n")
    with pytest.raises(Exception, match="A or B"):
        read_points(spark, path).collect()
    assert read_points(spark, path, mode="drop").count() == 1


def test_trailing_comma_line(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "pts.csv")
    with open(path, "w") as f:
        f.write("1.0,2.0,A\n1.0,2.0,\n5.5,x,B\n")
    with pytest.raises(Exception):
        read_points(spark, path).collect()
    rows = read_points(spark, path, mode="drop").collect()
    assert [(r.features, r.grp) for r in rows] == [([1.0, 2.0], "A")]


def test_read_points_any_dimension(spark, tmpdir_fresh):
    for name, text, features, groups in (
        ("two", "40.7267,-74.0345,B\n40.7383,-74.0403,A\n", [[40.7267, -74.0345], [40.7383, -74.0403]], ["B", "A"]),
        ("three", "1,2,3,A\n", [[1.0, 2.0, 3.0]], ["A"]),
        ("none", "", [], []),
    ):
        path = os.path.join(tmpdir_fresh, name)
        with open(path, "w") as f:
            f.write(text)
        rows = read_points(spark, path).collect()
        assert [r.features for r in rows] == features
        assert [r.grp for r in rows] == groups


@pytest.mark.parametrize("mode", ["failfast", "drop"])
def test_read_points_one_dimension_per_dataset(spark, tmpdir_fresh, mode):
    path = os.path.join(tmpdir_fresh, "pts.csv")
    bad = "" if mode == "failfast" else "x,1,A\n1,2,C\n1,2,3,4,\n"
    with open(path, "w") as f:
        f.write(bad + "40.7267,-74.0345,B\n40.7383,-74.0403,A\n1,2,3,A\n")
    mixed = read_points(spark, path, mode=mode)
    for df in (mixed, mixed.select("grp"), mixed.groupBy().count()):  # pruned columns too
        with pytest.raises(Exception, match="points of 2 coordinates expected, got: 1,2,3,A"):
            df.collect()
    assert read_points(spark, path, mode="drop", dim=2).count() == 2


def test_generator_split_and_round_trip(spark, tmpdir_fresh):
    g = synthetic_points(spark, 10000, 10)
    counts = {r.grp: r["count"] for r in g.groupBy("grp").count().collect()}
    assert counts == {"A": 7500, "B": 2500}
    out = os.path.join(tmpdir_fresh, "gen")
    write_points(g, out)
    back = read_points(spark, out)
    assert back.count() == 10000
    s1 = g.selectExpr("sum(features[0]) s").first().s
    s2 = back.selectExpr("sum(features[0]) s").first().s
    assert math.isclose(s1, s2, rel_tol=1e-9)


def _random_points(spark, n=300, dim=3, seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        g = "A" if rng.random() < 0.7 else "B"
        shift = 0.0 if g == "A" else 4.0
        rows.append((i, list(rng.normal(shift, 2.0, dim)), g))
    return points_df(spark, rows)


def test_invariants_on_random_points(spark):
    p = _random_points(spark)
    cs = clu.first_k_centers(p, 3)
    o = clu.objectives(p, cs).first()
    assert o.delta <= o.phi + 1e-12
    st = clu.cluster_stats(p, cs).collect()
    assert sum(r.n_a + r.n_b for r in st) == o.n
    fs = fair.fair_stats(p, cs)
    _, x = fair.step_from_stats(fs, cs)
    for c, xi in zip(fs.clusters, x):
        assert c is None or -1e-12 <= xi <= c.ell + 1e-12
    assert math.isclose(sum(c.alpha for c in fs.clusters if c), 1.0)
    assert math.isclose(sum(c.beta for c in fs.clusters if c), 1.0)


def test_strategies_and_sum_paths_agree(spark, monkeypatch):
    p = embeddings_points(spark, SF001)
    cs = clu.first_k_centers(p, 4)
    a = clu.assign(p, cs, "unrolled").orderBy("id").collect()
    b = clu.assign(p, cs, "lambda").orderBy("id").collect()
    assert [r.ci for r in a] == [r.ci for r in b]
    assert all(math.isclose(x.d2, y.d2, rel_tol=1e-12) for x, y in zip(a, b))
    s1 = fair.fair_step(p, cs)
    monkeypatch.setattr(clu, "UNROLL_DIM", 0)
    s2 = fair.fair_step(p, cs)
    assert all(math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12) for c1, c2 in zip(s1, s2) for u, v in zip(c1, c2))


def test_single_pass_scatter_equals_two_pass(spark):
    p = _random_points(spark, dim=2, seed=3)
    cs = clu.first_k_centers(p, 3)
    st = fair.fair_stats(p, cs)
    rows = clu.assign(p, cs).collect()
    two = {"A": 0.0, "B": 0.0}
    for r in rows:
        c = st.clusters[r.ci]
        mu = c.mu_a if r.grp == "A" else c.mu_b
        two[r.grp] += sum((u - v) ** 2 for u, v in zip(r.features, mu))
    assert math.isclose(st.fixed_a, two["A"] / st.size_a, rel_tol=1e-9)
    assert math.isclose(st.fixed_b, two["B"] / st.size_b, rel_tol=1e-9)


def test_fair_vs_standard_kmeans_init(spark):
    p = embeddings_points(spark, SF001)
    summary, std, fc = fair.fair_vs_standard(p, 4, 2)
    r = summary.first()
    assert r.n == 500 and r.n_a + r.n_b == 500
    assert len(std) <= 4 and len(fc) == len(fair.fair_lloyd(p, 4, 0))
    assert r.phi_standard > 0 and r.phi_fair > 0


def test_seeding_does_not_depend_on_the_layout(spark):
    p = embeddings_points(spark, SF001)
    one = clu.kmeans_init(p, 4)
    assert one == clu.kmeans_init(p.repartition(7), 4) and len(one) == 4
    assert one != clu.kmeans_init(p, 4, seed=7)
    assert clu.initial_centers(p, 4, one) == one
    with pytest.raises(ValueError, match="unknown init"):
        clu.initial_centers(p, 4, "other")


def test_seeding_edge_cases(spark):
    schema = "id BIGINT, features ARRAY<DOUBLE>, grp STRING"
    same = spark.createDataFrame([(i, [1.0, 2.0], "A") for i in range(6)], schema)
    assert clu.kmeans_init(same, 3) == [[1.0, 2.0]]
    assert clu.kmeans_init(same.limit(0), 3) == []
    no_id = spark.createDataFrame([(None, [float(i)], "B") for i in range(20)], schema)
    cs = clu.kmeans_init(no_id, 3)
    assert cs == clu.kmeans_init(no_id.drop("id"), 3) and len({c[0] for c in cs}) == len(cs) == 3


def test_centre_size_bounds(monkeypatch):
    assert V.choose_strategy([[0.0] * 2] * 4) == "unrolled"
    assert V.choose_strategy([[0.0] * 64] * 4) == "arrow"
    assert V.choose_strategy([[0.0] * 64] * 4, "lambda") == "lambda"
    assert V.dlit(float("nan")).startswith("CAST") and V.dlit(1e-05) == "1e-05D"
    monkeypatch.setattr(V, "MAX_BROADCAST_CELLS", 100)
    assert V.choose_strategy([[0.0] * 10] * 11) == "chunked"  # beyond one broadcast: blocks, not an error
    with pytest.raises(ValueError):
        V.check_centers([[0.0] * 10, [0.0] * 9])


def test_arrow_path_agrees(spark, monkeypatch):
    p = embeddings_points(spark, SF001)
    cs = clu.first_k_centers(p, 4)
    a = clu.assign(p, cs, "lambda").orderBy("id").collect()
    b = clu.assign(p, cs, "arrow").orderBy("id").collect()
    assert [r.ci for r in a] == [r.ci for r in b]
    assert all(math.isclose(x.d2, y.d2, rel_tol=1e-9) for x, y in zip(a, b))
    monkeypatch.setattr(V, "UNROLL_CELLS", 10**6)
    o1 = clu.objectives(p, cs).first()
    s1 = fair.fair_step(p, cs)
    monkeypatch.setattr(V, "UNROLL_CELLS", 0)
    o2 = clu.objectives(p, cs).first()
    s2 = fair.fair_step(p, cs)
    assert (o1.n, o1.n_a, o1.n_b) == (o2.n, o2.n_a, o2.n_b)
    assert math.isclose(o1.phi, o2.phi, rel_tol=1e-9)
    assert all(math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12) for c1, c2 in zip(s1, s2) for u, v in zip(c1, c2))
    f1 = points_df(spark, F1)
    assert clu.assign(f1, C1, "arrow").orderBy("id").select("ci").collect() == [(0,), (0,), (1,), (1,)]
    st = {r.ci: (r.n_a, r.n_b) for r in clu.cluster_stats(f1, C1).collect()}
    assert st == {0: (2, 0), 1: (0, 2)}


def test_explicit_partitions_give_the_same_centres(spark):
    p = _random_points(spark, dim=2, seed=11)
    cs = clu.first_k_centers(p, 3)
    a = fair.fair_lloyd(p, 3, 2, init=cs)
    b = fair.fair_lloyd(p, 3, 2, init=cs, partitions=5)
    assert all(math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12) for c1, c2 in zip(a, b) for u, v in zip(c1, c2))
    rep = clu.clustering_report(p, 3, 2, init=cs, partitions=3)
    assert rep.summary.first().n == 300 and rep.stats.count() == 3


def test_objectives_many_equals_one_by_one(spark):
    p = embeddings_points(spark, SF001)
    c1 = clu.first_k_centers(p, 1)  # 64 cells: JVM expression
    c4 = clu.first_k_centers(p, 4)  # 256 cells: Arrow kernel
    c3 = clu.first_k_centers(p, 3, ["features"])
    many = clu.objectives_many(p, [c1, c4, c3])
    for cs, got in zip([c1, c4, c3], many):
        o = clu.objectives(p, cs).first()
        assert got[:3] == (o.n, o.n_a, o.n_b)
        assert math.isclose(got[3], o.delta, rel_tol=1e-9) and math.isclose(got[4], o.phi, rel_tol=1e-9)


def test_seeded_lloyd_with_tol_is_spark_ml_kmeans(spark):
    p = embeddings_points(spark, SF001).repartition(4).cache()
    ml = clu.kmeans(p, 4, 3)
    ours = clu.lloyd(p, clu.kmeans(p, 4, 0), 3, tol=1e-4)
    assert len(ml) == len(ours)
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for c1, c2 in zip(sorted(ml), sorted(ours)) for a, b in zip(c1, c2))
    p.unpersist()


def test_chunked_centre_sets_agree(spark, monkeypatch):
    """Centre sets beyond one broadcast are split into blocks; results equal the single-broadcast path."""
    p = embeddings_points(spark, SF001)
    cs = clu.first_k_centers(p, 5)
    a = clu.assign(p, cs, "arrow").orderBy("id").collect()
    o1 = clu.objectives(p, cs).first()
    f1 = fair.fair_step(p, cs)
    l1 = clu.lloyd_step(p, cs)
    monkeypatch.setattr(V, "MAX_BROADCAST_CELLS", 2 * 64)  # two centres per block: three blocks
    assert V.choose_strategy(cs) == "chunked"
    b = clu.assign(p, cs).orderBy("id").collect()
    assert [r.ci for r in a] == [r.ci for r in b]
    assert all(math.isclose(x.d2, y.d2, rel_tol=1e-12) for x, y in zip(a, b))
    o2 = clu.objectives_many(p, [cs])[0]
    assert o2[:3] == (o1.n, o1.n_a, o1.n_b) and math.isclose(o2[4], o1.phi, rel_tol=1e-9)
    f2 = fair.fair_step(p, cs)
    l2 = clu.lloyd_step(p, cs)
    for s1, s2 in ((f1, f2), (l1, l2)):
        assert all(math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-12) for c1, c2 in zip(s1, s2) for u, v in zip(c1, c2))


def test_round_broadcasts_are_released(spark, monkeypatch):
    p = embeddings_points(spark, SF001)
    cs = clu.first_k_centers(p, 4)  # 256 cells: Arrow path, one broadcast per round
    released = []
    real = clu._broadcast

    def tracking(session, value):
        bc = real(session, value)
        orig = bc.unpersist
        bc.unpersist = lambda blocking=False: (released.append(bc), orig(blocking))[1]
        return bc

    monkeypatch.setattr(clu, "_broadcast", tracking)
    fair.fair_step(p, cs)
    clu.objectives_many(p, [cs, cs])
    assert len(released) == 2 and clu._BROADCAST_SCOPES == []


def test_failfast_without_ansi(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "pts.csv")
    with open(path, "w") as f:
        f.write("1.0,2.0,A\n5.5,x,B\n")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="malformed coordinate"):
            read_points(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


# ---------------------------------------------------------------------------------------------------------------
# One answer for every centre-set size, and checks that cannot be pruned away
# ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("offset", [0.0, 1e6, 1.7e9])
def test_every_strategy_gives_the_same_assignment(spark, monkeypatch, offset):
    import numpy as np

    rng = np.random.default_rng(int(offset) % 97)
    grid = rng.integers(-3, 4, (60, 2)).astype(float) + offset  # many exact ties
    centers = [list(map(float, c)) for c in rng.integers(-3, 4, (12, 2)).astype(float) + offset]
    centers += [centers[3], [offset, offset], [offset + 1e5, offset]]  # duplicates, and one far away
    rows = [(i, list(map(float, x)), "AB"[i % 2]) for i, x in enumerate(grid)]
    df = spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>, grp STRING")
    want = []
    for i, x, _ in rows:
        d = [sum((a - b) * (a - b) for a, b in zip(x, c)) for c in centers]
        want.append((i, d.index(min(d)), min(d)))
    monkeypatch.setattr(clu.V, "MAX_BROADCAST_CELLS", 8)
    for strategy in ("unrolled", "lambda", "arrow", "chunked"):
        got = sorted((r["id"], r["ci"], r["d2"]) for r in clu.assign(df, centers, strategy).collect())
        assert got == want, strategy


def test_blockwise_sums_do_not_cancel(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(2) + (i % 2) * 1e7], "AB"[i % 3 % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>, grp STRING")
    centers = [[0.5, 0.5], [1e7, 1e7]]
    want = sorted(clu.collect_residual_sums(df, centers))
    monkeypatch.setattr(clu.V, "UNROLL_CELLS", 1)
    monkeypatch.setattr(clu.V, "MAX_BROADCAST_CELLS", 2)
    got = sorted(clu.collect_residual_sums(df, centers))
    for (ci, g, n, s, q), (ci2, g2, n2, s2, q2) in zip(got, want, strict=True):
        assert (ci, g, n) == (ci2, g2, n2)
        assert q == pytest.approx(q2, rel=1e-9) and s == pytest.approx(s2, rel=1e-6, abs=1e-6)


def test_a_vector_of_another_length_fails_on_every_path(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], "A")], "id BIGINT, features ARRAY<DOUBLE>, grp STRING")
    for strategy in ("unrolled", "arrow"):
        with pytest.raises(Exception, match="coordinates"):
            clu.assign(df, [[1.0, 2.0]], strategy).select("ci").collect()


@pytest.mark.parametrize("line", ["1.0,x,A", "1.0,2.0,C", "1.0,NaN,A", "Infinity,2.0,B", "A", "1.0,2.0,", "1.0,2.0,3.0,A"])
def test_bad_point_lines_fail_or_drop_whatever_is_read(spark, line):
    from spindle.sources.points import parse_point_lines

    lines = spark.createDataFrame([("1.0,2.0,A",), (line,), ("3.0,4.0,B",)], "value STRING")
    for columns in (["features"], ["grp"], ["id"]):
        with pytest.raises(Exception, match="malformed|must be A or B"):
            parse_point_lines(lines, dim=2).select(*columns).collect()
        assert parse_point_lines(lines, mode="drop", dim=2).select(*columns).count() == 2
    with pytest.raises(Exception, match="malformed|must be A or B"):
        clu.group_counts(parse_point_lines(lines, dim=2)).collect()


@pytest.mark.parametrize("row", [([1.0, float("nan")], "A"), ([1.0, None], "A"), (None, "A"), ([], "B"), ([1.0], "C"), ([1.0], None)])
def test_bad_table_points_fail_whatever_is_read(spark, row):
    from spindle.sources.points import points_from_table

    df = spark.createDataFrame([([1.0], "A"), row], "x ARRAY<DOUBLE>, g STRING")
    for columns in (["features"], ["grp"]):
        with pytest.raises(Exception, match="finite numbers|must be A or B"):
            points_from_table(df, F.col("x"), F.col("g")).select(*columns).collect()


# Large centre sets -------------------------------------------------------------------------------------------------


def _brute(x, c):
    """Every direct distance, the lowest index on ties."""
    import numpy as np

    d2 = np.zeros((len(x), len(c)))
    for j in range(x.shape[1]):
        d2 += (x[:, None, j] - c[None, :, j]) ** 2
    return d2.argmin(axis=1), d2.min(axis=1)


@pytest.mark.parametrize("kind", ["mixture", "uniform", "grid", "far", "copies", "line"])
def test_centre_tree_equals_brute_force(kind):
    """Structured, structureless, tied, shifted, duplicate and degenerate centre sets; the answer is the same bit for bit."""
    import numpy as np

    from spindle.functions import arrow_kernels as ak

    rng = np.random.default_rng(5)
    c = rng.standard_normal((900, 5)) * 4
    x = c[rng.integers(0, 900, 3000)] + rng.standard_normal((3000, 5)) * 0.3
    if kind == "uniform":
        x = rng.standard_normal((3000, 5)) * 6
    elif kind == "grid":
        c, x = rng.integers(-2, 3, (900, 5)).astype(float), rng.integers(-3, 4, (3000, 5)) / 2
    elif kind == "far":
        c, x = c + 1.7e9, x + 1.7e9
    elif kind == "copies":
        c[450:] = c[:450]
        x[:5] = [np.nan, np.inf, -np.inf, 0, 1]
    elif kind == "line":
        c[:, 1:] = 0.0
    want = _brute(x[5:], c)
    tree = ak.CenterTree(c)
    assert sorted(np.concatenate(tree.leaves)) == list(range(900)) and max(map(len, tree.leaves)) <= 64
    got, plain = ak.nearest_block(x, tree), ak.nearest_block(x, c)
    assert (got[0] == plain[0]).all() and ((got[1] == plain[1]) | np.isnan(got[1])).all()
    assert (got[0][5:] == want[0]).all() and (got[1][5:] == want[1]).all()


def test_centre_tree_rules_out_most_distances():
    """Points near their centres settle within their leaf, whatever the dimension."""
    import numpy as np

    from spindle.functions.arrow_kernels import CenterTree

    rng = np.random.default_rng(6)
    c = rng.standard_normal((2000, 32))
    tree = CenterTree(c)
    row, _, whole = tree.shortlist(c[rng.integers(0, 2000, 1000)] + rng.standard_normal((1000, 32)) * 0.02)
    assert len(whole) < 100 and len(row) < 1300


@pytest.mark.parametrize("by_group", [False, True])
def test_bounds_between_rounds_change_nothing(spark, monkeypatch, by_group):
    """Same centres after every number of rounds, with ties, duplicates and an empty cluster; most distances are skipped."""
    import numpy as np

    from spindle.operators import fair

    rng = np.random.default_rng(7)
    mids = rng.standard_normal((40, 3)) * 8
    x = np.concatenate([mids[rng.integers(0, 40, 2400)] + rng.standard_normal((2400, 3)) * 0.4, np.repeat(mids[:4], 50, axis=0)])
    rows = [(i, list(map(float, v)), "AB"[int(g)]) for i, (v, g) in enumerate(zip(x, rng.random(len(x)) < 0.4))]
    df = spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>, grp STRING").repartition(3).cache()
    start = [list(map(float, v)) for v in [*(mids + 0.6), mids[3] + 0.6, np.full(3, 1e6)]]
    run = (lambda **o: fair.fair_lloyd(df, 0, 6, init=start, **o)) if by_group else (lambda **o: clu.lloyd(df, start, 6, **o))
    trace: list = []
    with_bounds, plain = run(bounds=True, trace=trace), run(bounds=False)
    assert with_bounds == plain
    assert len(trace) == 6 and all(n == 2600 and a + b == 2600 * 42 for n, a, b in trace)
    assert sum(skipped for _, _, skipped in trace[2:]) > 0.6 * 4 * 2600 * 42
    monkeypatch.setattr(clu, "RENEW", 0.0)  # a new reference every other round
    assert run(bounds=True) == plain
    df.unpersist()


def test_seeding_does_not_depend_on_the_layout(spark):
    """Each point keeps its nearest candidate so far; the seeds are those of all candidates at once, in any layout."""
    rows = [(i, [float(i * i % 101), float(i % 17)], "AB"[i % 2]) for i in range(500)]
    df = spark.createDataFrame(rows, "id BIGINT, features ARRAY<DOUBLE>, grp STRING")
    seeds = clu.kmeans_init(df.repartition(1), 5, init_steps=4)
    assert len(seeds) == 5
    assert clu.kmeans_init(df.repartition(7), 5, init_steps=4) == seeds
    assert clu.kmeans_init(df.orderBy(F.desc("id")), 5, init_steps=4) == seeds
    assert clu.kmeans_init(df.where("id < 1"), 5) == [[0.0, 0.0]]
    assert clu.kmeans_init(df.withColumn("features", F.array(F.lit(1.0), F.lit(2.0))), 3) == [[1.0, 2.0]]
    assert clu.kmeans_init(df.limit(0), 3) == []
