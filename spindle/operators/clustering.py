"""Nearest-centre assignment, clustering objectives, per-cluster statistics and k-means.

Every operator here is one pass over the points: the centre set is a literal in the plan (K x dim doubles, a user
parameter), so assignment is a map-side projection, and every statistic is a single hash aggregation whose
partial (map-side) stage emits at most one row per (cluster, group) per task.  A cluster or group that holds a
third of all points therefore costs nothing extra in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from spindle.functions import vectors as V
from spindle.functions.vectors import Centers, centers_sql, check_centers, choose_strategy, with_nearest
from spindle.session import spread
from spindle.sources.points import GROUP_A, GROUP_B

# Largest dimension summed with one SUM per coordinate; above it the vector sums go through Spark ML's Summarizer
# (measured at 64 dimensions: 4x faster per round on small inputs, on par at 1M rows).
UNROLL_DIM = 8


def as_centers(centers: Centers) -> list[list[float]]:
    return [[float(x) for x in c] for c in centers]


def _kernels():
    """The Arrow kernel module, pickled by value so that executors need only numpy and pyarrow."""
    from pyspark import cloudpickle

    from spindle.functions import arrow_kernels, center_tree

    cloudpickle.register_pickle_by_value(center_tree)
    cloudpickle.register_pickle_by_value(arrow_kernels)
    return arrow_kernels


# Centre sets of this size come with a search tree.
TREE_CENTERS = 512


def _center_set(cs: list[list[float]]):
    """What the kernels take: a matrix of the centres, or the parts of a tree over them."""
    import numpy as np

    c = np.asarray(cs, dtype=np.float64)
    kernels = _kernels()
    return vars(kernels.CenterTree(c)) if len(c) >= TREE_CENTERS and np.isfinite(c).all() else c


# Centre broadcasts created inside open _released_broadcasts scopes (one list per scope).
_BROADCAST_SCOPES: list[list] = []


def _broadcast(spark, value):
    bc = spark.sparkContext.broadcast(value)
    if _BROADCAST_SCOPES:
        _BROADCAST_SCOPES[-1].append(bc)
    return bc


def _broadcast_centers(spark, cs: list[list[float]]):
    return _broadcast(spark, _center_set(cs))


@contextmanager
def _released_broadcasts():
    """Unpersist the centre broadcasts created inside the block once its result has been collected, so that an
    iterative job does not leave one copy per round on every executor.  Outside a scope (a lazy DataFrame handed
    to the caller) broadcasts are left to Spark's cleaner."""
    _BROADCAST_SCOPES.append([])
    try:
        yield
    finally:
        for bc in _BROADCAST_SCOPES.pop():
            bc.unpersist(blocking=False)


def _chunks(cs: list[list[float]]) -> list[tuple[int, list[list[float]]]]:
    """Consecutive centre blocks of at most one broadcast each, with the index of their first centre."""
    per = max(1, V.MAX_BROADCAST_CELLS // len(cs[0]))
    return [(start, cs[start : start + per]) for start in range(0, len(cs), per)]


def _arrow_assign(points: DataFrame, cs: list[list[float]], chunked: bool) -> DataFrame:
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    assign_batches = _kernels().assign_batches
    parts = _chunks(cs) if chunked else [(0, cs)]
    df, names = points, []
    for n, (start, block) in enumerate(parts):
        bc = _broadcast_centers(points.sparkSession, block)
        nm = ("ci", "d2") if len(parts) == 1 else (f"_ci{n}", f"_d2{n}")
        extra = [StructField(nm[0], IntegerType(), False), StructField(nm[1], DoubleType(), False)]
        schema = StructType([*df.schema.fields, *extra])
        df = df.mapInArrow(lambda it, bc=bc, nm=nm, start=start: assign_batches(it, bc.value, nm, start), schema)
        names.append(nm)
    if len(parts) == 1:
        return df
    # Nearest over all centres = least (d2, ci) over the blocks' nearest: same lowest-index rule on ties.
    best = F.least(*[F.struct(F.col(d).alias("d2"), F.col(c).alias("ci")) for c, d in names])
    return df.withColumn("_best", best).select(
        *[F.col(c) for c in points.columns], F.col("_best.ci").alias("ci"), F.col("_best.d2").alias("d2")
    )


def assign(points: DataFrame, centers: Centers, strategy: str = "auto") -> DataFrame:
    """Points plus ``ci INT`` (nearest centre, lowest index on ties) and ``d2 DOUBLE`` (squared distance)."""
    cs = as_centers(centers)
    chosen = choose_strategy(cs, strategy)
    if chosen in ("arrow", "chunked"):
        return _arrow_assign(points, cs, chunked=chosen == "chunked")
    return with_nearest(points, "features", cs, "_nn", strategy).select(
        *[F.col(c) for c in points.columns], F.col("_nn.ci").alias("ci"), F.col("_nn.d2").alias("d2")
    )


def _objective_aggs() -> list[Column]:
    is_a = F.col("grp") == F.lit(GROUP_A)
    is_b = F.col("grp") == F.lit(GROUP_B)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_a).alias("n_a"),
        F.count_if(~is_a).alias("n_b"),
        F.sum("d2").alias("sum_d2"),
        F.sum(F.when(is_a, F.col("d2"))).alias("sum_d2_a"),
        F.sum(F.when(is_b, F.col("d2"))).alias("sum_d2_b"),
    ]


def _phi(sum_a: Column, n_a: Column, sum_b: Column, n_b: Column) -> Column:
    """max of the two group means; 0 when either group is empty."""
    return F.when((n_a == 0) | (n_b == 0), F.lit(0.0)).otherwise(
        F.greatest(F.try_divide(sum_a, n_a.cast("double")), F.try_divide(sum_b, n_b.cast("double")))
    )


def objectives(points: DataFrame, centers: Centers) -> DataFrame:
    """One row: ``n, n_a, n_b, delta, phi`` -- sizes, standard objective Δ and fair objective Φ, in one job."""
    agg = assign(points, centers).agg(*_objective_aggs())
    return agg.select(
        "n",
        "n_a",
        "n_b",
        F.try_divide(F.col("sum_d2"), F.col("n").cast("double")).alias("delta"),
        _phi(F.col("sum_d2_a"), F.col("n_a"), F.col("sum_d2_b"), F.col("n_b")).alias("phi"),
    )


def objectives_many(points: DataFrame, center_sets: Sequence[Centers]) -> list:
    """``[(n, n_a, n_b, delta, phi)]`` for several centre sets from one pass over the points (one job).

    Sets small enough for plan literals become JVM expressions; all others share one Arrow kernel call."""
    with _released_broadcasts():
        return _objectives_many(points, center_sets)


def _objectives_many(points: DataFrame, center_sets: Sequence[Centers]) -> list:
    sets = [as_centers(c) for c in center_sets]
    df = points.select("features", "grp")
    kinds = [choose_strategy(cs) for cs in sets]
    arrow = [i for i, kind in enumerate(kinds) if kind == "arrow"]
    for i, cs in enumerate(sets):
        if kinds[i] == "chunked":
            df = assign(df, cs, "chunked").withColumnRenamed("d2", f"_d2_{i}").drop("ci")
        elif kinds[i] != "arrow":
            df = with_nearest(df, "features", cs, f"_nn{i}").withColumn(f"_d2_{i}", F.col(f"_nn{i}.d2")).drop(f"_nn{i}")
    if arrow:
        from pyspark.sql.types import DoubleType, StructField, StructType

        distance_batches = _kernels().distance_batches
        bc = _broadcast(points.sparkSession, [_center_set(sets[i]) for i in arrow])
        names = [f"_d2_{i}" for i in arrow]
        schema = StructType([*df.schema.fields, *[StructField(n, DoubleType(), False) for n in names]])
        df = df.mapInArrow(lambda it: distance_batches(it, bc.value, names), schema)
    is_a = F.col("grp") == F.lit(GROUP_A)
    is_b = F.col("grp") == F.lit(GROUP_B)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(is_a).alias("n_a")]
    for i in range(len(center_sets)):
        d2 = F.col(f"_d2_{i}")
        aggs += [F.sum(d2).alias(f"s{i}"), F.sum(F.when(is_a, d2)).alias(f"a{i}"), F.sum(F.when(is_b, d2)).alias(f"b{i}")]
    r = df.agg(*aggs).first()
    n, n_a = r["n"], r["n_a"]
    n_b = n - n_a
    out = []
    for i in range(len(center_sets)):
        delta = r[f"s{i}"] / n if n else None
        phi = 0.0 if n_a == 0 or n_b == 0 else max(r[f"a{i}"] / n_a, r[f"b{i}"] / n_b)
        out.append((n, n_a, n_b, delta, phi))
    return out


def standard_objective(points: DataFrame, centers: Centers) -> DataFrame:
    """Δ(U, C): mean squared distance of every point to its nearest centre."""
    return objectives(points, centers).select("delta")


def fair_objective(points: DataFrame, centers: Centers) -> DataFrame:
    """Φ(A, B, C) = max(Σ_A d²/|A|, Σ_B d²/|B|), or 0 when a group is empty."""
    return objectives(points, centers).select("phi")


def group_counts(points: DataFrame) -> DataFrame:
    """One row: N, N_A and N_B = N - N_A."""
    is_a = F.col("grp") == F.lit(GROUP_A)
    return points.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_a).alias("n_a"), F.count_if(~is_a).alias("n_b"))


def cluster_stats(points: DataFrame, centers: Centers) -> DataFrame:
    """``(ci, center, n_a, n_b)`` for every centre, including centres that attract no point."""
    cs = as_centers(centers)
    spark = points.sparkSession
    stats = (
        assign(points, cs)
        .groupBy("ci")
        .agg(
            F.count_if(F.col("grp") == F.lit(GROUP_A)).alias("n_a"),
            F.count_if(F.col("grp") == F.lit(GROUP_B)).alias("n_b"),
        )
    )
    cdf = spark.createDataFrame([(i, c) for i, c in enumerate(cs)], "ci INT, center ARRAY<DOUBLE>")
    # Both sides hold at most K rows; AQE broadcasts them when their measured size is under the threshold.
    return cdf.join(stats, "ci", "left").select(
        "ci",
        "center",
        F.coalesce("n_a", F.lit(0)).cast("bigint").alias("n_a"),
        F.coalesce("n_b", F.lit(0)).cast("bigint").alias("n_b"),
    )


# ---------------------------------------------------------------------------------------------------------------
# Vector sums per key
# ---------------------------------------------------------------------------------------------------------------


def vector_sum_aggs(vec: str, dim: int) -> list[Column]:
    """Aggregate expressions summing the array column named by SQL text ``vec``; read back with
    :func:`vector_sum_value` or :func:`vector_sum_column`."""
    if dim <= UNROLL_DIM:
        return [F.expr(f"sum({vec}[{j}])").alias(f"_vs{j}") for j in range(dim)]
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer

    return [Summarizer.sum(array_to_vector(F.expr(vec))).alias("_vsum")]


def vector_sum_value(row: Row, dim: int) -> list[float]:
    if dim <= UNROLL_DIM:
        return [float(row[f"_vs{j}"]) for j in range(dim)]
    return [float(x) for x in row["_vsum"].toArray()]


def vector_sum_column(dim: int) -> Column:
    """The summed vector as an ``ARRAY<DOUBLE>`` column, after an aggregation built by :func:`vector_sum_aggs`."""
    if dim <= UNROLL_DIM:
        return F.expr("array(" + ", ".join(f"_vs{j}" for j in range(dim)) + ")")
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col("_vsum"))


PARTIAL_SUMS = "ci INT, grp STRING, n BIGINT, rsq DOUBLE, rsum ARRAY<DOUBLE>, searched BIGINT"


def residual_sums(points: DataFrame, centers: Centers, by_group: bool = True) -> DataFrame:
    """Per (cluster[, group]): ``n``, the summed residual ``x - c_ci`` (vector sum columns) and ``rsq`` = Σ‖x - c_ci‖².

    Residuals to the current centre keep the sums small, so the group means and scatters recovered from them are
    numerically stable; one pass replaces a second scan against the means.  For a centre set larger than one
    broadcast each block's Arrow pass sets the residuals of the points whose centre it holds.
    """
    cs = as_centers(centers)
    _, dim = check_centers(cs)
    keys = ["ci", "grp"] if by_group else ["ci"]
    chosen = choose_strategy(cs)
    if chosen == "arrow":
        residual_partials = _kernels().residual_partials
        bc = _broadcast_centers(points.sparkSession, cs)
        schema = PARTIAL_SUMS
        parts = points.select("features", *(["grp"] if by_group else [])).mapInArrow(
            lambda it: residual_partials(it, bc.value, by_group), schema
        )
        return _sum_partials(parts, keys, dim)
    if chosen == "chunked":
        import numpy as np

        residual_batches = _kernels().residual_batches
        proj = assign(points, cs, "chunked").select(*keys, "features", F.col("features").alias("_rv"))
        for offset, block in _chunks(cs):
            bc = _broadcast(points.sparkSession, np.asarray(block, dtype=np.float64))
            proj = proj.mapInArrow(lambda it, bc=bc, offset=offset: residual_batches(it, bc.value, offset), proj.schema)
        proj = proj.selectExpr(*keys, "_rv", "aggregate(_rv, 0D, (s, y) -> s + y * y) AS _rsq")
        return proj.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.sum("_rsq").alias("rsq"), *vector_sum_aggs("_rv", dim)
        )
    assigned = assign(points, cs).select(*keys, "features", F.expr(f"{centers_sql(cs)}[ci]").alias("_c"))
    if dim <= UNROLL_DIM:
        res = [f"(features[{j}] - _c[{j}])" for j in range(dim)]
        proj = assigned.selectExpr(
            *keys, *[f"{r} AS _r{j}" for j, r in enumerate(res)], " + ".join(f"{r} * {r}" for r in res) + " AS _rsq"
        )
        sums = [F.expr(f"sum(_r{j})").alias(f"_vs{j}") for j in range(dim)]
    else:
        proj = assigned.selectExpr(*keys, "zip_with(features, _c, (a, b) -> a - b) AS _rv").selectExpr(
            *keys, "_rv", "aggregate(_rv, 0D, (s, y) -> s + y * y) AS _rsq"
        )
        sums = vector_sum_aggs("_rv", dim)
    return proj.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("_rsq").alias("rsq"), *sums)


def _sum_partials(parts: DataFrame, keys: list[str], dim: int, *more: Column) -> DataFrame:
    """The kernels' rows summed by key: each batch emits at most K (x 2), the shuffle carries only those."""
    return parts.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n"), F.sum("rsq").alias("rsq"), *vector_sum_aggs("rsum", dim), *more
    )


def collect_residual_sums(points: DataFrame, centers: Centers, by_group: bool = True) -> list[tuple]:
    """The at most 2K rows of :func:`residual_sums` as ``(ci, grp, n, Σr, Σ‖r‖²)`` with r = x - c_ci."""
    cs = as_centers(centers)
    with _released_broadcasts():
        rows = residual_sums(points, cs, by_group).collect()
    return _sum_rows(rows, len(cs[0]), by_group)


def _sum_rows(rows: list[Row], dim: int, by_group: bool) -> list[tuple]:
    return [(r["ci"], r["grp"] if by_group else None, int(r["n"]), vector_sum_value(r, dim), float(r["rsq"])) for r in rows]


def cluster_ab_outer_join(points: DataFrame, centers: Centers) -> DataFrame:
    """``(ci, n_a, n_b, s_a, s_b)``: per cluster the A-side and B-side counts and coordinate sums: the full outer join of both
    sides on ``ci`` (a missing side reads as count 0 and the zero vector).

    Both sides come from one ``groupBy(ci, grp)`` aggregation of at most 2K rows over one scan; regrouping these by ``ci``
    joins them without a second scan, and without a cached copy that someone would have to release.
    """
    cs = as_centers(centers)
    _, dim = check_centers(cs)
    sums = (
        assign(points, cs)
        .groupBy("ci", "grp")
        .agg(F.count(F.lit(1)).alias("n"), *vector_sum_aggs("features", dim))
        .select("ci", "grp", "n", vector_sum_column(dim).alias("s"))
    )

    def side(column: str, g: str) -> Column:
        return F.first(F.when(F.col("grp") == F.lit(g), F.col(column)), ignorenulls=True)

    zero = F.array_repeat(F.lit(0.0), dim)
    return sums.groupBy("ci").agg(
        F.coalesce(side("n", GROUP_A), F.lit(0)).cast("bigint").alias("n_a"),
        F.coalesce(side("n", GROUP_B), F.lit(0)).cast("bigint").alias("n_b"),
        F.coalesce(side("s", GROUP_A), zero).alias("s_a"),
        F.coalesce(side("s", GROUP_B), zero).alias("s_b"),
    )


# ---------------------------------------------------------------------------------------------------------------
# k-means
# ---------------------------------------------------------------------------------------------------------------


def kmeans(
    points: DataFrame,
    k: int,
    max_iter: int,
    seed: int = 48,
    init_mode: str = "k-means||",
    tol: float = 1e-4,
    init_steps: int = 2,
) -> list[list[float]]:
    """Spark ML k-means; returns the centres (possibly fewer than k when there are fewer distinct points).  Its draws
    depend on the partitioning; ``lloyd(p, kmeans_init(p, k), m, tol=1e-4)`` is the same algorithm without that.

    ``max_iter=0`` gives the k-means|| seeding alone.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    vecs = points.select(array_to_vector("features").alias("features"))
    model = KMeans(
        k=k, maxIter=max_iter, seed=seed, initMode=init_mode, tol=tol, initSteps=init_steps, featuresCol="features"
    ).fit(vecs)
    return [[float(x) for x in c] for c in model.clusterCenters()]


def _digits(head: Column | str, round_: int, seed: int) -> Column:
    """13 hex digits of ``md5("<head>:<round>:<seed>")``: their text order is the order of the draws."""
    text = F.concat(F.lit(head) if isinstance(head, str) else head, F.lit(f":{round_}:{seed}"))
    return F.substring(F.md5(text.cast("binary")), 1, 13)


def draw(head: Column | str, round_: int, seed: int) -> Column:
    """A uniform number in [0, 1): the first 52 bits of ``md5("<head>:<round>:<seed>")``.  It depends on nothing else,
    so every layout of the points and every retried task draws the same."""
    return F.conv(_digits(head, round_, seed), 16, 10).cast("double") / F.lit(2.0**52)


def _drawn(head: Column, round_: int, seed: int, share: Column) -> Column:
    """``draw < share``.  Below a share of 1/16 the first digit must be 0: that is asked first, and only the few rows
    that pass have their digits turned into a number."""
    likely = (share >= F.lit(0.0624)) | _digits(head, round_, seed).startswith("0")
    return likely & (draw(head, round_, seed) < share)


def _reduce_candidates(candidates: list[list[float]], weights: list[int], k: int, draws: list[float]) -> list[list[float]]:
    """Weighted k-means++ over the few candidates: each pick is the first whose running mass exceeds draw * total."""
    import numpy as np

    c, w = np.asarray(candidates), np.asarray(weights, dtype=float)
    mass, near, out = w, np.full(len(c), np.inf), []
    for u in draws[:k]:
        run = np.cumsum(mass)
        if not run[-1] > 0:
            break  # every candidate with weight is picked
        pick = int(np.argmax(run > u * run[-1]))
        out.append(candidates[pick])
        near = np.minimum(near, ((c - c[pick]) ** 2).sum(axis=1))
        mass = w * near
    return out


def kmeans_init(points: DataFrame, k: int, seed: int = 48, init_steps: int = 2) -> list[list[float]]:
    """k-means|| seeding whose draws are a hash of (id, round, seed), so it is the same under every partitioning.

    The point with the least draw of round 0 is the first candidate (ties: least id, then features).  In each of
    ``init_steps`` rounds a point becomes a candidate if its draw is below 2k * (its squared distance to the candidates) /
    cost, the sum of those distances: 2k candidates a round on average, equal ones once.  Each point keeps its nearest
    candidate so far and is compared with a round's new ones only.  Candidates weighted by
    the points nearest to them are reduced to k by k-means++.  Fewer than k centres come back when there are fewer
    distinct candidates; no points, no centres.  Ids should be unique: points of one id share their draws.  A point
    without an id draws by the hash of its features.
    """
    pid = F.col("id") if "id" in points.columns else F.lit(None).cast("bigint")
    key = F.coalesce(pid.cast("string"), F.concat(F.lit("x"), F.xxhash64("features").cast("string")))
    held: list[DataFrame] = []  # each round's nearest-so-far, persisted until the next round's stands
    try:
        with _Cached(points.select(pid.alias("id"), "features", "grp")) as p, _released_broadcasts():
            keyed = p.select("id", "features", key.alias("_key"))
            first = keyed.orderBy(_digits(F.col("_key"), 0, seed), "id", "features").select("features").limit(1).collect()
            candidates = [list(r["features"]) for r in first]
            if not candidates:
                return []
            near, new = keyed, candidates
            for r in range(1, init_steps + 2):
                near = _nearer(near, new, len(candidates) - len(new)) if new else near
                held.append(near.persist(StorageLevel.MEMORY_AND_DISK))
                if r > init_steps:
                    break
                cost = near.agg(F.sum("d2")).first()[0]
                for old in held[:-1]:
                    old.unpersist()
                share = F.lit(2.0 * k) * F.col("d2") / F.lit(cost)
                hit = _drawn(F.col("_key"), r, seed, share) if cost else F.lit(False)
                rows = near.where(hit).groupBy("features").agg(F.min("id").alias("id")).collect()  # 2k rows on average
                rows.sort(key=lambda row: (row["id"] is not None, row["id"] or 0, row["features"]))
                new = [list(row["features"]) for row in rows]
                candidates += new
            counts = dict(near.groupBy("ci").count().collect())
    finally:
        for df in held:
            df.unpersist()
    draws = points.sparkSession.range(1).select(*[draw("pick", i, seed) for i in range(k)]).first()
    return _reduce_candidates(candidates, [counts.get(i, 0) for i in range(len(candidates))], k, list(draws))


def _nearer(state: DataFrame, new: list[list[float]], offset: int) -> DataFrame:
    """Points with the nearest centre so far (``ci``, ``d2``) after ``new`` ones, numbered from ``offset``, were added: every
    point is compared with the new ones only.  On ties the earlier centre stays."""
    if not offset:
        return assign(state, new)
    before = state.withColumnsRenamed({"ci": "_ci", "d2": "_d2"})
    both = F.least(F.struct(F.col("_d2").alias("d2"), F.col("_ci").alias("ci")), F.struct("d2", (F.col("ci") + F.lit(offset)).alias("ci")))
    merged = assign(before, new).withColumn("_best", both)
    names = [c for c in state.columns if c not in ("ci", "d2")]
    return merged.select(*names, F.col("_best.ci").alias("ci"), F.col("_best.d2").alias("d2"))


#: Named starts: the hash-drawn seeding above, and Spark ML's own, whose draws depend on the partitioning.
INITS = {"k-means||": kmeans_init, "spark-ml": lambda points, k, seed=48: kmeans(points, k, 0, seed=seed)}


def initial_centers(points: DataFrame, k: int, init: Centers | str, seed: int = 48) -> list[list[float]]:
    """The given centres, or those of a named start."""
    if not isinstance(init, str):
        return as_centers(init)
    if init not in INITS:
        raise ValueError(f"unknown init {init!r}")
    return INITS[init](points, k, seed=seed)


def first_k_centers(points: DataFrame, k: int, order: Sequence[str | Column] = ("id",)) -> list[list[float]]:
    """A deterministic initial centre set: the features of the first k points in the given order."""
    rows = points.orderBy(*order).select("features").limit(k).collect()
    return [[float(x) for x in r["features"]] for r in rows]


class _Cached:
    """Persist a DataFrame for the duration of an iterative job unless the caller already did.

    ``partitions`` spreads the points over so many partitions first; by default the scan's own layout stays.  Lost
    cached blocks are recomputed from the source; the lineage is one scan, since centres are driver values.
    """

    def __init__(self, df: DataFrame, partitions: int | None = None):
        self.owned = not df.storageLevel.useMemory and not df.storageLevel.useDisk
        if self.owned:
            # Only the columns the rounds read are cached; ``partitions`` is an explicit round-robin layout.
            cols = df.select(*[c for c in ("id", "features", "grp") if c in df.columns])
            self.df = spread(cols, partitions)
        else:
            self.df = df

    def __enter__(self) -> DataFrame:
        if self.owned:
            self.df.persist(StorageLevel.MEMORY_AND_DISK)
        return self.df

    def __exit__(self, *exc) -> None:
        if self.owned:
            self.df.unpersist()


# Centre sets of at least this many cells keep distance bounds from round to round.
BOUND_CELLS = 2048
# Share of points to be searched anew beyond which a round's centres become the next reference.
RENEW = 0.25


class RoundSums:
    """The residual sums of the successive centre sets of one iterative job over cached points.

    For a large centre set the points are cached once more with their nearest centre in a *reference* set, the distance
    to it and a lower bound of the distance to any other.  In a later round a centre that has moved by m since the
    reference is at most m nearer or farther, so most points keep their centre by the triangle inequality and only the
    others are compared with all centres: same centres as without bounds, bit for bit.  After a round that had to search
    more than ``RENEW`` of the points, the next round's centres become the reference.  Bounds are columns of a cached DataFrame:
    a lost executor's are recomputed from the points and the reference centres.

    ``trace`` has an entry per round: ``(points, distances computed, distances skipped)``.
    """

    def __init__(self, points: DataFrame, by_group: bool, bounds: bool | None = None):
        self.points, self.by_group, self.bounds = points, by_group, bounds
        self.trace: list[tuple[int, int, int]] = []
        self._cached: DataFrame | None = None
        self._before: list[list[float]] | None = None
        self._sent = None

    def __enter__(self) -> RoundSums:
        return self

    def __exit__(self, *exc) -> None:
        self._drop()

    def _drop(self) -> None:
        if self._cached is not None:
            self._cached.unpersist()
            self._sent.unpersist(blocking=False)
        self._cached = self._before = self._sent = None

    def _wanted(self, cs: list[list[float]]) -> bool:
        import numpy as np

        if choose_strategy(cs) not in ("arrow", "unrolled") or not np.isfinite(np.asarray(cs)).all():
            return False
        return len(cs) * len(cs[0]) >= BOUND_CELLS if self.bounds is None else self.bounds

    def _refer(self, cs: list[list[float]]) -> None:
        import numpy as np
        from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

        self._drop()
        reference_batches = _kernels().reference_batches
        bc = self.points.sparkSession.sparkContext.broadcast(np.asarray(cs, dtype=np.float64))
        df = self.points.select("features", *(["grp"] if self.by_group else []))
        more = [("ci", IntegerType()), ("near", DoubleType()), ("far", DoubleType())]
        schema = StructType([*df.schema.fields, *[StructField(n, t, False) for n, t in more]])
        self._cached = df.mapInArrow(lambda it: reference_batches(it, bc.value), schema).persist(StorageLevel.MEMORY_AND_DISK)
        self._before, self._sent = cs, bc

    def __call__(self, centers: Centers) -> list[tuple]:
        """The at most 2K rows ``(ci, grp, n, Σr, Σ‖r‖²)`` of these centres."""
        cs = as_centers(centers)
        if not self._wanted(cs):
            rows = collect_residual_sums(self.points, cs, self.by_group)
            n = sum(r[2] for r in rows)
            self.trace.append((n, n * len(cs), 0))
            return rows
        import numpy as np

        fresh = self._before is None or len(self._before) != len(cs)
        if fresh:
            self._refer(cs)
        with _released_broadcasts():
            now, before = np.asarray(cs, dtype=np.float64), np.asarray(self._before, dtype=np.float64)
            bc = _broadcast(self.points.sparkSession, (now, before))
            bounded_partials, by_group = _kernels().bounded_partials, self.by_group
            parts = self._cached.mapInArrow(lambda it: bounded_partials(it, *bc.value, by_group), PARTIAL_SUMS)
            keys = ["ci", "grp"] if by_group else ["ci"]
            sums = _sum_partials(parts, keys, len(cs[0]), F.sum("searched").alias("searched")).collect()
        rows = _sum_rows(sums, len(cs[0]), by_group)
        n, searched = sum(r[2] for r in rows), int(sum(r["searched"] for r in sums))
        computed = (searched + n * fresh) * len(cs)
        self.trace.append((n, computed, n * len(cs) - computed))
        if searched > RENEW * n and not fresh:
            self._drop()
        return rows


def _moved(cs: list[list[float]], rows: list[tuple]) -> list[list[float]]:
    """Every centre at the mean of its points; a centre with no point stays put."""
    out = [list(c) for c in cs]
    for ci, _, n, s, _ in rows:  # at most K rows
        out[ci] = [c + v / n for c, v in zip(cs[ci], s)]
    return out


def lloyd_step(points: DataFrame, centers: Centers) -> list[list[float]]:
    """One Lloyd round: each centre moves to the mean of its points; a centre with no point stays put."""
    cs = as_centers(centers)
    return _moved(cs, collect_residual_sums(points, cs, by_group=False))


def lloyd(
    points: DataFrame,
    init: Centers,
    rounds: int,
    partitions: int | None = None,
    tol: float | None = None,
    bounds: bool | None = None,
    trace: list | None = None,
) -> list[list[float]]:
    """k-means by Lloyd steps from the given centres (one Spark job per round).

    Without ``tol`` exactly ``rounds`` steps run; with it the loop also stops once no centre moved more than
    ``tol`` (Spark ML's convergence rule), so a start by ``kmeans(p, k, 0)`` gives Spark ML k-means
    with the seeding computed once and reusable.  ``bounds`` keeps distance bounds between rounds (see
    :class:`RoundSums`; by default where the centre set is large); ``trace`` is given what each round skipped."""
    cs = as_centers(init)
    with _Cached(points, partitions) as p, RoundSums(p, by_group=False, bounds=bounds) as sums:
        for _ in range(rounds):
            new = _moved(cs, sums(cs))
            moved = max(sum((a - b) * (a - b) for a, b in zip(c0, c1)) for c0, c1 in zip(cs, new))
            cs = new
            if tol is not None and moved <= tol * tol:
                break
        if trace is not None:
            trace += sums.trace
    return cs


def centers_df(spark, centers: Centers) -> DataFrame:
    """Centres in long form ``(ci INT, j INT, value DOUBLE)``."""
    rows = [(i, j, float(x)) for i, c in enumerate(centers) for j, x in enumerate(c)]
    return spark.createDataFrame(rows, "ci INT, j INT, value DOUBLE")


class ClusteringReport:
    """The quality report of one clustering: sizes, Δ, Φ and per-centre group counts (two jobs over the points)."""

    def __init__(self, centers: list[list[float]], summary: DataFrame, stats: DataFrame):
        self.centers = centers
        self.summary = summary  # one row: n, n_a, n_b, delta, phi
        self.stats = stats  # (ci, center, n_a, n_b)


def clustering_report(
    points: DataFrame,
    k: int,
    rounds: int,
    init: Centers | str = "k-means||",
    seed: int = 48,
    partitions: int | None = None,
):
    """k-means from a named start (Lloyd steps with Spark ML's stopping rule) or from given centres (exactly ``rounds``
    steps), then its report.
    ``partitions`` is the number of partitions the points are spread over while the job runs."""
    with _Cached(points, partitions) as p:
        cs = lloyd(p, initial_centers(p, k, init, seed), rounds, tol=1e-4 if isinstance(init, str) else None)
        summary = objectives(p, cs).collect()
        stats = cluster_stats(p, cs)
        rows = stats.collect()  # at most K rows, read while the points are cached
    spark = points.sparkSession
    summary_df = spark.createDataFrame(summary, "n BIGINT, n_a BIGINT, n_b BIGINT, delta DOUBLE, phi DOUBLE")
    return ClusteringReport(cs, summary_df, spark.createDataFrame(rows, stats.schema))
