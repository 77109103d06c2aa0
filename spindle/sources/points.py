"""Labelled point sets ``(id BIGINT, features ARRAY<DOUBLE>, grp STRING)``.

A point set U = A ∪ B is one tagged DataFrame; the groups are the literals ``'A'`` and ``'B'``.  Any other label is
rejected at the source (a ``raise_error`` inside the plan, so the check runs on the executors), which keeps every
objective's denominators unambiguous.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two group labels.
GROUP_A = "A"
GROUP_B = "B"

POINTS_SCHEMA = "id BIGINT, features ARRAY<DOUBLE>, grp STRING"


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def _required(ok: Column, message: Column) -> Column:
    """A filter condition that fails the job where ``ok`` is not true.  Checks in a projected column would be pruned
    away with the column; a filter is evaluated whatever the consumer reads."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def points_from_table(df: DataFrame, features: Column, group: Column, id_col: Column | None = None) -> DataFrame:
    """Points from any table: a features array expression and a group expression."""
    pid = id_col if id_col is not None else F.lit(None).cast("bigint")
    out = df.select(pid.cast("bigint").alias("id"), features.cast("array<double>").alias("features"), group.alias("grp"))
    label = F.coalesce(F.col("grp").isin(GROUP_A, GROUP_B), F.lit(False))
    finite = F.coalesce((F.size("features") > 0) & F.forall("features", _finite), F.lit(False))
    return out.where(
        _required(label, F.concat(F.lit("group label must be A or B, got: "), F.coalesce("grp", F.lit("NULL"))))
    ).where(_required(finite, F.lit("a feature vector must hold finite numbers")))


def parse_point_lines(
    lines: DataFrame, mode: str = "failfast", value: str = "value", dim: int | None = None, same_dim: int | None = None
) -> DataFrame:
    """Parse ``x1,...,xd,label`` text lines.  The last comma token is the group, the rest are coordinates.

    A line is bad if a coordinate is not a finite number, there is none, the label is not a group, or, with ``dim``,
    if it has another number of coordinates.  ``mode="failfast"`` fails the job on a bad line, whatever columns are
    read; ``mode="drop"`` skips bad lines.  With ``same_dim`` a good line with another number of coordinates fails the
    job in both modes, whatever columns are read: the points would not be one dataset.  Lines get a position-derived id.
    """
    if mode not in ("failfast", "drop"):
        raise ValueError(f"unknown mode {mode!r}")
    tok = F.split(F.col(value), ",")
    n = F.size(tok)
    label = F.element_at(tok, -1)
    coords = F.transform(F.slice(tok, 1, F.greatest(n - 1, F.lit(0))), lambda t: t.try_cast("double"))
    ok = (n >= 2) & label.isin(GROUP_A, GROUP_B) & F.forall(coords, _finite)
    if dim is not None:
        ok = ok & (n == dim + 1)
    ok = F.coalesce(ok, F.lit(False))
    if mode == "failfast":
        bad = F.filter(F.slice(tok, 1, F.greatest(n - 1, F.lit(0))), lambda t: ~F.coalesce(_finite(t.try_cast("double")), F.lit(False)))
        shape = F.concat(F.lit("malformed point line: "), F.coalesce(F.col(value), F.lit("NULL")))
        why = F.when((n < 2) | (label == F.lit("")), shape)
        why = why.when(~label.isin(GROUP_A, GROUP_B), F.concat(F.lit("group label must be A or B, got: "), label))
        why = why.when(F.size(bad) > 0, F.concat(F.lit("malformed coordinate: "), F.get(bad, F.lit(0)))).otherwise(shape)
        ok = _required(ok, why)
    if same_dim is not None:
        mixed = F.concat(F.lit(f"points of {same_dim} coordinates expected, got: "), F.col(value))
        ok = F.when(ok, _required(n == same_dim + 1, mixed)).otherwise(F.lit(False))
    return lines.where(ok).select(
        F.monotonically_increasing_id().alias("id"), coords.alias("features"), label.alias("grp")
    )


def read_points(spark: SparkSession, path: str, mode: str = "failfast", dim: int | None = None) -> DataFrame:
    """Labelled-point text scan (one point per line, no header).

    Without ``dim`` the dataset's dimension is that of its first good line, read at once as a schema is inferred, and a
    good line of any other dimension fails the job in both modes.
    """
    lines = spark.read.text(path)
    if dim is not None:
        return parse_point_lines(lines, mode=mode, dim=dim)
    first = parse_point_lines(lines, mode="drop").select(F.size("features").alias("d")).first()
    return parse_point_lines(lines, mode=mode, same_dim=first and first["d"])


def point_lines(points: DataFrame, decimals: int = 5) -> DataFrame:
    """Render points as ``x1,...,xd,label`` lines with a fixed number of decimals."""
    fmt = f"%.{int(decimals)}f"
    coords = F.transform("features", lambda x: F.format_string(fmt, x))
    return points.select(F.array_join(F.concat(coords, F.array(F.col("grp"))), ",").alias("value"))


def write_points(points: DataFrame, path: str, decimals: int = 5, mode: str = "error") -> None:
    """Write points as text part files, one line per point, in parallel."""
    point_lines(points, decimals).write.mode(mode).text(path)


# ---------------------------------------------------------------------------------------------------------------
# Bindings to the driver's test tables.
# ---------------------------------------------------------------------------------------------------------------


def embeddings_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-d points: ``embeddings``; group B when ``label % 4 = 0``, else A."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    grp = F.when(F.col("label") % 4 == 0, F.lit(GROUP_B)).otherwise(F.lit(GROUP_A))
    return points_from_table(df, F.col("embedding"), grp, F.col("vec_id"))


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-d points: ``lineitem`` (quantity, discount in percent); group B when the return flag is R.

    ``(l_orderkey, l_linenumber)`` is not unique in the test data, so the id is informative only.
    """
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    grp = F.when(F.col("l_returnflag") == "R", F.lit(GROUP_B)).otherwise(F.lit(GROUP_A))
    feats = F.array(F.col("l_quantity"), F.col("l_discount") * F.lit(100.0))
    pid = F.col("l_orderkey") * F.lit(10) + F.col("l_linenumber")
    return points_from_table(df, feats, grp, pid)
