"""Vector arithmetic as Spark column expressions over ``ARRAY<DOUBLE>`` columns.

Centre sets are small driver values (K rows of ``dim`` doubles; K and dim are user parameters that do not grow
with the data).  They enter the plan as literals, so assigning a point to its nearest centre needs neither a
shuffle nor a join.  Expressions over them are generated as SQL text and parsed once (``F.expr``): building
hundreds of terms through the Python Column API would cost one Py4J round trip per node.

Shapes:

* ``unrolled``: one arithmetic term per (centre, dimension); stays inside whole-stage codegen.  The terms read the
  centres from one array, so the generated code depends on K and dim only: every round of an iterative job, and every
  other centre set of that shape, runs code that is compiled already.  The default up to 48 cells.
* ``lambda``: higher-order functions (``transform``/``zip_with``/``aggregate``) over one array literal; compact,
  but evaluated without codegen.  Available on request.
* ``arrow``: not an expression -- an Arrow-batched numpy kernel (:mod:`spindle.functions.arrow_kernels`); the
  default above 48 cells.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest K * dim for which distances are written out term by term; above it assignment runs as an Arrow-batched numpy
# kernel with the centres in a broadcast variable (see spindle.functions.arrow_kernels).  Measured on 600k 2-d points
# with a new centre set each time: 0.35 s up to 32 cells, 0.45 s at 48, 0.65 s at 64, the kernel 0.55 s at any of
# them.  (With the centres as constants in the code: 0.7 s up to 24 cells, 4 to 7 s from 32 cells on.)
UNROLL_CELLS = 48
# Largest K * dim the explicit ``lambda`` strategy accepts as a plan literal.
MAX_LITERAL_CELLS = 100_000
# Largest K * dim shipped in one broadcast (256 MiB of doubles per executor).  A bigger centre set is split into
# chunks of at most this size, one Arrow pass each, and the per-chunk nearest centres are combined exactly.
MAX_BROADCAST_CELLS = 32 * 1024 * 1024

Centers = Sequence[Sequence[float]]


def check_centers(centers: Centers) -> tuple[int, int]:
    if len(centers) == 0:
        raise ValueError("need at least one centre")
    dim = len(centers[0])
    if dim == 0 or any(len(c) != dim for c in centers):
        raise ValueError("all centres must have the same, positive dimension")
    return len(centers), dim


def choose_strategy(centers: Centers, strategy: str = "auto") -> str:
    k, dim = check_centers(centers)
    if strategy == "auto":
        if k * dim <= UNROLL_CELLS:
            return "unrolled"
        return "arrow" if k * dim <= MAX_BROADCAST_CELLS else "chunked"
    if strategy in ("unrolled", "lambda") and k * dim > MAX_LITERAL_CELLS:
        raise ValueError(f"{strategy!r} needs K * dim <= {MAX_LITERAL_CELLS}; use 'arrow'")
    if strategy == "arrow" and k * dim > MAX_BROADCAST_CELLS:
        return "chunked"
    if strategy not in ("unrolled", "lambda", "arrow", "chunked"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy


def dlit(x: float) -> str:
    """SQL text of an exact DOUBLE literal."""
    x = float(x)
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return f"{x!r}D"


def array_sql(values: Sequence[float]) -> str:
    return "array(" + ", ".join(dlit(x) for x in values) + ")"


def centers_sql(centers: Centers) -> str:
    """``ARRAY<ARRAY<DOUBLE>>`` literal text holding the centre set (constant-folded by Catalyst)."""
    check_centers(centers)
    return "array(" + ", ".join(array_sql(c) for c in centers) + ")"


def sqdist_sql(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (x, y) -> (x - y) * (x - y)), 0D, (s, y) -> s + y)"


def _unrolled_sql(v: str, cells: str, k: int, dim: int) -> str:
    """The nearest of ``k`` centres whose coordinates stand one after the other in the array column ``cells``."""

    def centre(i: int, ci: str) -> str:
        d = [f"({v}[{j}] - {cells}[{i * dim + j}])" for j in range(dim)]
        return f"named_struct('d2', {' + '.join(f'{x} * {x}' for x in d)}, 'ci', {ci})"

    if k == 1:  # the index reads the distance too, so that a vector of another length fails whatever is selected
        return centre(0, f"if({cells}[0] = {cells}[0], 0, 1)")
    return f"least({', '.join(centre(i, str(i)) for i in range(k))})"


def with_nearest(df: DataFrame, v: str, centers: Centers, name: str, strategy: str = "auto") -> DataFrame:
    """``df`` plus the column ``name``: ``STRUCT<d2 DOUBLE, ci INT>`` of the nearest centre to array column ``v`` and its
    squared distance.

    Ties go to the lowest index and a NaN distance never beats a number, because structs compare field by field
    and Spark orders NaN above every other double.
    """
    k, dim = check_centers(centers)
    strategy = choose_strategy(centers, strategy)
    if strategy == "lambda":
        best = f"array_min(transform({centers_sql(centers)}, (c, i) -> named_struct('d2', {sqdist_sql(v, 'c')}, 'ci', i)))"
        return df.withColumn(name, F.expr(best))
    if strategy != "unrolled":
        raise ValueError(f"strategy {strategy!r} is not a column expression")
    cells = f"_cells{name}"
    wrong = f"raise_error(concat('every feature vector must have {dim} coordinates, got ', size({v})))"
    # The condition reads the row, so the array is not folded into the terms as constants.
    flat = f"if(size({v}) = {dim}, {array_sql([x for c in centers for x in c])}, CAST({wrong} AS ARRAY<DOUBLE>))"
    return df.withColumn(cells, F.expr(flat)).withColumn(name, F.expr(_unrolled_sql(v, cells, k, dim))).drop(cells)
