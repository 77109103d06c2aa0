"""Arrow-batched numpy kernels for centre sets too large to be plan literals (large K * dim).

Spark partitions the points and shuffles the partial results; inside each task a batch of points becomes one
``(n, dim)`` matrix.  A matrix product over coordinates shifted to the centres' mean gives approximate distances to all
K centres; it only makes a shortlist.  Centres within a proven rounding bound of the least approximate distance are
compared by the direct Σ (x - c)², summed coordinate by coordinate as the JVM expression does, so index and distance are
those of the exact path for every centre-set size.  A large set comes with a tree (:mod:`spindle.functions.center_tree`).  Ties go to the lowest index and NaN distances never win.  The centre
set travels as a broadcast variable whose size is checked by the caller.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from spindle.functions import center_tree
from spindle.functions.center_tree import CenterTree, rounding_slack


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index("features"))
    if col.null_count:
        raise ValueError("null feature vector")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if flat.size != len(batch) * dim:
        raise ValueError(f"every feature vector must have {dim} coordinates")
    return flat.reshape(len(batch), dim)


def direct_sq(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Σ (x - c)² per row, added in coordinate order."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        d = x[:, j] - c[:, j]
        total += d * d
    return total


def brute_shortlist(x: np.ndarray, c: np.ndarray, with_second: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """``row, ci`` of all pairs that may be the nearest by the rounding bounds; on request a lower bound of each row's second
    least squared distance (0 where there is none to tell)."""
    with np.errstate(all="ignore"):
        origin = c.mean(axis=0)
        xs, cs = x - origin, c - origin
        x2, c2 = (xs * xs).sum(axis=1), (cs * cs).sum(axis=1)
        approx = x2[:, None] - 2.0 * (xs @ cs.T) + c2[None, :]
        slack = rounding_slack(x.shape[1], np.sqrt(x2), np.sqrt(c2.max()))
        low = approx.min(axis=1)
        # NaN and infinity compare false here, so such rows keep every centre.
        row, ci = np.nonzero(~(approx > (low + 2 * slack)[:, None]))
        if not with_second:
            return row, ci, None
        second = np.partition(approx, 1, axis=1)[:, 1] - slack if len(c) > 1 else np.full(len(x), np.inf)
    return row, ci, np.nan_to_num(np.maximum(second, 0), nan=0.0, posinf=np.inf)


def _least(x: np.ndarray, c: np.ndarray, row: np.ndarray, ci: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every row among its shortlist, by the direct distances, the lowest index on ties."""
    with np.errstate(all="ignore"):
        d2 = direct_sq(x[row], c[ci])
    order = np.lexsort((ci, np.where(np.isnan(d2), np.inf, d2), row))
    first = order[np.searchsorted(row[order], np.arange(len(x)))]
    return ci[first].astype(np.int32), d2[first]


def nearest_block(x: np.ndarray, c: np.ndarray | CenterTree) -> tuple[np.ndarray, np.ndarray]:
    """``(ci, d2)`` for every row of ``x`` against the centres ``c``, by their tree where they have one."""
    if not isinstance(c, CenterTree):
        return _least(x, c, *brute_shortlist(x, c)[:2]) if len(x) else (np.zeros(0, dtype=np.int32), np.zeros(0))
    ci, d2 = np.zeros(len(x), np.int32), np.zeros(len(x))
    for start in range(0, len(x), center_tree.ROWS):
        part = slice(start, start + center_tree.ROWS)
        some = x[part]
        if not np.isfinite(some).all():
            ci[part], d2[part] = nearest_block(some, c.c)
            continue
        row, own, whole = c.shortlist(some)
        if len(whole):
            more, far, _ = brute_shortlist(some[whole], c.c)
            row, own = np.concatenate([row, whole[more]]), np.concatenate([own, far])
        ci[part], d2[part] = _least(some, c.c, row, own)
    return ci, d2


def received(value: np.ndarray | dict) -> np.ndarray | CenterTree:
    """A broadcast centre set: a matrix, or the parts of a tree."""
    return CenterTree.restored(value) if isinstance(value, dict) else value


def plain(c: np.ndarray | CenterTree) -> np.ndarray:
    """The centre matrix, with or without a tree."""
    return c.c if isinstance(c, CenterTree) else c


def residual_batches(batches, centers: np.ndarray, offset: int):
    """mapInArrow body: where ``ci`` lies in this block of centres, ``_rv`` becomes the residual to that centre."""
    k, dim = centers.shape
    for b in batches:
        x = _matrix(b, dim)
        i = b.schema.get_field_index("_rv")
        ci = b.column(b.schema.get_field_index("ci")).to_numpy() - offset
        rv = b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(x.shape).copy()
        mine = (ci >= 0) & (ci < k)
        rv[mine] = x[mine] - centers[ci[mine]]
        ends = pa.array(np.arange(0, (len(x) + 1) * dim, dim, dtype=np.int32))
        columns = list(b.columns)
        columns[i] = pa.ListArray.from_arrays(ends, pa.array(rv.ravel()))
        yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)


def assign_batches(batches, centers: np.ndarray | dict, names=("ci", "d2"), offset: int = 0):
    """mapInArrow body: append the nearest centre's index (plus ``offset``) and squared distance to every batch."""
    centers = received(centers)
    dim = plain(centers).shape[1]
    for b in batches:
        ci, d2 = nearest_block(_matrix(b, dim), centers)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(ci + offset, pa.int32()), pa.array(d2, pa.float64())],
            names=[*b.schema.names, *names],
        )


def distance_batches(batches, center_sets: list[np.ndarray | dict], names: list[str]):
    """mapInArrow body: append, for each centre set, the squared distance to its nearest centre (one pass over the
    points for several centre sets)."""
    center_sets = [received(c) for c in center_sets]
    dim = plain(center_sets[0]).shape[1]
    for b in batches:
        x = _matrix(b, dim)
        extra = [pa.array(nearest_block(x, c)[1], pa.float64()) for c in center_sets]
        yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, *names])


def sums_by_key(b: pa.RecordBatch, x: np.ndarray, ci: np.ndarray, c: np.ndarray, by_group: bool, searched: int) -> pa.RecordBatch:
    """Per (cluster[, group]) of a batch the count, Σr (as a list) and Σ‖r‖², r = x - c_ci; ``searched``, the points compared
    with all centres, stands in the first row."""
    dim = c.shape[1]
    r = x - c[ci]
    rsq = (r * r).sum(axis=1)
    if by_group:
        codes = b.column(b.schema.get_field_index("grp")).dictionary_encode(null_encoding="encode")
        labels, gi = codes.dictionary.to_pylist(), codes.indices.to_numpy()
    else:
        labels, gi = [None], np.zeros(len(x), dtype=np.int64)
    key = ci.astype(np.int64) * max(len(labels), 1) + gi
    uniq, inv = np.unique(key, return_inverse=True)
    n = np.bincount(inv, minlength=len(uniq))
    order = np.argsort(inv, kind="stable")  # rows of a key together, summed by one reduction
    s = np.add.reduceat(r[order], np.cumsum(n) - n, axis=0) if len(uniq) else np.zeros((0, dim))
    q = np.bincount(inv, weights=rsq, minlength=len(uniq))
    cols = {
        "ci": pa.array((uniq // max(len(labels), 1)).astype(np.int32), pa.int32()),
        "grp": pa.array([labels[u % max(len(labels), 1)] for u in uniq], pa.string()),
        "n": pa.array(n.astype(np.int64), pa.int64()),
        "rsq": pa.array(q, pa.float64()),
        "rsum": pa.ListArray.from_arrays(
            pa.array(np.arange(0, (len(uniq) + 1) * dim, dim, dtype=np.int32)), pa.array(s.ravel())
        ),
        "searched": pa.array([searched][: len(uniq)] + [0] * (len(uniq) - 1), pa.int64()),
    }
    return pa.RecordBatch.from_pydict(cols)


def residual_partials(batches, centers: np.ndarray | dict, by_group: bool):
    """mapInArrow body: the sums of every batch's points, each by its nearest centre."""
    centers = received(centers)
    c = plain(centers)
    for b in batches:
        x = _matrix(b, c.shape[1])
        ci, _ = nearest_block(x, centers)
        yield sums_by_key(b, x, ci, c, by_group, len(x))


# ------------------------------------------------------------------------------------------------------------------
# Bounds carried from round to round
# ------------------------------------------------------------------------------------------------------------------

MARGIN = 1e-9  # far above the rounding error of a distance, so that a bound that holds settles ties as well


def reference_batches(batches, centers: np.ndarray):
    """mapInArrow body: append ``ci``, ``near`` (distance to it) and ``far`` (no other centre is nearer than this)."""
    for b in batches:
        x = _matrix(b, centers.shape[1])
        if len(x):
            row, own, second = brute_shortlist(x, centers, with_second=True)
            ci, d2 = _least(x, centers, row, own)
        else:
            ci, d2, second = np.zeros(0, np.int32), np.zeros(0), np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(ci, pa.int32()), pa.array(np.sqrt(d2), pa.float64()), pa.array(np.sqrt(second), pa.float64())],
            names=[*b.schema.names, "ci", "near", "far"],
        )


def bounded_partials(batches, centers: np.ndarray, before: np.ndarray, by_group: bool):
    """mapInArrow body over :func:`reference_batches` rows: the sums by the nearest of ``centers``, ``before`` being the
    reference's.  A centre moved by m is at most m nearer or farther than it was (triangle inequality), so a point whose
    own centre is still nearer than any other can be keeps it without a search."""
    moved = np.sqrt(((centers - before) ** 2).sum(axis=1))
    others = np.full(len(moved), moved.max())  # the farthest that any other centre has moved
    top = int(moved.argmax())
    others[top] = np.delete(moved, top).max() if len(moved) > 1 else 0.0
    for b in batches:
        x = _matrix(b, centers.shape[1])
        ci = b.column(b.schema.get_field_index("ci")).to_numpy().copy()
        near, far = (b.column(b.schema.get_field_index(n)).to_numpy() for n in ("near", "far"))
        stays = (near + moved[ci]) * (1 + MARGIN) < far * (1 - MARGIN) - others[ci] * (1 + MARGIN)
        search = np.flatnonzero(~stays)
        ci[search] = nearest_block(x[search], centers)[0]
        yield sums_by_key(b, x, ci, centers, by_group, len(search))
