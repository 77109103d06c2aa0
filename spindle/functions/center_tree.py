"""An exact search tree over a large centre set, for Arrow batches of points.

The centres are split along their direction of greatest spread, at the median, until a leaf holds about sqrt(K) of them;
a leaf is a ball.  A batch of points goes down the tree and every point is compared with its leaf's centres (one matrix
product per leaf).  Two triangle inequalities then rule out the rest:

* a point whose best centre so far is less than half as far as that centre's nearest neighbour has found its nearest;
* any other point needs only the leaves whose ball reaches within its best distance, visited leaf by leaf.

What is left out is farther by more than every rounding bound, so the answer is the brute-force one: index and
distance from the direct Σ (x - c)², the lowest index on ties.  Points for which the balls rule out little, as points
without structure, are handed back to be compared with the whole set.
"""

from __future__ import annotations

import numpy as np

LEAF = 64  # centres of a leaf at least
DENSE = 0.4  # share of leaves left beyond which a point is compared with every centre
ROWS = 4096  # points handled at once
NEIGHBOUR_CENTERS = 16384  # centres beyond which their nearest neighbours are not computed (a matter of cost only)
MARGIN = 1e-9  # of a bound, far above the rounding error of a distance in any dimension a broadcast can hold


def rounding_slack(dim: int, length: np.ndarray | float, reach: float) -> np.ndarray | float:
    """How far |x|² - 2xc + |c|² may be off: a difference of doubles by half an ulp, a sum of products of dim terms by dim
    ulps of its absolute terms, which the squared sum of both lengths bounds; 8 (dim + 8) leaves room for every order of
    summation."""
    return 8 * (dim + 8) * np.finfo(np.float64).eps * (length + reach) ** 2


def principal_direction(x: np.ndarray) -> np.ndarray:
    """About the direction of greatest spread (a few steps of power iteration; any direction would be right)."""
    d = np.zeros(x.shape[1])
    d[np.argmax(x.var(axis=0))] = 1.0
    centred = x - x.mean(axis=0)
    for _ in range(4):
        step = centred.T @ (centred @ d)
        size = np.sqrt(step @ step)
        if not size > 0:
            break
        d = step / size
    return d


class CenterTree:
    """A centre set with its balls.  ``c`` holds the centres by index, as a plain centre matrix does."""

    def __init__(self, c: np.ndarray):
        self.c = c
        self.origin = c.mean(axis=0)
        cs = c - self.origin
        leaf = max(LEAF, int(np.sqrt(len(c))))
        # A split: its direction, threshold and two children; a child below 0 is leaf -child - 1.
        self.splits: list[tuple[np.ndarray, float, list[int]]] = []
        self.leaves: list[np.ndarray] = []
        todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(c)), -1, 0)]
        while todo:
            ids, parent, side = todo.pop()
            number = -len(self.leaves) - 1 if len(ids) <= leaf else len(self.splits)
            if parent >= 0:
                self.splits[parent][2][side] = number
            if number < 0:
                self.leaves.append(np.sort(ids))
                continue
            direction = principal_direction(cs[ids])
            along = cs[ids] @ direction
            order, half = np.argsort(along, kind="stable"), len(ids) // 2
            self.splits.append((direction, float(along[order[half]]), [0, 0]))
            todo += [(ids[order[:half]], number, 0), (ids[order[half:]], number, 1)]
        self.shifted = [cs[ids] for ids in self.leaves]
        self.squares = [(s * s).sum(axis=1) for s in self.shifted]
        self.middle = np.array([s.mean(axis=0) for s in self.shifted])
        self.radius = np.array([np.sqrt(((s - m) ** 2).sum(axis=1).max()) for s, m in zip(self.shifted, self.middle)]) * (1 + MARGIN)
        self.reach = np.sqrt(max(s.max() for s in self.squares))
        self.neighbour = self._neighbours(cs) if 1 < len(c) <= NEIGHBOUR_CENTERS else np.zeros(len(c))

    @classmethod
    def restored(cls, parts: dict) -> CenterTree:
        """The tree of ``vars(tree)``: plain arrays and lists, which travel without this module."""
        tree = cls.__new__(cls)
        tree.__dict__.update(parts)
        return tree

    def _neighbours(self, cs: np.ndarray) -> np.ndarray:
        """No other centre is nearer to a centre than this."""
        squares = (cs * cs).sum(axis=1)
        out = np.empty(len(cs))
        for i in range(0, len(cs), 1024):
            d2 = squares[i : i + 1024, None] - 2.0 * (cs[i : i + 1024] @ cs.T) + squares[None, :]
            d2[np.arange(len(d2)), np.arange(i, i + len(d2))] = np.inf
            out[i : i + 1024] = d2.min(axis=1) - rounding_slack(cs.shape[1], np.sqrt(squares[i : i + 1024]), self.reach)
        return np.sqrt(np.maximum(out, 0)) * (1 - MARGIN)

    def descend(self, xs: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """``leaf, rows`` of the leaves that the points come to."""
        out, todo = [], [(0 if self.splits else -1, np.arange(len(xs)))]
        while todo:
            number, rows = todo.pop()
            if not len(rows):
                continue
            if number < 0:
                out.append((-number - 1, rows))
                continue
            direction, threshold, children = self.splits[number]
            right = xs[rows] @ direction >= threshold
            todo += [(children[0], rows[~right]), (children[1], rows[right])]
        return out

    def shortlist(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, ci`` of all pairs that may be the nearest by the rounding bounds, and the rows left to be compared with every
        centre.  ``x`` must be finite."""
        xs = x - self.origin
        x2 = (xs * xs).sum(axis=1)
        slack = rounding_slack(x.shape[1], np.sqrt(x2), self.reach)
        best, own = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def visit(rows: np.ndarray, g: int) -> None:
            approx = x2[rows, None] - 2.0 * (xs[rows] @ self.shifted[g].T) + self.squares[g][None, :]
            at = approx.argmin(axis=1)
            low = approx[np.arange(len(rows)), at]
            nearer = low < best[rows]
            own[rows[nearer]], best[rows[nearer]] = self.leaves[g][at[nearer]], low[nearer]
            r, k = np.nonzero(approx <= (best[rows] + 2 * slack[rows])[:, None])
            found.append((rows[r], self.leaves[g][k], approx[r, k]))

        home = np.empty(len(x), np.int64)
        for g, rows in self.descend(xs):
            home[rows] = g
            visit(rows, g)
        upper = np.sqrt(np.maximum(best + slack, 0))
        rest = np.flatnonzero(~(2 * upper * (1 + MARGIN) < self.neighbour[own]))

        to_middle = x2[rest, None] - 2.0 * (xs[rest] @ self.middle.T) + (self.middle**2).sum(axis=1)[None, :]
        gap = np.sqrt(np.maximum(to_middle - slack[rest, None], 0)) * (1 - MARGIN) - self.radius[None, :]
        bound = np.maximum(gap, 0) ** 2 * (1 - MARGIN)
        still = bound <= (best[rest] + 2 * slack[rest])[:, None]
        still[np.arange(len(rest)), home[rest]] = False
        dense = still.mean(axis=1) > DENSE
        whole, rest, bound, still = rest[dense], rest[~dense], bound[~dense], still[~dense]
        for g in np.flatnonzero(still.any(axis=0)):
            at = np.flatnonzero(still[:, g])
            at = at[bound[at, g] <= best[rest[at]] + 2 * slack[rest[at]]]
            if len(at):
                visit(rest[at], int(g))
        row, ci, approx = (np.concatenate(part) for part in zip(*found, strict=True))
        kept = approx <= (best + 2 * slack)[row]
        kept &= ~np.isin(row, whole)
        return row[kept], ci[kept], whole
