"""Embedding near-duplicates by PCA-ordered tiled comparison.

Equal vectors are one *node* (a digest of their bytes).  The second-moment matrix of all unit vectors is summed over
the cluster; its eigenvectors, largest eigenvalue first, are the axes.  Nodes are ordered by the first coordinate and
cut into tiles of about ``TILE`` vectors; a tile knows the box its leading coordinates fill.  Pairs of tiles whose boxes
are too far apart for any pair to reach the threshold are left out; every other pair of tiles is one group for one task.

In a tile pair, the leading quarter of the coordinates is multiplied first.  By Cauchy-Schwarz the rest can add at most
the product of the two suffix norms (one more column on each side of the same matrix product); pairs that cannot reach
the threshold stop there.  Survivors add the next coordinates and are bounded again, then finish in full.  A pair within
rounding of the threshold is decided by the plain formula on the given vectors.  Everything is in double precision.

A task returns link counts per node and a spanning set of links (never all pairs of a dense group), from which the
components are found by a distributed star algorithm.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are their
own component; vectors of different length never link; repeated rows count as vectors of their own; a null vec_id takes
part through its vector; a component's id is its least vec_id that is not null; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.llm.common import pick, stored
from spindle.llm.graph import components

THRESHOLD = 0.9
TILE = 4096
#: Coordinates drawn per tile for the cuts between tiles.
SAMPLE_PER_TILE = 128
STRIP = 512  # rows of the left tile compared at once
BOX = 8  # leading coordinates of a tile's box
SLACK = 1e-9  # far above the rounding of a dot product of unit vectors, far below any gap that matters


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest component so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def digested(vectors: DataFrame) -> DataFrame:
    """``vec_id, node, dim, vector``: float64 bytes and their digest; node is null where a vector cannot link."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            node, dim, raw = [], [], []
            for v in b.column("embedding"):
                x = np.array(v.values.cast(pa.float64()).to_numpy(zero_copy_only=False)) if v.is_valid else np.empty(0)
                ok = len(x) > 0 and bool(np.isfinite(x).all()) and bool((x != 0).any())
                data = (x + 0.0).tobytes() if ok else None  # + 0.0 turns -0.0 into 0.0
                node.append(xxhash.xxh3_128_digest(data) if ok else None)
                dim.append(len(x) if ok else None)
                raw.append(data)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(node, pa.binary()), pa.array(dim, pa.int32()), pa.array(raw, pa.binary())],
                ["vec_id", "node", "dim", "vector"],
            )

    return pick(vectors, "vec_id", "embedding").mapInArrow(kernel, "vec_id BIGINT, node BINARY, dim INT, vector BINARY")


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``dim, row numbers, unit vectors`` of a batch."""
    dims = batch.column("dim").to_numpy()
    raw = batch.column("vector").to_pylist()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, unit(np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(-1, d))


def axes(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the eigenvectors (columns, largest eigenvalue first) of the second-moment matrix of all nodes.

    Tasks sum their own vectors; what reaches the driver is one matrix per vector length.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _by_dim(b):
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(m[i, j])],
                ["dim", "i", "j", "v"],
            )

    cells = nodes.select("dim", "vector").mapInArrow(kernel, "dim INT, i INT, j INT, v DOUBLE")
    out: dict[int, np.ndarray] = {}
    for dim, i, j, v in cells.groupBy("dim", "i", "j").agg(F.sum("v")).collect():
        out.setdefault(dim, np.zeros((dim, dim)))[i, j] = out[dim][j, i] = v
    return {d: np.ascontiguousarray(np.linalg.eigh(m)[1][:, ::-1]) for d, m in out.items()}


def compare(x: np.ndarray, y: np.ndarray, same: bool, threshold: float, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the pairs that reach the threshold; of a tile with itself, each pair once."""
    ux, uy = unit(x), unit(y)
    rx, ry = ux @ basis, uy @ basis
    d = x.shape[1]
    first, second = max(1, d // 4), max(1, d // 2)
    least = threshold - SLACK

    def tail(r: np.ndarray, k: int) -> np.ndarray:
        return np.sqrt(np.einsum("ij,ij->i", r[:, k:], r[:, k:]))

    lead_x = np.column_stack([rx[:, :first], tail(rx, first)])
    lead_y = np.ascontiguousarray(np.column_stack([ry[:, :first], tail(ry, first)]).T)
    tail_x, tail_y = tail(rx, second), tail(ry, second)
    rows, cols = [], []
    for s in range(0, len(x), STRIP):
        bound = lead_x[s : s + STRIP] @ lead_y
        if same:
            bound[np.tril(np.ones(bound.shape, bool), s)] = -2.0
        i, j = np.nonzero(bound >= least)
        if not len(i):
            continue
        if 4 * len(i) > bound.size:  # too many survivors to gather: finish the strip in full
            cos = rx[s : s + STRIP] @ ry.T
            cos = cos[i, j]
            i = i + s
        else:
            i = i + s
            step = np.einsum("ij,ij->i", rx[i, :second], ry[j, :second])
            keep = step + tail_x[i] * tail_y[j] >= least
            i, j, step = i[keep], j[keep], step[keep]
            cos = step + np.einsum("ij,ij->i", rx[i, second:], ry[j, second:])
        close = np.abs(cos - threshold) <= SLACK
        if close.any():  # decided by the plain formula
            a, b = x[i[close]], y[j[close]]
            norms = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
            with np.errstate(all="ignore"):
                plain = np.einsum("ij,ij->i", a, b) / norms
            cos[close] = np.where(np.isfinite(plain) & (norms > 0), plain, cos[close])
        hit = cos >= threshold
        rows.append(i[hit])
        cols.append(j[hit])
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *rows]), np.concatenate([empty, *cols])


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``place, least place of its component`` that connect what the pairs ``i, j`` of ``n`` places connect."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = stored(digested(vectors), "emb-rows")
    good = rows.where("node IS NOT NULL")
    nodes = good.groupBy("node").agg(
        F.first("dim").alias("dim"),
        F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("n"),
        F.min("vec_id").alias("vec_id"),
    )
    nodes = stored(nodes, "emb-nodes")
    basis = nodes.sparkSession.sparkContext.broadcast(axes(nodes))  # one dim x dim matrix per vector length

    def coordinate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = np.zeros(b.num_rows)
            for d, at, x in _by_dim(b):
                first[at] = x @ basis.value[d][:, 0]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("dim"), pa.array(first)], ["node", "dim", "c"])

    # Tiles: quantiles of the first coordinate, then equal steps of a hash where a quantile is overfull (ties).
    placed = stored(nodes.select("node", "dim", "vector").mapInArrow(coordinate, "node BINARY, dim INT, c DOUBLE"), "emb-place")
    cuts: dict[int, np.ndarray] = {}
    for dim, n in placed.groupBy("dim").count().collect():
        k = -(-n // tile)
        shares = [i / k for i in range(1, k)]
        # Cuts only balance the tiles, so a sample that grows with the tiles alone is enough.
        some = placed.where(F.col("dim") == dim).sample(min(1.0, SAMPLE_PER_TILE * k / n), seed=7)
        got = some.agg(F.percentile_approx("c", shares, 10 * k + 1000)).first()[0] if shares else []
        cuts[dim] = np.unique(np.array(got or [], np.float64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, c = b.column("dim").to_numpy(), b.column("c").to_numpy()
            q = np.zeros(b.num_rows, np.int32)
            for d in np.unique(dims):
                at = dims == d
                q[at] = np.searchsorted(cuts[int(d)], c[at], "right")
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("dim"), pa.array(q)], ["node", "dim", "q"])

    dealt = stored(placed.mapInArrow(deal, "node BINARY, dim INT, q INT"), "emb-dealt")
    steps = dealt.groupBy("dim", "q").agg(F.ceil(F.count(F.lit(1)) / (1.5 * tile)).alias("steps"))
    dealt = dealt.join(steps, ["dim", "q"]).withColumn("step", F.pmod(F.xxhash64("node"), F.col("steps")))
    dealt = dealt.select("node", "q", "step").join(nodes.drop("vec_id"), "node")

    def pack(table: pa.Table) -> pa.Table:
        """A tile as one row: its nodes, multiplicities, vectors (float32 where that loses nothing) and box."""
        table = table.combine_chunks()
        dim = table.column("dim")[0].as_py()
        x = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(-1, dim)
        with np.errstate(over="ignore"):
            short = x.astype(np.float32)
        half = bool((short == x).all())
        lead = unit(x) @ basis.value[dim][:, :BOX]
        return pa.Table.from_pylist(
            [
                {
                    "dim": dim, "q": table.column("q")[0].as_py(), "step": table.column("step")[0].as_py(),
                    "nodes": b"".join(table.column("node").to_pylist()),
                    "copies": table.column("n").to_numpy().astype("<i8").tobytes(),
                    "half": half, "vectors": (short if half else x).tobytes(),
                    "low": lead.min(axis=0).tolist(), "high": lead.max(axis=0).tolist(),
                }
            ],
            pa.schema(
                [("dim", pa.int32()), ("q", pa.int32()), ("step", pa.int64()), ("nodes", pa.binary()), ("copies", pa.binary()),
                 ("half", pa.bool_()), ("vectors", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]
            ),
        )

    packed = dealt.groupBy("dim", "q", "step").applyInArrow(
        pack,
        "dim INT, q INT, step BIGINT, nodes BINARY, copies BINARY, half BOOLEAN, vectors BINARY, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>",
    )
    packed = stored(packed, "emb-tiles")
    # One row per tile (about 4,000 vectors): numbers 0, 1, 2 ... per vector length.
    number = F.row_number().over(Window.partitionBy("dim").orderBy("q", "step")) - 1
    boxes = stored(packed.select("dim", "q", "step", "low", "high").withColumn("t", number), "emb-boxes")
    last = boxes.groupBy("dim").agg(F.max("t").alias("last"))
    left = boxes.join(last, "dim").select(
        "dim", F.col("t").alias("i"), F.col("low").alias("li"), F.col("high").alias("hi"), F.explode(F.sequence("t", "last")).alias("j")
    )
    right = boxes.select("dim", F.col("t").alias("j"), F.col("low").alias("lj"), F.col("high").alias("hj"))
    gap = "aggregate(zip_with(zip_with(li, hj, (a, b) -> a - b), zip_with(lj, hi, (a, b) -> a - b), (a, b) -> greatest(a, b, 0D)), 0D, (s, g) -> s + g * g)"
    # unit vectors with cosine t are sqrt(2 - 2 t) apart, and their leading coordinates no farther
    pairs = left.join(right, ["dim", "j"]).where(F.expr(gap) <= 2 - 2 * threshold + SLACK).select("dim", "i", "j")
    ends = pairs.select("dim", "i", "j", F.col("i").alias("t")).unionByName(
        pairs.where("i < j").select("dim", "i", "j", F.col("j").alias("t"))
    )
    payload = packed.join(boxes.select("dim", "q", "step", "t"), ["dim", "q", "step"])
    groups = ends.join(payload.select("dim", "t", "nodes", "copies", "half", "vectors"), ["dim", "t"])

    def links(table: pa.Table) -> pa.Table:
        tiles = sorted(table.to_pylist(), key=lambda r: r["t"])
        dim = tiles[0]["dim"]
        x, y = (
            np.frombuffer(r["vectors"], np.float32 if r["half"] else np.float64).astype(np.float64).reshape(-1, dim)
            for r in (tiles[0], tiles[-1])
        )
        same = len(tiles) == 1
        i, j = compare(x, y, same, threshold, basis.value[dim])
        names = [tiles[0]["nodes"][k : k + 16] for k in range(0, 16 * len(x), 16)]
        copies = np.frombuffer(tiles[0]["copies"], "<i8")
        if not same:
            names += [tiles[1]["nodes"][k : k + 16] for k in range(0, 16 * len(y), 16)]
            copies = np.concatenate([copies, np.frombuffer(tiles[1]["copies"], "<i8")])
            j = j + len(x)
        count = np.zeros(len(names), np.int64)
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        touched = np.flatnonzero(count)
        at, to = spanning(i, j, len(names))
        rows = [(names[k], None, int(count[k])) for k in touched.tolist()]
        rows += [(names[a], names[b], 0) for a, b in zip(at.tolist(), to.tolist(), strict=True)]
        columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["u", "v", "n"])

    found = stored(groups.groupBy("dim", "i", "j").applyInArrow(links, "u BINARY, v BINARY, n BIGINT"), "emb-links")
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("links"))
    root = components(found.where("v IS NOT NULL").select("u", "v"))
    placed = nodes.select("node", "n", "vec_id").join(root, "node", "left").join(counts, "node", "left")
    placed = placed.select(
        "node", "vec_id", F.coalesce("root", "node").alias("root"),
        (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    placed = stored(placed, "emb-placed")
    least = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    classes = placed.join(least, "root").select("node", "n_links", "component_id")
    linked = good.select("vec_id", "node").join(classes, "node").select("vec_id", "n_links", "component_id")
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
