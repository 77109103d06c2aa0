"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Every text becomes the set of its five-word shingles (hashed to 64 bits) and a signature of ``HASHES`` minima.
   Documents with equal sets are one *node* from here on (a 128-bit digest of the set), so copies cost nothing.
2. Signatures are cut into ``BANDS`` bands of ``ROWS`` values; nodes that agree in a band meet in its bucket.
   A pair at the threshold meets in no bucket with a chance of (1 - 0.75**4)**32 = 5e-6.
3. Candidates, in three passes; after each the links found merge nodes into components, and buckets within one
   component are closed.  First every node is paired with one hub only, the node that meets most others of all that share a
   bucket with it: at most one pair a node, however many buckets a large group shares, and in a group of near-copies
   the hub is one in its middle, which most of the group links with.  Then every node of an open bucket
   is paired with that bucket's hub.  Last, only nodes of buckets that, without their hub, still hold several
   components are compared, and of their pairs only those that can reach the threshold: with every set in one order,
   rarest shingle first, a pair that reaches it must share a shingle among the first ``|A| - need + 1`` of A and the
   first ``|B| - need + 1`` of B, where ``need`` is the overlap it needs.  This loses no pair and lists few: what a
   large group has in common stands last.  Pairs inside a component are never listed.
4. Sequential Bayesian verification: signatures are compared ``BATCH`` values at a time; after each batch a pair is
   pruned when the posterior chance that its similarity reaches the threshold, given the matches so far and a uniform
   prior, is below ``MISS``.
5. Survivors are verified exactly on the full shingle sets.

Components of the verified links are then found with a distributed star algorithm.

Edge cases: a text without words (or null) has the empty set, links with nothing and is its own component; a null
doc_id takes part through its text, but a component's id is the least doc_id that is not null (null if there is none),
and a row with a null doc_id is kept only then; repeated rows are one node and all get its component; rows that share a
doc_id but not a text are nodes of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import WordHashes, mix64, pick, process_cache, sheltered, shingle_hashes, slices, stored, utf8
from spindle.llm.graph import components

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BATCH = 16
HUB_DRAWS = 4
MISS = 1e-6  # chance at which a pair's reaching the threshold is given up
PART, WHOLE = 75, 100  # linked: WHOLE * |A and B| >= PART * |A or B|
BROADCAST_KEYS = 1_000_000  # 8-byte keys broadcast at most (8 MB); beyond, a shuffled join


@cache
def seeds() -> np.ndarray:
    return mix64(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Signature rows (uint32) of non-empty shingle sets: minima of ``HASHES`` re-hashings, all sets at once."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    flat = np.concatenate(sets)
    out = np.empty((len(sets), HASHES), np.uint32)
    low = (flat >> np.uint64(32)).astype(np.uint32) ^ flat.astype(np.uint32)
    high = flat.astype(np.uint32)
    with np.errstate(over="ignore"):
        for i, seed in enumerate(seeds()):
            # two independent 32-bit halves, re-mixed per function
            x = (low ^ np.uint32(seed & np.uint64(0xFFFFFFFF))) * np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(15)
            x += high * np.uint32((int(seed) >> 32) | 1)
            x *= np.uint32(0xC2B2AE35)
            x ^= x >> np.uint32(16)
            out[:, i] = np.minimum.reduceat(x, starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band and signature row."""
    with np.errstate(over="ignore"):
        key = np.broadcast_to(seeds()[:BANDS], (len(signature), BANDS)).copy()
        for j in range(ROWS):
            key = mix64(key ^ signature[:, j::ROWS][:, :BANDS].astype(np.uint64))
    return key.view(np.int64)


@cache
def least_matches(part: int = PART, whole: int = WHOLE, miss: float = MISS) -> list[int]:
    """For every number of compared values (a multiple of BATCH): the fewest matches that are not pruned.

    With a uniform prior and m matches out of n the posterior is Beta(m + 1, n - m + 1); its chance of reaching t is
    the binomial sum P(X <= m) for X ~ Binomial(n + 1, t).
    """
    from math import comb

    t = part / whole
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, 0
        while True:
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
            m += 1
        out.append(m)
    return out


def bayes_keep(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows survive the sequential comparison."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    for k, least in enumerate(least_matches()):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, cut] == b[alive, cut]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    keep = np.zeros(len(a), bool)
    keep[alive] = True
    return keep


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, signature`` per row; node and signature are null for empty sets."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo = process_cache("words", WordHashes)
        for s in slices(batches, "text"):
            sets = [shingle_hashes(t, memo) for t in utf8(s, "text")]
            full = [i for i, x in enumerate(sets) if len(x)]
            node: list[bytes | None] = [None] * len(sets)
            signature: list[bytes | None] = [None] * len(sets)
            if full:
                rows = signatures([sets[i] for i in full])
                for i, r in zip(full, rows, strict=True):
                    node[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                    signature[i] = r.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    s.column("doc_id"), s.column("text_key"), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(node, pa.binary()), pa.array(signature, pa.binary()),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "signature"],
            )

    rows = pick(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(kernel, "doc_id BIGINT, text_key BIGINT, n_shingles BIGINT, node BINARY, signature BINARY")


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """``key, node``: a row per node and band."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                raw = b"".join(b.column("signature").to_pylist())
                keys = band_keys(np.frombuffer(raw, np.uint32).reshape(-1, HASHES))
                at = pa.array(np.repeat(np.arange(b.num_rows), BANDS))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), b.column("node").take(at)], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(kernel, "key BIGINT, node BINARY")


def bayes_filter(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` that the sequential comparison of signatures does not prune."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES)
                    for c in ("sa", "sb")
                )
                keep = pa.array(bayes_keep(x, y))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    sig = nodes.select("node", "signature")
    a, b = (sig.select(F.col("node").alias(n), F.col("signature").alias(f"s{n}")) for n in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(kernel, "a BINARY, b BINARY")


def full_sets(involved: DataFrame, nodes: DataFrame, docs: DataFrame, tag: str) -> DataFrame:
    """``node, shingles`` (uint64, ascending) of the nodes in ``involved``.

    Sets are computed anew from the texts: found by a broadcast of their text keys where these are few enough, by a
    shuffled join otherwise.
    """
    keys = stored(involved.join(nodes, "node").select("text_key").distinct(), f"mh-keys-{tag}")
    few = keys.count() <= BROADCAST_KEYS
    texts = pick(docs, "text").withColumn("text_key", F.xxhash64("text"))
    texts = texts.join(F.broadcast(keys) if few else keys, "text_key", "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo = process_cache("words", WordHashes)
        for s in slices(batches, "text"):
            found = dict.fromkeys(utf8(s, "text"))
            raw = [shingle_hashes(t, memo).tobytes() for t in found]
            node = [xxhash.xxh3_128_digest(x) for x in raw]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(raw, pa.binary())], ["node", "shingles"])

    full = texts.mapInArrow(sets, "node BINARY, shingles BINARY").groupBy("node").agg(F.first("shingles").alias("shingles"))
    return stored(full, f"mh-sets-{tag}")


def exact_links(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "xa"):
            keep = []
            for x, y in zip(s.column("xa").to_pylist(), s.column("xb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(WHOLE * both >= PART * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([s.column("a").filter(keep), s.column("b").filter(keep)], ["a", "b"])

    a, b = (full.select(F.col("node").alias(n), F.col("shingles").alias(f"x{n}")) for n in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "xa", "xb").mapInArrow(verify, "a BINARY, b BINARY")


def prefix_pairs(full: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes with different ``root`` that can reach the threshold, by the prefixes of their sets.

    Shingles that only one node has can join nothing; they are counted, as they stand first in its order, and left out.
    """

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in slices(batches, "shingles"):
            sets = [np.frombuffer(x, np.int64) for x in s.column("shingles").to_pylist()]
            size = np.array([len(x) for x in sets], np.int32)
            at = np.repeat(np.arange(len(sets)), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets)), s.column("node").take(pa.array(at)), pa.array(size[at])],
                ["shingle", "node", "size"],
            )

    rows = full.select("node", "shingles").mapInArrow(tokens, "shingle BIGINT, node BINARY, size INT")
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = (
        rows.join(shared, "shingle")
        .groupBy("node")
        .agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
        .withColumn("alone", F.col("size") - F.size("s"))
        .withColumn("longest", F.col("size") - F.ceil(F.col("size") * PART / WHOLE) + 1 - F.col("alone"))
        .where("longest > 0")
        .select("node", "size", "alone", F.posexplode(F.expr("slice(s, 1, cast(longest AS INT))")).alias("pos", "x"))
        .select("node", "size", F.col("x.shingle").alias("shingle"), (F.col("pos") + F.col("alone")).alias("pos"))
        .join(roots, "node")
    )
    ordered = stored(ordered, "mh-prefixes")
    a, b = (ordered.select("shingle", *[F.col(c).alias(f"{c}_{n}") for c in ("node", "size", "pos", "root")]) for n in "ab")
    need = f"ceil({PART} * (size_a + size_b) / {PART + WHOLE})"
    can = f"""root_a <> root_b AND (size_a < size_b OR (size_a = size_b AND node_a < node_b))
        AND {WHOLE} * size_a >= {PART} * size_b AND pos_a <= size_a - {need} AND pos_b <= size_b - {need}"""
    return a.join(b, "shingle").where(can).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def open_buckets(busy: DataFrame, root: DataFrame) -> DataFrame:
    """The rows of the buckets that hold several components, with ``root``; a node in none yet is its own."""
    labelled = busy.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = labelled.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    return labelled.join(several.select("key"), "key")


def meeting_rows(members: DataFrame) -> DataFrame:
    """The rows of buckets with several nodes, with ``far``: minus the number of nodes its node meets, over its buckets.

    In a group of near-copies the node that meets most is the one in its middle, least changed."""
    size = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = members.join(size, "key")
    far = met.groupBy("node").agg((-F.sum("n")).alias("far"))
    return met.join(far, "node").select("key", "node", "far")


def with_hubs(rows: DataFrame, draw: Column) -> DataFrame:
    """Rows ``key, node, far, root`` with the bucket's hub as ``rank, hub, hub_root``: its node of least ``far``, of several
    the one of least hash under the draw."""
    rank = F.struct("far", F.xxhash64(draw, "node").alias("x")).alias("rank")
    hub = F.struct(rank, F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    return rows.join(rows.groupBy("key").agg(F.min(hub).alias("x")).select("key", "x.*"), "key")


def pairs_of(rows: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of ``node, hub``, each once."""
    return rows.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()


def placed_rows(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``described``, and ``node, doc_id, root`` of every node: its least doc_id and its component's root."""
    rows = stored(described(docs), "mh-rows")
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.first("signature").alias("signature"),
            F.min("text_key").alias("text_key"),
            F.min("doc_id").alias("doc_id"),
        ),
        "mh-nodes",
    )
    # Buckets of one node are gone after this; the rest is written once and read by every round.
    busy = stored(meeting_rows(bucket_rows(nodes)), "mh-buckets")

    def linked(pairs: DataFrame, tag: str) -> DataFrame:
        likely = stored(bayes_filter(pairs, nodes), f"mh-likely-{tag}")
        both = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        return stored(exact_links(likely, full_sets(both, nodes, docs, tag)), f"mh-links-{tag}")

    def merged(links: DataFrame, tag: str) -> DataFrame:
        return stored(components(links.selectExpr("a AS u", "b AS v")), f"mh-roots-{tag}")

    # One draw for all buckets, so that a group of copies agrees on a few hubs; a node takes the first of its buckets'.
    near = with_hubs(busy.withColumn("root", F.col("node")), F.lit(-1)).where("node <> hub").groupBy("node").agg(F.min(F.struct("rank", "hub"))["hub"].alias("hub"))
    links = linked(pairs_of(near), "1")
    # A few draws, not one per bucket: a group's buckets then share hubs, and fewer different pairs are compared.
    still = stored(with_hubs(open_buckets(busy, merged(links, "1")), F.pmod("key", F.lit(HUB_DRAWS))), "mh-still")
    links = links.unionByName(linked(pairs_of(still.where("root <> hub_root")), "2"))
    # The hub was compared with everyone in its bucket; the others are compared where they are in several components.
    rest = open_buckets(still.where("node <> hub").select("key", "node", "far"), merged(links, "2"))
    open_nodes = stored(rest.select("node", "root").distinct(), "mh-open")
    full = full_sets(open_nodes, nodes, docs, "open")
    likely = stored(bayes_filter(prefix_pairs(full, open_nodes), nodes), "mh-likely-open")
    links = links.unionByName(stored(exact_links(likely, full), "mh-links-open"))

    root = components(links.selectExpr("a AS u", "b AS v"))
    placed = nodes.select("node", "doc_id").join(root, "node", "left")
    return rows, stored(placed.select("node", "doc_id", F.coalesce("root", "node").alias("root")), "mh-placed")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key, kept`` for every row (``text_key``: a hash of the text)."""
    rows, placed = placed_rows(docs)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = placed.join(least, "root").select("node", "component_id")
    columns = ["doc_id", "n_shingles", "component_id", "text_key"]
    found = rows.where("node IS NOT NULL").join(classes, "node").select(*columns)
    empty = rows.where("node IS NULL").withColumn("component_id", F.col("doc_id")).select(*columns)
    return found.unionByName(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay: one row of every component, with all its columns.

    The row with the component's least doc_id stays, of several texts under it the one with the least hash, of repeated
    rows one; a row with a null doc_id stays where its component has no other.  Rows without words all stay.  What goes
    is found by ``(doc_id, hash of the text)``: broadcast where these pairs are few enough, joined by a shuffle otherwise.
    """
    docs, names = sheltered(docs, "doc_id", "text")
    rows, placed = placed_rows(docs)
    marked = rows.where("node IS NOT NULL").join(placed.select("node", "root"), "node")
    marked = marked.groupBy("doc_id", "text_key").agg(F.first("root").alias("root"), F.count(F.lit(1)).alias("n"))
    marked = stored(marked, "mh-marked")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n")).alias("x")
    stay_keys = stored(
        marked.groupBy("root").agg(least).select(F.col("x.doc_id").alias("id"), F.col("x.text_key").alias("key"), "x.n"), "mh-stay"
    )
    listed = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_key").eqNullSafe(F.col("key"))
    gone = marked.join(stay_keys, listed, "left_anti").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    gone = stored(gone, "mh-gone")
    again = stay_keys.where("n > 1").select("id", "key")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.xxhash64("text").eqNullSafe(F.col("key"))
    stay = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone, same, "left_anti")
    n_again = again.count()
    if not n_again:
        return stay.toDF(*names)
    again = F.broadcast(again) if n_again <= BROADCAST_KEYS else again
    one = stay.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.join(again, same, "left_anti").unionByName(one).toDF(*names)
