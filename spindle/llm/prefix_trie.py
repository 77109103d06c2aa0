"""A prefix trie of conversations: what shared beginnings hold and what storing them once would save.

1. A turn becomes the md5 of its role and text (16 bytes) and its length; a conversation the string of its turns' digests.
   Texts go no further than the first task.  Conversations are rebuilt (``rebuilt``) with the windows of their hundred.
2. Conversations are range-partitioned by ``(digest string, conv_id)``: a prefix's members stand together, and copies
   of one conversation, however many, spread over shards by conv_id.
3. Per shard the digests are encoded by a dictionary of their own (ranks, so the order stays) and the distinct sequences
   go into a ternary search tree, the median first, then the medians of both halves: a search among siblings takes
   at most log2(sequences) + 1 steps.  An iterative traversal from the leaves back adds up members, leaves and savings.
4. Only nodes on the path of a shard's first or last sequence can have members elsewhere.  All others are final.  These
   *boundary nodes* are merged by the digest of their prefix: what they sum over final nodes adds up by itself, for a
   final node lies in one shard.  What boundary nodes add to their ancestors needs their merged counts, and is added by
   one owner, the least shard that holds the node: it holds all ancestors too.

Edge cases: a null role or text counts as empty, a null turn comes first; equal turn numbers stand by the digest of role
and text, so repeated rows are turns of their own; a row without conv_id belongs to no conversation and is ignored; the
remainder of a negative conv_id is negative, as in SQL; an empty table has no nodes; extra columns are ignored.  A single
conversation's digests (20 bytes a turn) must fit into a task, its texts need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import pick, stored

GROUP = 100  # conversations c with the same c - c % GROUP borrow the first one's head
HEADS = 6  # so many different lengths a borrowed head can have, 0 included
SHARD_TURNS = 50_000  # turns of a shard, on average
CHUNK = 8192  # conv_ids listed in a row
ROWS = 20_000  # rows of an emitted batch
NO_ENDS = hashlib.sha256(b"").hexdigest()
CLOSED, BOUNDARY, ENDS = 0, 1, 2

SHARD_ROWS = """kind INT, shard INT, ref INT, depth INT, conv_id BIGINT, parent_conv_id BIGINT, n BIGINT, children BIGINT,
    leaves BIGINT, saved BIGINT, ends STRING, key BINARY, parent_key BINARY, fork INT, chars BIGINT, second BOOLEAN"""
FIELDS = [x.split()[0] for x in SHARD_ROWS.split(",")]


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, base, turns`` of every conversation: its turns in order as ``(turn, id, chars)``."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", F.md5(marked.cast("binary")).alias("id"), F.char_length(text).alias("chars"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    # Dealt by base, so that the windows over a hundred conversations need no other shuffle.
    rows = rows.select(base.alias("base"), "conv_id", turn.alias("t")).repartition("base")
    return rows.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, key, chars``: the digests of a conversation's rebuilt turns in one string, and their texts' lengths.

    With h = crc32(conv_id as text) % 6, the first h turns come from the first conversation of its hundred, if there
    is one, the others from its own after its first h."""
    head = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, HEADS - 1))
    head = F.first(head, ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    found = sequences(conversations).withColumn("head", head).withColumn("h", h)
    turns = "concat(slice(coalesce(head, slice(turns, 1, 0)), 1, h), slice(turns, h + 1, size(turns)))"
    found = found.select("conv_id", F.expr(turns).alias("turns"))
    key = "unhex(array_join(transform(turns, t -> t.id), ''))"
    return found.select("conv_id", F.expr(key).alias("key"), F.expr("transform(turns, t -> t.chars)").alias("chars"))


def ranks(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The rank of every 16-byte digest among the distinct ones, and where each distinct one stands first."""
    high, low = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2).T
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order[new]


class TernaryTree:
    """Trie nodes by number, the root 0; the children of a node are a binary search tree below ``down``."""

    def __init__(self):
        self.symbol, self.left, self.right, self.down = [-1], [-1], [-1], [-1]

    def _new(self, symbol: int) -> int:
        for column, value in ((self.symbol, symbol), (self.left, -1), (self.right, -1), (self.down, -1)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence from the root on, made where they are missing."""
        symbol, left, right, down = self.symbol, self.left, self.right, self.down
        node, path = 0, [0]
        for s in sequence:
            side, at = down, node
            here = down[node]
            while here >= 0 and symbol[here] != s:
                side, at = (left, here) if s < symbol[here] else (right, here)
                here = side[at]
            if here < 0:
                here = self._new(s)
                side[at] = here
            node = here
            path.append(node)
        return path

    def parents_first(self) -> tuple[list[int], list[int], list[int]]:
        """All nodes, every one after its parent, with parents and depths (by node)."""
        parent, depth = [-1] * len(self.symbol), [0] * len(self.symbol)
        order, stack = [0], [(self.down[0], 0)]
        while stack:
            here, above = stack.pop()
            if here < 0:
                continue
            parent[here], depth[here] = above, depth[above] + 1
            order.append(here)
            stack += ((self.left[here], above), (self.right[here], above), (self.down[here], here))
        return order, parent, depth


def medians_first(n: int) -> Iterator[int]:
    """0 to n - 1: the middle, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    while ranges:
        following = []
        for a, b in ranges:
            if a < b:
                middle = (a + b) // 2
                yield middle
                following += ((a, middle), (middle + 1, b))
        ranges = following


def shard_trie(shard: int, conv_ids: list[int], keys: list[bytes], chars: np.ndarray) -> Iterator[tuple]:
    """The rows of one shard, whose conversations come in order of ``(key, conv_id)``: nodes and lists of members."""
    first = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]] + [len(keys)]
    distinct = [keys[i] for i in first[:-1]]
    size = np.array([len(k) // 16 for k in distinct])
    joined = b"".join(distinct)
    rank, place = ranks(joined)
    # a distinct sequence's lengths are those of its first copy
    sizes = np.array([len(k) // 16 for k in keys])
    start = np.cumsum(sizes) - sizes
    own = np.repeat(start[first[:-1]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    length_of = chars[own][place].tolist()
    cuts = np.cumsum(size)[:-1]
    coded = [x.tolist() for x in np.split(rank, cuts)]

    tree, run_of, paths = TernaryTree(), {}, {}
    for i in medians_first(len(coded)):
        path = tree.insert(coded[i])
        run_of[path[-1]] = i
        if i in (0, len(coded) - 1):
            paths[i] = path
    order, parent, depth = tree.parents_first()
    a, b = paths[0], paths[len(coded) - 1]
    fork = max(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x == y)
    ref = {node: i for i, node in enumerate([*a, *b[fork + 1 :]])}  # the boundary nodes

    n, least = [0] * len(order), [None] * len(order)
    children, leaves, saved = [0] * len(order), [0] * len(order), [0] * len(order)
    for node, i in run_of.items():
        n[node], least[node] = first[i + 1] - first[i], conv_ids[first[i]]
    for node in reversed(order):
        closed = node not in ref
        if closed:  # what boundary nodes add themselves waits for their merged counts
            leaves[node] += not children[node]
            saved[node] += (n[node] - 1) * length_of[tree.symbol[node]]
        up = parent[node]
        if up >= 0:
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += closed
            leaves[up] += leaves[node]
            saved[up] += saved[node]

    digest = {-1: b""}
    for node in ref:  # along both paths, parents first
        at = 16 * int(place[tree.symbol[node]]) if node else 0
        step = joined[at : at + 16] if node else b""
        digest[node] = hashlib.md5(digest[parent[node]] + step).digest()
    for node in order:
        up = parent[node]
        run = run_of.get(node)
        members = conv_ids[first[run] : first[run + 1]] if run is not None else []
        if node not in ref:
            ends = hashlib.sha256(",".join(map(str, members)).encode()).hexdigest()
            known = None if up in ref else least[up]
            yield (CLOSED, shard, ref.get(up), depth[node], least[node], known, n[node], children[node], leaves[node], saved[node], ends, *[None] * 5)
            continue
        length = length_of[tree.symbol[node]] if node else 0
        yield (BOUNDARY, shard, ref[node], depth[node], least[node], None, n[node], children[node], leaves[node], saved[node], None,
               digest[node], digest[up] if up >= 0 else None, fork, length, ref[node] >= len(a))
        for i in range(0, len(members), CHUNK):
            listed = ",".join(map(str, members[i : i + CHUNK]))
            yield (ENDS, shard, i // CHUNK, *[None] * 7, listed, digest[node], *[None] * 4)


def shard_rows(found: DataFrame) -> DataFrame:
    """The rows of ``shard_trie`` for every range shard of the rebuilt conversations."""
    turns = found.agg(F.coalesce(F.sum(F.size("chars") + 1), F.lit(0))).first()[0]
    ranged = found.repartitionByRange(max(1, -(-turns // SHARD_TURNS)), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    schema = pa.schema([
        (name, {"INT": pa.int32(), "BIGINT": pa.int64(), "STRING": pa.string(), "BINARY": pa.binary(), "BOOLEAN": pa.bool_()}[kind])
        for name, kind in (x.split() for x in SHARD_ROWS.split(","))
    ])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import islice

        from pyspark import TaskContext

        conv_ids, keys, chars = [], [], [np.zeros(0, np.int32)]
        for batch in batches:
            conv_ids += batch.column("conv_id").to_pylist()
            keys += batch.column("key").to_pylist()
            chars.append(batch.column("chars").flatten().to_numpy(zero_copy_only=False))
        if keys:
            rows = shard_trie(TaskContext.get().partitionId(), conv_ids, keys, np.concatenate(chars))
            while some := list(islice(rows, ROWS)):
                columns = [pa.array(c, t) for c, t in zip(zip(*some, strict=True), schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return ranged.mapInArrow(kernel, SHARD_ROWS)


def end_hashes(lists: DataFrame) -> DataFrame:
    """``key, ends``: the hash of each boundary node's members, whose lists are streamed in order, a row at a time."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            keys, out = [], []
            for key, listed in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        out.append(state.hexdigest())
                    now, state = key, hashlib.sha256()
                    state.update(listed.encode())
                else:
                    state.update(b"," + listed.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])

    lists = lists.select("key", "shard", "ref", "ends").repartition("key").sortWithinPartitions("key", "shard", "ref")
    return lists.select("key", "ends").mapInArrow(kernel, "key BINARY, ends STRING")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    rows = stored(shard_rows(stored(rebuilt(conversations), "trie-sequences")), "trie-shards")
    part = rows.where(F.col("kind") == BOUNDARY)
    merged = part.groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("parent_key", "depth", "chars")], F.min("shard").alias("owner"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
    )
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    merged = merged.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0)))
    own = ((F.col("children") == 0).cast("bigint").alias("leaf"), ((F.col("n") - 1) * F.col("chars")).alias("save"))
    merged = stored(merged.select("*", *own), "trie-boundary")

    # What a shard's own boundary nodes add to those above them: sums up its one or two paths.
    mine = part.select("key", "shard", "second", "depth", "fork").join(merged.select("key", "owner", "leaf", "save"), "key")
    path = Window.partitionBy("shard", "second").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = []
    for c in ("leaf", "save"):
        value = F.when(F.col("owner") == F.col("shard"), F.col(c)).otherwise(0)
        branch = F.sum(F.when(F.col("second"), value).otherwise(0)).over(Window.partitionBy("shard"))
        hangs = ~F.col("second") & (F.col("depth") <= F.col("fork"))
        added.append((F.sum(value).over(path) + F.when(hangs, branch).otherwise(0)).alias(c))
    added = mine.select("key", *added).groupBy("key").agg(F.sum("leaf").alias("own_leaves"), F.sum("save").alias("own_saved"))

    columns = ["conv_id", "depth", "parent_conv_id", "n", "children", "leaves", "saved", "ends"]
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    lists = end_hashes(rows.where(F.col("kind") == ENDS))
    shared = merged.join(added, "key").join(parents, "parent_key", "left").join(lists, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n", "children", (F.col("leaves") + F.col("own_leaves")).alias("leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved"), F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
    )
    closed = rows.where(F.col("kind") == CLOSED)
    known = part.select("shard", "ref", "key").join(merged.select("key", F.col("conv_id").alias("found")), "key").select("shard", "ref", "found")
    hung = closed.where("ref IS NOT NULL").join(known, ["shard", "ref"]).withColumn("parent_conv_id", F.col("found"))
    out = closed.where("ref IS NULL").select(*columns).unionByName(hung.select(*columns)).unionByName(shared)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return out.select(*[F.col(c).cast("string" if c == "ends" else "bigint").alias(n) for c, n in zip(columns, names, strict=True)])
