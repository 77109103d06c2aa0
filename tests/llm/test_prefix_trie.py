"""The prefix trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from spindle.llm import prefix_trie as pt

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, mark, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c > 0 else -1)
        new = own.get(base, [])[:h] + turns[h:]
        for d in range(len(new) + 1):
            members[tuple(new[:d])].append((c, d == len(new)))
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c, last in sorted(who) if last)
        parent = min(members[p[:-1]])[0] if p else None
        out.append((min(who)[0], len(p), parent, len(who), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows, partitions=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    got = sorted((tuple(r) for r in pt.prefix_trie(df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def some_rows(n, seed, words=3):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot"]), "a b é"[: r.randrange(words)] * r.randrange(3)) for c in range(n) for t in range(r.randrange(1, 7))]


@pytest.mark.parametrize("size", [5, 40, 50_000])
def test_shards_of_any_size_give_the_same_nodes(spark, monkeypatch, size):
    """With few turns to a shard nearly every node is shared by several and merged."""
    monkeypatch.setattr(pt, "SHARD_TURNS", size)
    check(spark, some_rows(130, seed=size))


def test_copies_of_one_conversation_spread_over_shards(spark, monkeypatch):
    """A third of all conversations are equal: their members' lists come from several shards, in order."""
    monkeypatch.setattr(pt, "SHARD_TURNS", 60)
    monkeypatch.setattr(pt, "CHUNK", 7)
    rows = some_rows(120, seed=1) + [(1000 + 100 * c, t, "user", f"copy {t}") for c in range(60) for t in range(3)]
    check(spark, rows)


def test_odd_rows(spark, monkeypatch):
    """Nulls, ties, repeated rows, turnless rebuilt conversations, negative ids, a conversation of many turns."""
    monkeypatch.setattr(pt, "SHARD_TURNS", 100)
    rows = [
        (1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "bot", ""), (2, 3, "user", None), (None, 1, "user", "lost"),
        (-5, 0, "user", "x"), (-5, 1, "", "y"), (0, 0, "user", "x"), (101, 0, "u", "ser"), (102, 0, "us", "er"), (200, 5, "user", "\U0001f600é"),
        (300, 1, "a", "only turn"), (301, 1, "a", "only turn"), (302, 1, "b", "other"), (9223372036854775807, 1, "user", "x"),
    ]
    check(spark, rows + [(400, t, "user", f"turn {t % 7}") for t in range(250)] + [(401, t, "user", f"turn {t % 7}") for t in range(90)])


def test_extra_columns_and_empty_table(spark):
    from pyspark.sql import functions as F

    rows = some_rows(9, seed=3)
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.select("*", *[F.lit(1).alias(c) for c in ("key", "n", "base", "TEXT", "ends")])
    assert sorted(map(str, pt.prefix_trie(wide).collect())) == sorted(map(str, pt.prefix_trie(df).collect()))
    assert pt.prefix_trie(df.limit(0)).count() == 0


def test_ternary_tree_is_shallow():
    """Inserted medians first, a search among n siblings takes at most log2(n) + 1 steps."""
    tree = pt.TernaryTree()
    order = list(pt.medians_first(1000))
    assert sorted(order) == list(range(1000))
    for i in order:
        tree.insert([i, i])
    here, steps = [tree.down[0]], 0
    while here := [y for x in here for y in (tree.left[x], tree.right[x]) if y >= 0]:
        steps += 1
    assert steps <= 10
    assert len(tree.parents_first()[0]) == 2001
