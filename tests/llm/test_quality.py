"""The quality classifier: terms and votes against plain counting, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_support import SCHEMA

from spindle.llm import quality as q

M = 2**64


def mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD % M
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 % M
    return x ^ (x >> 33)


def bucket(h):
    return (mix(h) >> 40) % q.BUCKETS


def brute_terms(text):
    """Square roots of the terms' shares, counted one by one."""

    def kind(b):
        if chr(b) in " \t\x0b\x0c":
            return 1
        if chr(b) in "\r\n":
            return 2
        if chr(b).isdigit() and b < 128:
            return 3
        if b >= 128 or chr(b).islower():
            return 4
        return 5 if chr(b).isupper() else b + 6

    grams, words, again, n = Counter(), Counter(), [0] * len(q.LAGS), 0
    for at in range(0, len(text), q.PIECE):
        piece = text[at : at + q.PIECE]
        run = [kind(b) for b in piece]
        run = [k for i, k in enumerate(run) if i < q.RUN or run[i - q.RUN : i] != [k] * q.RUN]
        grams.update(bucket(a << 20 | b << 10 | c) for a, b, c in zip(run, run[1:], run[2:]))
        found = re.findall(rb"[^ \t\n\r\x0b\x0c]+", piece)
        low = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in found]
        words.update(bucket(sum((b + 1) * pow(int(q.BASE), i, M) for i, b in enumerate(w)) % M) for w in low)
        again = [x + sum(a == b for a, b in zip(low[lag:], low)) for x, lag in zip(again, q.LAGS)]
        n += len(low)
    out = np.zeros(q.WIDTH)
    for k, v in grams.items():
        out[k] = v / max(1, sum(grams.values()))
    for k, v in words.items():
        out[q.BUCKETS + k] = v / max(1, n)
    out[2 * q.BUCKETS :] = [x / max(1, n) for x in again]
    return np.sqrt(out), n > 0


def some_texts():
    r = random.Random(5)
    marks = "aB3 é.!#\n\t|日"
    return ["", " \n", "a", "One two TWO two\ttwo one!! ###", "x" * 300, *("".join(r.choice(marks) for _ in range(r.randrange(900))) for _ in range(40))]


@pytest.mark.parametrize("piece", [64, 1 << 20])
def test_terms_equal_plain_counts(monkeypatch, piece):
    monkeypatch.setattr(q, "PIECE", piece)
    q.hash_steps.cache_clear()
    texts = [t.encode() for t in some_texts()]
    x, any_word = q.term_vectors(texts)
    q.hash_steps.cache_clear()
    for row, has, t in zip(x, any_word, texts, strict=True):
        want, some = brute_terms(t)
        assert has == some
        np.testing.assert_allclose(row, want, rtol=1e-6)


def brute_scores(x, y, queries):
    """Every cosine by itself, in double precision."""
    mean = x.mean(axis=0, dtype=np.float64).astype(q.F32)
    axes = q.leading_directions(x - mean)
    unit = lambda z: z / max(np.sqrt(z @ z), 1e-12)
    space = [unit((r - mean) @ axes) for r in x]
    out = []
    for r in queries:
        own = unit((r - mean) @ axes)
        near = sorted(((float(own @ s), label) for s, label in zip(space, y)), reverse=True)
        last = near[min(q.NEIGHBOURS, len(near)) - 1][0]
        votes = [(max(c, q.TIE) ** q.POWER, label) for c, label in near if c >= last - q.TIE]
        out.append(sum(w * label for w, label in votes) / sum(w for w, _ in votes))
    return np.array(out)


def test_scores_equal_brute_force_and_hold_out(spark, sf, docs, rows):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r["doc_id"]: r for r in q.quality(docs, labels).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    learned = sorted(i for i in truth if zlib.crc32(str(i).encode()) % 4 != 2)
    text = dict(rows)
    x, has = q.term_vectors([(text[i] or "").encode() for i in learned])
    y = np.array([truth[i] for i in learned], float)
    ids = [i for i, _ in rows][::3]
    queries, some = q.term_vectors([(text[i] or "").encode() for i in ids])
    want = np.where(some, brute_scores(x[has], y[has], queries), q.NO_TERMS)
    np.testing.assert_allclose([got[i]["score"] for i in ids], want, atol=2e-3)
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.95


def test_odd_rows(spark, odd, odd_pairs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (11, 0), (16, 0), (9, 0), (9, 1), (None, 1), (7, None)], "doc_id BIGINT, quality INT")
    got = q.quality(odd, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in odd_pairs)
    assert {r["score"] for r in got if r["doc_id"] in (3, 4, 5)} == {q.NO_TERMS}
    assert len({r["score"] for r in got if r["doc_id"] == 9}) == 1
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_one_class_and_empty_tables(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1)], "doc_id BIGINT, quality INT")
    assert {(r["score"], r["predicted"]) for r in q.quality(docs, labels).collect()} == {(0.0, 0)}
    assert q.quality(docs, labels.limit(0)).count() == docs.count()
    assert q.quality(empty, labels).count() == 0
    rows = [(i, "calm words all along here" if i % 2 else "### $$$ !!!", "en", "s", 1) for i in range(40)]
    two = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id BIGINT, quality INT")
    got = q.quality(spark.createDataFrame(rows, SCHEMA), two).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)
