"""Toxicity, MinHash, embeddings and the pipeline against brute force and held-out accuracy."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_support import odd_rows, same_rows

from spindle.llm import embed_dedup, minhash, rnn, toxicity
from spindle.llm.graph import components


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


# MinHash ------------------------------------------------------------------------------------------------------


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    import re

    words = re.findall("[^\x20\x09-\x0d]+", words)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_near(pairs):
    sets = [shingles(t) for _, t in pairs]
    index = defaultdict(list)
    u = Union()
    for k, s in enumerate(sets):
        u.find(k)
        for x in s:
            index[x].append(k)
    shared = Counter(p for ks in index.values() for p in itertools.combinations(sorted(set(ks)), 2))
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            u.join(a, b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        r = u.find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    for k, (i, _) in enumerate(pairs):
        yield i, len(sets[k]), least[u.find(k)], i == least[u.find(k)]


@pytest.mark.parametrize("which", ["docs", "odd", "empty"])
def test_near_duplicates(request, which, rows, odd_pairs):
    pairs = {"docs": rows, "odd": odd_pairs, "empty": []}[which]
    same_rows(minhash.near_duplicates(request.getfixturevalue(which)), brute_near(pairs), ["doc_id", "n_shingles", "component_id", "kept"])


def test_chains_links_and_passages(spark):
    """Near copies that only chain, groups that share a passage, and pairs just above and below the threshold."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(10**6)}"
    texts = []
    base = [word() for _ in range(120)]
    for step in range(12):  # each differs from the one before in a few words
        base = list(base)
        base[10 * step % 120] = word()
        texts.append(" ".join(base))
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(n)) for n in (5, 10, 15, 17, 18, 20, 40, 200) for _ in range(4)]
    for cut in range(0, 40, 2):
        a = [word() for _ in range(100)]
        texts += [" ".join(a), " ".join(a[cut:])]
    pairs = [(int(i), t) for i, t in enumerate(texts)]
    rng.shuffle(pairs)
    pairs = [(int(i), str(t)) for i, t in pairs]
    df = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")
    same_rows(minhash.near_duplicates(df), brute_near(pairs), ["doc_id", "n_shingles", "component_id", "kept"])


def test_pairs_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    """Copies of one text with a few changed words each: those near its middle meet there, so few pairs are left."""
    rng = np.random.default_rng(7)
    base = [f"b{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(240):
        own = list(base)
        for at in rng.choice(29, 2 + i % 4, replace=False):  # five shingles each; with up to four the middle is linked
            own[5 * int(at) + 5] = f"e{i}_{at}"
        texts.append(" ".join(own))
    pairs = [(i, t) for i, t in enumerate(texts)]
    listed = []
    whole = minhash.bayes_filter

    def counted(found, nodes):
        listed.append(found.count())
        return whole(found, nodes)

    monkeypatch.setattr(minhash, "bayes_filter", counted)
    df = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")
    same_rows(minhash.near_duplicates(df), brute_near(pairs), ["doc_id", "n_shingles", "component_id", "kept"])
    assert len(listed) == 3 and listed[0] <= len(texts) and listed[2] <= len(texts), listed


def test_hubs_are_the_nodes_that_meet_most(spark):
    members = [(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "b"), (3, "d"), (4, "e")]
    rows = minhash.meeting_rows(spark.createDataFrame([(k, n.encode()) for k, n in members], "key BIGINT, node BINARY"))
    hubs = minhash.with_hubs(rows.withColumn("root", rows.node), rows.key).collect()
    assert {(r["key"], bytes(r["node"]), bytes(r["hub"])) for r in hubs} == {(k, n.encode(), b"b") for k, n in members[:-1]}


def test_sequential_pruning_bounds():
    least = minhash.least_matches()
    assert len(least) == minhash.HASHES // minhash.BATCH and least == sorted(least)
    for k, m in enumerate(least):  # the bound by its definition
        n = (k + 1) * minhash.BATCH
        tail = lambda m: sum(math.comb(n + 1, x) * 0.75**x * 0.25 ** (n + 1 - x) for x in range(m + 1))
        assert tail(m) >= minhash.MISS and (m == 0 or tail(m - 1) < minhash.MISS)
    a = np.random.default_rng(1).integers(0, 2**32, (3, minhash.HASHES), dtype=np.uint32)
    b = a.copy()
    b[1, : minhash.BATCH] += 1
    b[2, ::5] += 1
    assert minhash.bayes_keep(a, b).tolist() == [True, False, True]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    x = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    s = minhash.signatures([x, np.sort(x[:3000]), x[3000:]])
    assert abs((s[0] == s[1]).mean() - 0.75) < 0.12
    assert (s[1] == s[2]).mean() < 0.05


def test_drop_near_duplicates_keeps_one_row_per_group(docs, odd, rows):
    kept = Counter(i for i, _, _, k in brute_near(rows) if k)
    assert Counter(r["doc_id"] for r in minhash.drop_near_duplicates(docs).collect()) == kept
    got = Counter(r[0] for r in minhash.drop_near_duplicates(odd).collect())
    want = {i for i, _, _, k in brute_near([(r[0], r[1]) for r in odd_rows()]) if k}
    assert set(got) - {None} == want - {None} and got[9] == 1


def test_drop_near_duplicates_counts_rows_per_text(spark, odd):
    clean, other = ("one text of its own with words enough to compare", "quite another text that shares nothing with it at all")
    base = [f"w{i}" for i in range(60)]
    near, edited = " ".join(base), " ".join(base[:-1])
    pairs = [(1, clean), (1, other), (None, near), (None, near), (None, edited), (2, "a b c d e f"), (2, "a b c d e f")]
    pairs += [(3, "A B c d e f"), (None, "a b C d e f"), (4, ""), (4, ""), (None, None), (None, None), (None, "x y z")]
    df = spark.createDataFrame(pairs, "doc_id BIGINT, text STRING")
    got = Counter((r[0], r[1]) for r in minhash.drop_near_duplicates(df).collect())
    group = [k for k in ((None, near), (None, edited)) if k in got]
    assert len(group) == 1 and got.pop(group[0]) == 1
    assert got == Counter({
        (1, clean): 1, (1, other): 1, (2, "a b c d e f"): 1, (4, ""): 2, (None, None): 2, (None, "x y z"): 1,
    })
    got = Counter(r[0] for r in minhash.drop_near_duplicates(odd).collect())
    assert got[10] == 2 and got[9] == 1 and got[None] == 1


def test_operators_pass_clashing_columns_through(spark, odd):
    from spindle.llm import mixing, secret_scan

    labels = spark.createDataFrame([(16, 1), (1, 0)], "doc_id BIGINT, toxic INT")
    for out in (minhash.drop_near_duplicates(odd), mixing.mix_documents(odd), secret_scan.redact_secrets(odd), toxicity.drop_toxic(odd, labels)):
        assert out.columns == odd.columns and out.count() > 0


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(5000, 5001 + i) for i in range(50)]
    u = Union()
    for a, b in edges:
        u.join(a, b)
    least = {}
    for x in u.up:
        r = u.find(x)
        least[r] = min(least.get(r, x), x)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "u BIGINT, v BIGINT"))
    same_rows(got, [(x, least[u.find(x)]) for x in linked], ["node", "root"])
    assert components(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


# Embeddings ---------------------------------------------------------------------------------------------------


def brute_vectors(rows, threshold=0.9):
    ok = []
    for _, v in rows:
        x = None if not v or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v, float)
        ok.append(None if x is None else x / np.abs(x).max())
    u, links = Union(), Counter()
    for a in range(len(rows)):
        u.find(a)
        for b in range(a):
            x, y = ok[a], ok[b]
            if x is not None and y is not None and len(x) == len(y):
                if float(x @ y) / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= threshold:
                    u.join(a, b)
                    links[a] += 1
                    links[b] += 1
    least = {}
    for k, (i, _) in enumerate(rows):
        r = u.find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    for k, (i, _) in enumerate(rows):
        yield i, links[k], least[u.find(k)], i is None and least[u.find(k)] is None or i == least[u.find(k)]


COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def test_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    same_rows(embed_dedup.near_vectors(df, tile=100), brute_vectors(rows), COLUMNS)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [3.0, 4.0])]
    rows += [(10, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [2.0, 0.0]), (12, [1.0, -0.0]), (13, [1.0, 0.0, 0.0]), (14, [1e300, 1e299])]
    rows += [(15, [1e-300, 1e-299]), (16, [-1.0, 0.0]), (17, [5.0]), (18, [7.0]), (19, [-7.0])]
    rows += [(100 + i, [float(x) for x in rng.standard_normal(2)]) for i in range(60)]
    rows += [(200 + i, [float(x) for x in rng.standard_normal(5) + [3, 0, 0, 0, 0]]) for i in range(80)]
    rows += [(300 + i, [1.0, 2.0, 3.0]) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, node INT, n INT")
    same_rows(embed_dedup.near_vectors(df, tile=16), brute_vectors(rows), COLUMNS)
    none = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert embed_dedup.near_vectors(none).count() == 0


def test_compare_finishes_in_full_when_many_survive():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((700, 8)) + [6, 0, 0, 0, 0, 0, 0, 0]
    q = np.linalg.qr(rng.standard_normal((8, 8)))[0]
    i, j = embed_dedup.compare(x, x, True, 0.9, q)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.triu(u @ u.T >= 0.9, 1))
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(a.tolist(), b.tolist(), strict=True))


# Toxicity -----------------------------------------------------------------------------------------------------


def test_gradients_by_finite_differences(monkeypatch):
    monkeypatch.setattr(rnn, "F32", np.float64)
    p = {k: v.astype(np.float64) for k, v in rnn.new_parameters(3).items()}
    words = rnn.describe_words([b"", b"alpha", b"be", b"gamma"])
    windows, mask = np.array([[1, 2, 3, 0], [3, 1, 0, 0], [0, 0, 0, 0]]), np.array([[1, 1, 1, 0], [1, 1, 0, 0], [0, 0, 0, 0]], float)
    weight = np.array([0.3, -0.7, 0.2])

    def loss():
        vectors = rnn.word_vectors(p, words)
        return float((rnn.forward(p, rnn.word_inputs(p, vectors), windows, mask) * weight).sum())

    vectors = rnn.word_vectors(p, words)
    _, kept = rnn.forward(p, rnn.word_inputs(p, vectors), windows, mask, keep=True)
    grads = rnn.backward(p, words, vectors, np.ones_like(vectors), windows, kept, weight)
    rng = np.random.default_rng(0)
    for name, g in grads.items():
        if isinstance(g, tuple):
            full = np.zeros_like(p[name])
            full[g[0]] = g[1]
            g = full
        at = np.argwhere(np.abs(g) > 1e-9)
        for j in at[rng.choice(len(at), min(4, len(at)), replace=False)]:
            j, old = tuple(j), p[name][tuple(j)]
            p[name][j] = old + 1e-5
            up = loss()
            p[name][j] = old - 1e-5
            down = loss()
            p[name][j] = old
            assert abs(g[j] - (up - down) / 2e-5) < 1e-6, name


def test_windows_cover_every_word():
    for n in range(0, 400):
        starts = toxicity.window_starts(n)
        seen = {w for s in starts for w in range(s, min(n, s + toxicity.WINDOW))}
        assert seen == set(range(n))
        assert all(b - a < toxicity.WINDOW for a, b in zip(starts, starts[1:], strict=False))


@pytest.fixture(scope="module")
def bigger(spark):
    sf = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_toxicity_held_out(bigger):
    docs, labels = bigger
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").cache()
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] in got}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [i for i in got if got[i]["held_out"]]
    pos = np.array([got[i]["score"] for i in held if truth[i]])
    neg = np.array([got[i]["score"] for i in held if not truth[i]])
    assert (pos[:, None] > neg[None, :]).mean() > 0.95
    assert (pos >= 0.7).mean() > 0.8 and (neg >= 0.7).mean() < 0.04
    docs.unpersist()


def test_toxicity_odd_rows(spark, odd, empty, sf):
    labels = spark.createDataFrame([(16, 1, 1), (1, 0, 1), (2, 0, 1), (7, 0, 1), (None, 1, 1), (13, None, 0)], "doc_id BIGINT, toxic INT, quality INT")
    got = toxicity.toxicity(odd, labels)
    assert got.count() == len(odd_rows())
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert {r["held_out"] for r in got.where("doc_id IS NULL").collect()} == {False}
    assert toxicity.toxicity(empty, labels).count() == 0
    nothing = toxicity.toxicity(odd, labels.where("toxic = 0"))
    assert {(r["score"], r["predicted"]) for r in nothing.collect()} == {(0.0, 0)}


def test_held_out_labels_are_not_read(spark, docs, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.training_windows(docs, x).collect())) for x in (labels, flipped))
    assert a == b and len(a) > 0


def test_toxic_documents_are_learned_whole(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(3000))
    toxic = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    clean = [i for i in range(100, 130) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, long if i == toxic[0] else f"bad {i} " * 5) for i in toxic] + [(i, long) for i in clean] + [(toxic[1], None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, 1) for i in toxic] + [(i, 0) for i in clean], "doc_id BIGINT, toxic INT")
    windows = Counter(r["doc_id"] for r in toxicity.training_windows(docs, labels).collect())
    assert windows[toxic[0]] == len(toxicity.window_starts(3000)) > toxicity.SAMPLE_WINDOWS
    assert all(windows[i] == toxicity.SAMPLE_WINDOWS for i in clean)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 10_000)  # the long one goes as a whole, the short ones stay
    fewer = Counter(r["doc_id"] for r in toxicity.training_windows(docs, labels).collect())
    assert set(windows) - set(fewer) == {toxic[0]}
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 0)  # the shortest is kept
    assert len({r["doc_id"] for r in toxicity.training_windows(docs, labels).where("toxic = 1").collect()}) == 1


def test_training_drops_what_other_operators_left_in_a_worker(docs, sf, monkeypatch):
    import sys

    from spindle.llm.common import process_cache

    kernels, labels = [], docs.sparkSession.read.parquet(f"{sf}/labels.parquet")
    run = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, kernel, *a: kernels.append(kernel) or run(df, kernel, *a))
    toxicity.fit(docs.limit(0), labels)
    assert len(kernels) == 2  # the windows, the model
    for kernel in kernels:
        process_cache("words", dict)
        assert list(kernel(iter([]))) == []
        assert sys.modules["_spindle_llm_cache"].value is None


def window_batches(rows):
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("start", pa.int64()), ("words", pa.binary())])
    return [pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in part], schema) for part in rows]


def test_sample_holds_each_word_once():
    rows = [(3, 1, 0, b"b a"), (3, 1, 16, b"a c a"), (5, 0, 0, b"")], [(9, 0, 0, b"c z")]
    sample = toxicity.Sample(iter(window_batches(rows)))
    assert sample.words == [b"", b"a", b"b", b"c", b"z"] and sample.both()
    assert [w[:n].tolist() for w, n in zip(sample.windows, sample.size, strict=True)] == [[2, 1], [1, 3, 1], [], [3, 4], []]
    assert sample.mask(slice(None)).sum(axis=1).tolist() == [2, 3, 0, 2, 0] and not sample.windows[2].any()
    assert sample.y.tolist() == [1, 1, 0, 0, 0] and [x.tolist() for x in sample.by_doc] == [[0, 1], [2], [3]]
    nothing = toxicity.Sample(iter([]))
    assert not nothing.both() and len(nothing.windows) == 1
    assert toxicity.train(toxicity.Sample(iter(window_batches(rows[1:])))) is None


def test_training_needs_little_beside_its_sample():
    """20,000 windows with 160,000 words: what training holds at most, counted by Python."""
    import tracemalloc

    batches = window_batches([[(i // 10, i // 10 % 2, i % 10 * 16, b" ".join(b"word%d" % ((i * 8 + j) % 160_000) for j in range(32))) for i in range(20_000)]])
    tracemalloc.start()
    try:
        model = toxicity.train(toxicity.Sample(iter(batches)), epochs=1)
        assert model is not None and tracemalloc.get_traced_memory()[1] < 90 << 20
    finally:
        tracemalloc.stop()


def test_words_are_described_in_pieces(monkeypatch):
    words = [b"", b"alpha", b"be", b"gamma", b"delta-epsilon"]
    whole = rnn.describe_words(words)
    monkeypatch.setattr(rnn, "DESCRIBED", 2)
    parts = rnn.describe_words(words)
    for name in ("row", "grams", "start", "count"):
        assert getattr(whole, name).tolist() == getattr(parts, name).tolist()


def test_memo_of_words_grows_and_starts_anew(monkeypatch):
    model = {"p": rnn.new_parameters(2), "shift": 0.0, "scale": 1.0}
    texts = [b"one two three", b"four five", b"six seven eight nine ten eleven", b"", b"one two"]
    want = toxicity.Scorer(model).logits(texts)
    monkeypatch.setattr(toxicity, "MEMO_WORDS", 3)
    small = toxicity.Scorer(model)
    assert np.allclose(small.logits(texts), want) and len(small.known) > 3
    assert np.allclose([small.logits([t])[0] for t in texts], want)


def test_stages_hand_texts_over_in_batches_of_bounded_bytes(spark, sf):
    import corpus_pipeline
    import pyarrow as pa

    from spindle.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["size"])

    texts = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('x', 10000) AS text", "'en' AS lang", "'a' AS source", "10000L AS n_chars")
    before = spark.conf.get(common.BATCH_BYTES, None)
    try:
        for stage in (corpus_pipeline.toxicity, corpus_pipeline.near_dedup, corpus_pipeline.secrets, corpus_pipeline.bpe):
            spark.conf.unset(common.BATCH_BYTES)
            stage(spark, texts.limit(0), sf)
            found = [r["size"] for r in texts.mapInArrow(sizes, "size BIGINT").collect()]
            assert sum(found) > 2000 * 10_000 and max(found) < common.SLICE_BYTES + 200_000
        spark.conf.set(common.BATCH_BYTES, "7m")  # what the session says holds
        corpus_pipeline.secrets(spark, texts.limit(0), sf)
        assert spark.conf.get(common.BATCH_BYTES) == "7m"
    finally:
        spark.conf.set(common.BATCH_BYTES, before) if before else spark.conf.unset(common.BATCH_BYTES)


def test_units_cover_long_words():
    assert toxicity.units_of(b"a bc " + b"d" * 48) == [b"a", b"bc", b"d" * 48]
    for n in (49, 80, 81, 1000):
        word = bytes(97 + i * i % 26 for i in range(n))
        pieces = toxicity.units_of(word)
        joined = pieces[0] + b"".join(x[toxicity.OVERLAP :] for x in pieces[1:])
        assert joined == word and all(len(x) <= toxicity.PIECE for x in pieces)
        assert all(any(word[i : i + 16] in x for x in pieces) for i in range(n - 15))


def brute_logit(p, text):
    """The highest logit of a text's windows, each word, step and window by itself, in double precision."""

    def inputs(word):
        d = rnn.describe_words([word])
        return np.concatenate([p["word"][d.row[0]], np.mean([p["char"][g] for g in d.grams], axis=0)]).astype(float)

    def run(xs, side):
        h, states = np.zeros(rnn.HIDDEN), []
        for x in xs:
            g, u = x @ p["wx"][side] + p["bx"][side][0], h @ p["wh"][side]
            n = rnn.HIDDEN
            z, r = (1 / (1 + np.exp(-(g[k : k + n] + u[k : k + n]))) for k in (0, n))
            h = h + (1 - z) * (np.tanh(g[2 * n :] + r * u[2 * n :]) - h)
            states.append(h)
        return states

    words = []
    for w in text.lower().split():
        at = 0
        while True:  # a long word as pieces of 48 bytes, each beginning 32 after the one before
            words.append(w[at : at + 48])
            if at + 48 >= len(w):
                break
            at += 32
    last = max(0, len(words) - toxicity.WINDOW)
    logits = []
    for start in sorted({min(s, last) for s in range(0, last + toxicity.STRIDE, toxicity.STRIDE)}):
        xs = [inputs(w) for w in words[start : start + toxicity.WINDOW]]
        if not xs:
            return float(p["bo"][0])
        hs = np.array([np.concatenate(s) for s in zip(run(xs, 0), run(xs[::-1], 1)[::-1], strict=True)])
        e = np.exp(np.tanh(hs @ p["wa"]) @ p["va"])
        logits.append(float(e / e.sum() @ hs @ p["wo"] + p["bo"][0]))
    return max(logits)


def test_scores_equal_brute_force(spark, docs, rows, sf):
    """Every 8th text of the table and the odd ones, against the plain recurrence over all their windows."""
    import pickle

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fitted = toxicity.fit(docs, labels)
    assert fitted == toxicity.fit(docs.repartition(5), labels)  # the same sample, the same model
    model = pickle.loads(fitted)
    texts = [(i, t) for i, t in rows[::8]] + [(r[0], r[1]) for r in odd_rows() if r[0] not in (7, 8)]
    df = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = Counter((r["text"], round(r["toxicity"], 9)) for r in toxicity.score_documents(df, fitted).collect())
    score = dict(got.keys())
    assert len(score) == len(got)  # one score for one text
    for text in {t for _, t in texts}:
        x = brute_logit(model["p"], (text or "").encode()) - model["shift"] + math.log(0.7 / 0.3)
        assert score[text] == pytest.approx(1 / (1 + math.exp(-x)), abs=2e-3)


# Pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline(spark, docs, sf, tmpdir_fresh):
    import corpus_pipeline as cp

    from spindle.llm import bpe, mixing, secret_scan
    from spindle.llm.toxicity import fit, score_documents

    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "bpe"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    scores = {r["doc_id"]: r["toxicity"] for r in score_documents(docs, fit(docs, labels)).collect()}
    rows = {i: r for i, r in rows.items() if scores[i] < 0.7}
    stay = {i for i, _, _, k in brute_near([(i, r["text"]) for i, r in rows.items()]) if k}
    rows = {i: r | {"text": secret_scan.redact(r["text"])} for i, r in rows.items() if i in stay}
    left = spark.createDataFrame([(i, r["text"], r["lang"], r["source"], len(r["text"])) for i, r in rows.items()], docs.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(left).collect()}
    b = bpe.bpe(None)
    want = Counter({(i, len(b.encode_one(r["text"]))): copies[i] for i, r in rows.items() if copies[i]})
    got = Counter((r["doc_id"], r["n_tokens"]) for r in cp.run(spark, sf).collect())
    assert got == want


def test_pipeline_stages_on_odd_rows(spark, odd, empty, sf):
    import corpus_pipeline as cp

    for start in (odd, empty):
        df = start
        for k, (_, stage) in enumerate(cp.STAGES):
            df = stage(spark, df, sf)
            assert k == 4 or df.columns == list(cp.COLUMNS)
            n = df.count()
        assert (n > 0) == (start is odd)
