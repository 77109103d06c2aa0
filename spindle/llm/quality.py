"""A quality classifier by nearest-neighbour voting over latent-semantic vectors.

Terms of a text, counted over the whole of it by array operations: trigrams of its character classes (case, digits, each
ASCII punctuation mark, white space; runs beyond ``RUN`` characters count as ``RUN``), its words (A-Z lowered), and the
words that repeat the one ``LAGS`` places before.  The first two are hashed into ``BUCKETS`` each.  A text's term vector
has the square roots of its terms' shares, so that length plays no part.

Fitting takes a bounded, documented sample: per class at most ``SAMPLE`` labelled documents (least hash of doc_id first),
only from rows whose crc32(doc_id as text) mod 4 is not 2.  The ``RANK`` leading singular directions of the sample's
centred term vectors span the latent space; the sample's unit vectors there (at most 2 * SAMPLE * RANK numbers) are
broadcast.  Every document of the table is compared with all of them, by blocks of exact cosine products, and its score is
the mean label of its ``NEIGHBOURS`` nearest (those tied with the last one too), weighted by ``similarity ** POWER``.

Edge cases: a text without words (null, empty, white space) has no terms and scores ``NO_TERMS``; a null doc_id is scored
and not held out; repeated rows get the same score; of several labels the lowest counts; without labels of both
classes every score is 0.0; a piece of ``PIECE`` bytes of a longer text is counted by itself, so that no text is too
long; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import mix64, pick, process_cache, slices, utf8

SAMPLE = 2000  # documents per class
FOLDS, HELD = 4, 2
BUCKETS = 1024
LAGS = (1, 2)
RUN = 3
RANK = 32
NEIGHBOURS = 15
POWER = 4
TIE = 1e-6  # cosines so close to the last neighbour's count as tied with it
THRESHOLD = 0.7
NO_TERMS = 0.5
PIECE = 1 << 20  # bytes of text counted at once
ROWS = 512  # documents at once
WIDTH = 2 * BUCKETS + len(LAGS)
F32 = np.float32


def classes() -> np.ndarray:
    """Byte -> class: 0 between texts, 1 blank, 2 line break, 3 digit, 4 small letter (and all beyond ASCII), 5 capital, then a
    class per punctuation mark."""
    out = np.arange(256, dtype=np.uint64) + 6
    out[[0x20, 0x09, 0x0B, 0x0C]] = 1
    out[[0x0A, 0x0D]] = 2
    out[ord("0") : ord("9") + 1] = 3
    out[ord("a") : ord("z") + 1] = out[128:] = 4
    out[ord("A") : ord("Z") + 1] = 5
    return out


CLASS = classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes) >> np.uint64(40)).astype(np.int64) % BUCKETS


def count_pieces(counts: np.ndarray, owners: list[int], pieces: list[bytes], steps: tuple[np.ndarray, np.ndarray]) -> None:
    """Adds the terms of the pieces to the rows of ``counts`` that own them; ``counts[:, -1]`` takes the number of words."""
    owner = np.repeat(np.array(owners), [len(p) + 1 for p in pieces])
    raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1

    # character classes: a run of one class counts up to RUN times
    kind = CLASS[raw]
    kind[ends] = 0
    same = np.concatenate(([False], kind[1:] == kind[:-1]))
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(kind))))
    kept = np.flatnonzero(np.arange(len(kind)) - start < RUN)
    k, o = kind[kept], owner[kept]
    inside = (k[:-2] > 0) & (k[1:-1] > 0) & (k[2:] > 0)  # no text's end within
    grams = ((k[:-2] << np.uint64(20)) | (k[1:-1] << np.uint64(10)) | k[2:])[inside]
    width = counts.shape[1]
    flat = counts.reshape(-1)
    flat += np.bincount(o[:-2][inside] * width + bucket(grams), minlength=flat.size)

    # words: a polynomial hash of every stretch between white space, by differences of prefix sums
    gap = (kind == 0) | (kind == 1) | (kind == 2)
    first = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(first):
        return
    after = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    up, down = steps
    sums = np.concatenate(([np.uint64(0)], np.cumsum((LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[: len(raw)])))
    words = (sums[after] - sums[first]) * down[first]
    mine = owner[first]
    flat += np.bincount(mine * width + BUCKETS + bucket(words), minlength=flat.size)
    for i, lag in enumerate(LAGS):
        again = mine[lag:][(words[lag:] == words[:-lag]) & (mine[lag:] == mine[:-lag])]
        counts[:, 2 * BUCKETS + i] += np.bincount(again, minlength=len(counts))
    counts[:, -1] += np.bincount(mine, minlength=len(counts))


def term_vectors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors of the texts, and which of them have any word."""
    counts = np.zeros((len(texts), WIDTH + 1))
    steps = hash_steps()
    owners, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE]
            if size + len(piece) > PIECE and pieces:
                count_pieces(counts, owners, pieces, steps)
                owners, pieces, size = [], [], 0
            owners.append(i)
            pieces.append(piece)
            size += len(piece) + 1
    if pieces:
        count_pieces(counts, owners, pieces, steps)
    grams, words = counts[:, :BUCKETS], counts[:, BUCKETS : 2 * BUCKETS]
    total = counts[:, -1:]
    for part, whole in ((grams, grams.sum(axis=1, keepdims=True)), (words, total), (counts[:, 2 * BUCKETS : -1], total)):
        part /= np.maximum(whole, 1)
    return np.sqrt(counts[:, :-1]).astype(F32), total[:, 0] > 0


@cache
def hash_steps() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, as many as a group of pieces can need (34 MB)."""
    n = 2 * PIECE + ROWS + 2
    return powers(BASE, n), powers(INVERSE, n)


# ------------------------------------------------------------------------------------------------------------------
# Fitting
# ------------------------------------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD, F.lit(False))


def sample_vectors(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors and labels of the sample, in a fixed order."""
    known = pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.where("quality = 1").orderBy(*order).limit(SAMPLE)
    sample = sample.unionByName(known.where("quality = 0").orderBy(*order).limit(SAMPLE))
    # Of several texts under one doc_id the one with the least hash stands for it.
    rows = pick(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in slices([b.slice(i, ROWS) for i in range(0, b.num_rows, ROWS)], "text"):
                x, any_word = term_vectors([t or b"" for t in utf8(s, "text")])
                packed = [r.tobytes() if w else None for r, w in zip(x, any_word, strict=True)]
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("quality"), pa.array(packed, pa.binary())], ["doc_id", "quality", "x"])

    # 8 kB a document, 33 MB in all, whatever the data
    found = rows.select("doc_id", "quality", "text").mapInArrow(kernel, "doc_id BIGINT, quality INT, x BINARY").where("x IS NOT NULL")
    found = found.toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), F32).reshape(-1, WIDTH)
    return x, found.column("quality").to_numpy().astype(np.float64)


def latent(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of the term vectors in the latent space."""
    z = (x - mean) @ axes
    return z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-12)


def leading_directions(x: np.ndarray) -> np.ndarray:
    """The RANK leading right singular directions of ``x``, by subspace iteration from fixed draws."""
    start = np.random.default_rng(13).standard_normal((x.shape[1], min(RANK + 16, *x.shape)))
    space = np.linalg.qr(start)[0].astype(F32)
    for _ in range(12):
        space = np.linalg.qr(x.T @ (x @ space))[0]
    inner = x @ space
    _, turn = np.linalg.eigh((inner.T @ inner).astype(np.float64))
    return np.ascontiguousarray(space @ turn[:, ::-1][:, :RANK].astype(F32))


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The mean and leading directions of the sample's term vectors, its latent vectors and labels; None without both classes."""
    x, y = sample_vectors(docs, labels)
    if len(set(y.tolist())) < 2:
        return None
    mean = x.mean(axis=0, dtype=np.float64).astype(F32)
    axes = leading_directions(x - mean)
    return {"mean": mean, "axes": axes, "vectors": latent(x, mean, axes), "labels": y}


# ------------------------------------------------------------------------------------------------------------------
# Scoring
# ------------------------------------------------------------------------------------------------------------------


def vote(model: dict, x: np.ndarray) -> np.ndarray:
    """The similarity-weighted mean label of every row's nearest sample vectors, all compared exactly."""
    cosines = (latent(x, model["mean"], model["axes"]) @ model["vectors"].T).astype(np.float64)
    k = min(NEIGHBOURS, cosines.shape[1])
    last = np.partition(cosines, -k, axis=1)[:, -k]
    weight = np.where(cosines >= last[:, None] - TIE, np.maximum(cosines, TIE) ** POWER, 0.0)
    return np.clip(np.round(weight @ model["labels"] / weight.sum(axis=1), 6), 0.0, 1.0)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    model = fit(docs, labels)
    rows = pick(docs, "doc_id", "text")
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        raw = pickle.dumps(model)
        shared = rows.sparkSession.sparkContext.broadcast(raw)  # 0.8 MB, whatever the data
        mark = zlib.crc32(raw)

        def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = process_cache("quality", lambda: pickle.loads(shared.value), mark)
            for b in batches:
                for s in slices([b.slice(i, ROWS) for i in range(0, b.num_rows, ROWS)], "text"):
                    x, any_word = term_vectors([t or b"" for t in utf8(s, "text")])
                    score = np.where(any_word, vote(known, x), NO_TERMS)
                    yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

        scored = rows.mapInArrow(kernel, "doc_id BIGINT, score DOUBLE")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
