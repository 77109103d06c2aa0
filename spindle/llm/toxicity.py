"""Toxicity: a bidirectional GRU with attention pooling over character and word inputs, trained in numpy.

A text is its words (white space splits, A-Z lowered; a word over ``PIECE`` bytes counts as pieces of that size which
overlap by ``OVERLAP``, so unspaced text has windows too), cut into windows of ``WINDOW`` words, ``STRIDE`` apart, the
last one ending with the text: every word is in a window, every run of 17 words in one window, whole texts are scored.  A document's logit is its highest
window's; the score is its logistic value after a shift and scale fixed in training.

Training fits a bounded, documented sample: per class at most ``SAMPLE`` labelled documents (least hash of doc_id
first).  Of a clean one, at most ``SAMPLE_WINDOWS`` windows (least hash of place first) are taken, all of them clean.  A
toxic one is taken with all its windows or not at all, since its toxic passage may be any of them: the shortest first, up
to ``SAMPLE_BYTES`` of text together, one at least.  Only rows whose
crc32(doc_id as text) mod 3 is not 1 are learned from.  A label says that some window is toxic, not which, so after a
round on random windows each toxic document is represented by its currently highest window, each clean one by its
highest and a random one.  The same sample gives the same model, bit for bit.  One task fits it, since the sample is
bounded; only the model, about 2.5 MB, comes to the driver.

Edge cases: null and empty texts have one empty window; a null doc_id is scored and not held out; repeated rows get the
same score; documents with several labels are toxic if any says so; without labels of both classes every score is 0.0;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm import rnn
from spindle.llm.common import empty_cache, give_back, pick, process_cache, sheltered, slices, utf8, words_of

WINDOW, STRIDE = 32, 16
PIECE, OVERLAP = 48, 16  # bytes
SAMPLE = 1500  # documents per class
SAMPLE_WINDOWS = 24  # per sampled clean document
SAMPLE_BYTES = 8 << 20  # of sampled toxic texts together
EPOCHS = 10
BATCH = 128
WORD_DROPOUT = 0.5  # share of words whose word part is hidden in a training step
DECAY = 1e-4
RATE = 0.01
THRESHOLD = 0.7
SEED = 11
MEMO_WORDS = 50_000  # words whose inputs a worker remembers
SCORE_BATCH = 1024  # windows scored at once
SCORE_BYTES = 1 << 20  # text whose words a worker holds at once; a longer text is scored by itself


def units_of(text: bytes) -> list[bytes]:
    """The words of a text, long ones in overlapping pieces."""
    words = words_of(text)
    if max(map(len, words), default=0) <= PIECE:
        return words
    out = []
    for w in words:
        out += [w] if len(w) <= PIECE else [w[i : i + PIECE] for i in range(0, len(w) - OVERLAP, PIECE - OVERLAP)]
    return out


def window_starts(n: int) -> np.ndarray:
    """First words of the windows of a text of ``n`` words."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.minimum(np.arange(0, n - WINDOW + STRIDE, STRIDE), n - WINDOW)


# ------------------------------------------------------------------------------------------------------------------
# Training
# ------------------------------------------------------------------------------------------------------------------


def held_out(doc_id) -> F.Column:
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


WINDOWS = "doc_id BIGINT, toxic INT, start BIGINT, words BINARY"


def training_windows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sample's windows: at most SAMPLE * SAMPLE_WINDOWS of clean documents, and those of SAMPLE_BYTES of toxic ones."""
    known = pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    texts = pick(docs, "doc_id", "text")
    toxic = known.where("toxic = 1").orderBy(*order).limit(SAMPLE)
    size = texts.join(F.broadcast(toxic), "doc_id").groupBy("doc_id", "toxic").agg(F.sum(F.octet_length("text")).alias("size"))
    by_size = Window.orderBy(F.col("size").asc_nulls_first(), *order)  # at most SAMPLE rows
    size = size.select("doc_id", "toxic", F.sum("size").over(by_size).alias("total"), F.row_number().over(by_size).alias("place"))
    sample = size.where((F.coalesce("total", F.lit(0)) <= SAMPLE_BYTES) | (F.col("place") == 1)).select("doc_id", "toxic")
    sample = sample.unionByName(known.where("toxic = 0").orderBy(*order).limit(SAMPLE))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_cache()
        for s in slices(batches, "text"):
            out = {"doc_id": [], "toxic": [], "start": [], "words": []}
            for doc_id, toxic, text in zip(s.column("doc_id").to_pylist(), s.column("toxic").to_pylist(), utf8(s, "text"), strict=True):
                words = units_of(text or b"")
                starts = window_starts(len(words)).tolist()
                if not toxic:
                    starts = sorted(starts, key=lambda x: zlib.crc32(f"{doc_id}:{x}".encode()))[:SAMPLE_WINDOWS]
                for x in sorted(starts):
                    out["doc_id"].append(doc_id)
                    out["toxic"].append(toxic)
                    out["start"].append(x)
                    out["words"].append(b" ".join(words[x : x + WINDOW]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["toxic"], pa.int32()), pa.array(out["start"], pa.int64()), pa.array(out["words"], pa.binary())],
                list(out),
            )

    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")
    return rows.mapInArrow(kernel, WINDOWS).distinct()


class Numbers(dict):
    """Word -> number in order of first appearance."""

    def __init__(self):
        super().__init__()
        self.order: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.order)
        self.order.append(word)
        return n


class Sample:
    """A sample's windows as numbers of its words, from batches ``doc_id, toxic, start, words`` in that order of windows.

    Read a slice at a time, so that its words are held once each and not once per window."""

    def __init__(self, batches: Iterable[pa.RecordBatch]):
        known = Numbers()
        empty = known[b""]
        docs, toxic, sizes, windows = [], [], [], [np.empty((0, WINDOW), np.int32)]
        for s in slices(batches, "words", SCORE_BYTES):
            words = [x.split() for x in s.column("words").to_pylist()]
            size = np.array([len(x) for x in words], np.int32)
            numbers = np.full((len(words), WINDOW), empty, np.int32)
            numbers[np.arange(WINDOW) < size[:, None]] = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int32, size.sum())
            windows.append(numbers)
            sizes.append(size)
            docs.append(s.column("doc_id").to_numpy(zero_copy_only=False))
            toxic.append(s.column("toxic").to_numpy(zero_copy_only=False))
        self.words = sorted(known)  # the empty word comes first
        place = np.empty(len(known), np.int32)
        place[[known[w] for w in self.words]] = np.arange(len(known), dtype=np.int32)
        del known
        # the last window is empty, and clean
        self.windows = np.concatenate([*windows, np.full((1, WINDOW), empty, np.int32)])
        for i in range(0, len(self.windows), SCORE_BATCH):
            self.windows[i : i + SCORE_BATCH] = place[self.windows[i : i + SCORE_BATCH]]
        self.size = np.concatenate([*sizes, [0]])
        self.y = np.concatenate([*toxic, [0]]).astype(rnn.F32)
        doc = np.concatenate([np.empty(0, np.int64), *docs])
        self.by_doc = np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1)

    def both(self) -> bool:
        """Whether both classes are there."""
        return set(self.y[:-1].tolist()) == {0, 1}

    def mask(self, at: slice | np.ndarray) -> np.ndarray:
        return (np.arange(WINDOW) < self.size[at][:, None]).astype(rnn.F32)


def train(sample: Sample, epochs: int = EPOCHS, seed: int = SEED) -> dict | None:
    """The fitted model, or None where the sample lacks a class."""
    if not sample.both():
        return None
    windows, by_doc, y = sample.windows, sample.by_doc, sample.y
    last = len(windows) - 1
    words = rnn.describe_words(sample.words)
    sample.words = None
    rng = np.random.default_rng(seed)
    p = rnn.new_parameters(seed)
    adam = rnn.Adam(p, DECAY)

    met, place = np.zeros(len(words.row), bool), np.zeros(len(words.row), np.int64)

    def logits_of_all() -> np.ndarray:
        out = np.empty(len(windows), rnn.F32)
        for i in range(0, len(windows), SCORE_BATCH):
            at = slice(i, i + SCORE_BATCH)
            met[:] = False
            met[windows[at]] = True
            used = np.flatnonzero(met)
            place[used] = np.arange(len(used))
            inputs = rnn.word_inputs(p, rnn.word_vectors(p, subset(words, used)))
            out[at] = rnn.forward(p, inputs, place[windows[at]], sample.mask(at))
        return out

    for epoch in range(epochs):
        if epoch < 2:
            chosen = [rng.choice(own, min(len(own), 4), replace=False) for own in by_doc]
        else:
            now = logits_of_all()
            chosen = []
            for own in by_doc:
                top = own[np.argmax(now[own])]
                chosen.append([top] if y[top] else [top, rng.choice(own)])
        take = np.append(np.concatenate(chosen), last)
        positive = max(1.0, float(y[take].sum()))
        weight = np.where(y[take] > 0, (len(take) - positive) / positive, 1.0).astype(rnn.F32)
        order = rng.permutation(len(take))
        for i in range(0, len(take), BATCH):
            at = take[order[i : i + BATCH]]
            used, local = np.unique(windows[at], return_inverse=True)
            local = local.reshape(len(at), WINDOW)
            sub = subset(words, used)
            seen = np.ones((len(used), rnn.WORD_DIM + rnn.CHAR_DIM), rnn.F32)
            seen[:, : rnn.WORD_DIM] = (rng.random(len(used)) >= WORD_DROPOUT)[:, None] / (1 - WORD_DROPOUT)
            vectors = rnn.word_vectors(p, sub) * seen
            logits, kept = rnn.forward(p, rnn.word_inputs(p, vectors), local, sample.mask(at), keep=True)
            d = (rnn.sigmoid(logits) - y[at]) * weight[order[i : i + BATCH]] / len(at)
            g = rnn.backward(p, sub, vectors, seen, local, kept, d.astype(rnn.F32))
            adam.apply(g, RATE * (1 - epoch / epochs))
    now = logits_of_all()
    top = np.array([now[own].max() for own in by_doc])
    truth = np.array([y[own[0]] for own in by_doc])
    shift, scale = calibrate(top, truth)
    return {"p": p, "shift": shift, "scale": scale}


def subset(words: rnn.Words, used: np.ndarray) -> rnn.Words:
    count = words.count[used].astype(np.int64)
    start = np.cumsum(count) - count
    at = np.repeat(words.start[used] - start, count) + np.arange(count.sum())
    return rnn.Words(words.row[used], words.grams[at], start)


def calibrate(top: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Shift and scale that put the best cut (by F1, in the gap beside it, nearer to the toxic side as whole texts have more windows) at the threshold."""
    order = np.argsort(-top, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(top) + 1) + truth.sum())
    k = int(np.argmax(f1))
    here, below = top[order[k]], top[order[min(k + 1, len(top) - 1)]]
    return float(below + 0.7 * (here - below)), 1.0


def fit(docs: DataFrame, labels: DataFrame) -> bytes | None:
    """The fitted model, pickled, or None where the sample lacks a class."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_cache()
        model = train(Sample(batches))
        give_back()
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = training_windows(docs, labels).repartition(1).sortWithinPartitions("doc_id", "start", "words").mapInArrow(kernel, "model BINARY").collect()
    return bytes(fitted[0]["model"]) if fitted else None


# ------------------------------------------------------------------------------------------------------------------
# Scoring
# ------------------------------------------------------------------------------------------------------------------


class Scorer:
    """A model with the inputs of the words met so far."""

    def __init__(self, model: dict):
        self.model, self.p = model, model["p"]
        self.forget()

    def forget(self) -> None:
        self.known = Numbers()
        self.inputs = np.empty((2, MEMO_WORDS, 3 * rnn.HIDDEN), rnn.F32)  # memory is taken as words fill it

    def number(self, words: Iterator[bytes], n: int) -> np.ndarray:
        """Numbers of words; those not met before get their inputs."""
        if len(self.known) > MEMO_WORDS:
            self.forget()
        before = len(self.known)
        out = np.fromiter(map(self.known.__getitem__, words), np.int64, n)
        if len(self.known) > self.inputs.shape[1]:
            larger = np.empty((2, 2 * len(self.known), 3 * rnn.HIDDEN), rnn.F32)
            larger[:, :before] = self.inputs[:, :before]
            self.inputs = larger
        for i in range(before, len(self.known), rnn.DESCRIBED):
            new = self.known.order[i : i + rnn.DESCRIBED]
            self.inputs[:, i : i + len(new)] = rnn.word_inputs(self.p, rnn.word_vectors(self.p, rnn.describe_words(new)))
        return out

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """A logit per text: the highest of its windows'."""
        words = [units_of(t) for t in texts]
        sizes = np.array([len(w) for w in words])
        flat = self.number(chain([b""], *words), int(sizes.sum()) + 1)  # an empty word, so that there always is one
        base = np.cumsum(sizes) - sizes + 1
        starts = [window_starts(int(n)) for n in sizes]
        count = np.array([len(s) for s in starts])
        of = np.repeat(np.arange(len(texts)), count)
        first = np.concatenate(starts)
        out = np.empty(len(of), rnn.F32)
        step = np.arange(WINDOW)
        for i in range(0, len(of), SCORE_BATCH):
            d, s = of[i : i + SCORE_BATCH], first[i : i + SCORE_BATCH]
            mask = (s[:, None] + step < sizes[d][:, None]).astype(rnn.F32)
            at = np.minimum(base[d][:, None] + s[:, None] + step, len(flat) - 1)
            out[i : i + SCORE_BATCH] = rnn.forward(self.p, self.inputs, flat[at], mask)
        return np.maximum.reduceat(out, np.cumsum(count) - count)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = (self.logits(texts).astype(np.float64) - self.model["shift"]) * self.model["scale"]
        x += np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def score_documents(docs: DataFrame, model: bytes | None) -> DataFrame:
    """``docs`` with ``toxicity``, the score of its whole text; the other columns pass through."""
    name = "toxicity"
    out = docs.select(*docs.columns, F.lit(0.0).alias(name))
    if model is None:
        return out
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 2.5 MB, whatever the data
    mark = zlib.crc32(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = process_cache("toxic", lambda: Scorer(pickle.loads(shared.value)), mark)
        for s in slices(batches, "text", SCORE_BYTES):
            scores = scorer.scores([t or b"" for t in utf8(s, "text")])
            yield pa.RecordBatch.from_arrays([*s.columns, pa.array(scores, pa.float64())], [*s.schema.names, name])

    return docs.mapInArrow(kernel, out.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    scored = score_documents(pick(docs, "doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject, with all their columns."""
    docs, names = sheltered(docs, "doc_id", "text")
    scored = score_documents(docs, fit(docs, labels))
    return scored.where(F.col("toxicity") < THRESHOLD).drop("toxicity").toDF(*names)
