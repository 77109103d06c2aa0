"""A bidirectional gated recurrent network with attention pooling, in numpy: forward, backward and training.

Input: windows of word numbers into a list of distinct words.  A word's input vector joins a word part (a hashed row of
its own) and a character part (the mean of hashed rows of its character 4-grams, with word marks), so words never seen in
training still have an input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WORD_ROWS, CHAR_ROWS = 1 << 17, 1 << 15
WORD_DIM, CHAR_DIM = 4, 12
HIDDEN, ATTENTION = 8, 8
GRAMS = (4,)
DESCRIBED = 20_000  # words described at once
F32 = np.float32


@dataclass
class Words:
    """Distinct words: their word row, and their character rows one after the other (``start`` per word)."""

    row: np.ndarray
    grams: np.ndarray
    start: np.ndarray
    count: np.ndarray = field(init=False)

    def __post_init__(self):
        self.count = np.diff(np.append(self.start, len(self.grams))).astype(F32)


def describe_words(words: list[bytes]) -> Words:
    """Hash rows of words and of their character n-grams, ``DESCRIBED`` words at once."""
    parts = [_described(words[i : i + DESCRIBED]) for i in range(0, max(1, len(words)), DESCRIBED)]
    counts = np.concatenate([p[2] for p in parts])
    return Words(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.cumsum(counts) - counts)


def _described(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash rows of words, the rows of their character n-grams one after the other, and each word's number of them."""
    import xxhash

    row = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.uint32, len(words)) % np.uint32(WORD_ROWS)
    marked = [(b"<" + w + b">").ljust(GRAMS[0], b">") for w in words]
    size = np.array([len(m) for m in marked])
    end = np.cumsum(size)
    chars = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    limit = np.repeat(end, size)  # where the word of each place ends
    place = np.arange(len(chars))
    owner = np.repeat(np.arange(len(words)), size)
    found, owners = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            ok = place + n <= limit
            at = place[ok]
            h = np.full(len(at), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(n):
                h = (h ^ chars[at + j]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            found.append(h * np.uint32(0x85EBCA6B) >> np.uint32(17))
            owners.append(owner[ok])
    who = np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    grams = np.concatenate(found)[order].astype(np.int64)
    counts = np.bincount(who, minlength=len(words))
    return row.astype(np.int64), grams, counts


def new_parameters(seed: int) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    x = WORD_DIM + CHAR_DIM

    def normal(scale, *shape):
        return (g.standard_normal(shape) * scale).astype(F32)

    return {
        "word": np.zeros((WORD_ROWS, WORD_DIM), F32), "char": normal(0.02, CHAR_ROWS, CHAR_DIM),
        "wx": normal(x**-0.5, 2, x, 3 * HIDDEN), "bx": np.zeros((2, 1, 3 * HIDDEN), F32),
        "wh": normal(HIDDEN**-0.5, 2, HIDDEN, 3 * HIDDEN),
        "wa": normal((2 * HIDDEN) ** -0.5, 2 * HIDDEN, ATTENTION), "va": normal(1.0, ATTENTION),
        "wo": normal(0.5, 2 * HIDDEN), "bo": np.zeros(1, F32),
    }


def word_vectors(p: dict, words: Words) -> np.ndarray:
    chars = np.add.reduceat(p["char"][words.grams], words.start, axis=0) / words.count[:, None]
    return np.concatenate([p["word"][words.row], chars], axis=1)


def word_inputs(p: dict, vectors: np.ndarray) -> np.ndarray:
    """(2, words, 3 HIDDEN): what each word adds to the gates, per direction."""
    return (vectors @ p["wx"] + p["bx"]).astype(F32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return F32(0.5) * (np.tanh(F32(0.5) * x) + F32(1))


def forward(p: dict, inputs: np.ndarray, windows: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows ``(n, T)`` of word numbers; ``mask`` is 1 at real words (they come first).

    With ``keep``, also what the backward pass needs.
    """
    n, steps = windows.shape
    h = np.zeros((2, n, HIDDEN), F32)
    states = np.zeros((steps, 2, n, HIDDEN), F32)
    saved = []
    for k in range(steps):
        ahead, back = windows[:, k], windows[:, steps - 1 - k]
        gates = np.empty((2, n, 3 * HIDDEN), inputs.dtype)
        np.take(inputs[0], ahead, axis=0, out=gates[0], mode="clip")
        np.take(inputs[1], back, axis=0, out=gates[1], mode="clip")
        m = np.stack([mask[:, k], mask[:, steps - 1 - k]])[:, :, None]
        hu = h @ p["wh"]
        zr = sigmoid(gates[:, :, : 2 * HIDDEN] + hu[:, :, : 2 * HIDDEN])
        z, r = zr[:, :, :HIDDEN], zr[:, :, HIDDEN:]
        c = np.tanh(gates[:, :, 2 * HIDDEN :] + r * hu[:, :, 2 * HIDDEN :])
        new = h + m * (1 - z) * (c - h)
        if keep:
            saved.append((h, z, r, c, hu[:, :, 2 * HIDDEN :], m))
        h = new
        states[k, 0] = h[0]
        states[steps - 1 - k, 1] = h[1]
    hs = np.concatenate([states[:, 0], states[:, 1]], axis=2)  # (T, n, 2 HIDDEN)
    t = np.tanh(hs @ p["wa"])
    e = t @ p["va"] + (mask.T - 1) * F32(1e9)
    e = np.exp(e - e.max(axis=0))
    a = e / e.sum(axis=0)
    a = a * (mask.max(axis=1) > 0)  # an empty window has no state to attend to
    pooled = np.einsum("tn,tnh->nh", a, hs)
    logits = pooled @ p["wo"] + p["bo"][0]
    return (logits, (saved, hs, t, a, pooled)) if keep else logits


def backward(p: dict, words: Words, vectors, seen, windows: np.ndarray, kept, dlogits: np.ndarray) -> dict:
    """Gradients of the summed loss by parameter; ``seen`` is what the word vectors were multiplied by.

    Those of the two tables are ``(rows, gradients)`` of the rows in use.
    """
    saved, hs, t, a, pooled = kept
    steps, n = a.shape
    g = {"wh": np.zeros_like(p["wh"])}
    g["wo"] = pooled.T @ dlogits
    g["bo"] = dlogits.sum(keepdims=True)
    dpooled = dlogits[:, None] * p["wo"]
    dhs = a[:, :, None] * dpooled
    da = np.einsum("nh,tnh->tn", dpooled, hs)
    de = a * (da - (a * da).sum(axis=0))
    g["va"] = np.einsum("tn,tnk->k", de, t)
    dt = de[:, :, None] * p["va"] * (1 - t * t)
    g["wa"] = np.einsum("tnh,tnk->hk", hs, dt)
    dhs = dhs + dt @ p["wa"].T
    dinputs = np.zeros((2, len(vectors), 3 * HIDDEN), F32)
    dh = np.zeros((2, n, HIDDEN), F32)
    wh_t = p["wh"].transpose(0, 2, 1)
    for k in range(steps - 1, -1, -1):
        dh = dh + np.stack([dhs[k, :, :HIDDEN], dhs[steps - 1 - k, :, HIDDEN:]])
        h, z, r, c, hu, m = saved[k]
        dz = dh * m * (h - c) * z * (1 - z)
        dc = dh * m * (1 - z) * (1 - c * c)
        dr = dc * hu * r * (1 - r)
        dgates = np.concatenate([dz, dr, dc], axis=2)
        dhu = np.concatenate([dz, dr, dc * r], axis=2)
        g["wh"] += h.transpose(0, 2, 1) @ dhu
        dh = dh * (1 - m * (1 - z)) + dhu @ wh_t
        np.add.at(dinputs[0], windows[:, k], dgates[0])
        np.add.at(dinputs[1], windows[:, steps - 1 - k], dgates[1])
    g["bx"] = dinputs.sum(axis=1, keepdims=True)
    g["wx"] = vectors.T @ dinputs
    dvectors = (dinputs @ p["wx"].transpose(0, 2, 1)).sum(axis=0) * seen
    each = dvectors[:, WORD_DIM:] / words.count[:, None]
    g["word"] = by_row(words.row, dvectors[:, :WORD_DIM])
    g["char"] = by_row(words.grams, np.repeat(each, words.count.astype(np.int64), axis=0))
    return g


def by_row(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients summed by table row."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    start = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    return rows[start], np.add.reduceat(grads[order], start, axis=0)


class Adam:
    """Adam with decay towards zero; of a table, only the rows in use move."""

    def __init__(self, p: dict, decay: float):
        self.p, self.decay, self.step = p, F32(decay), 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def apply(self, g: dict, rate: float) -> None:
        self.step += 1
        scale = F32(rate * (1 - 0.999**self.step) ** 0.5 / (1 - 0.9**self.step))
        for k, x in g.items():
            at, x = x if isinstance(x, tuple) else (slice(None), x)
            x = x + self.decay * self.p[k][at]
            self.m[k][at] += F32(0.1) * (x - self.m[k][at])
            self.v[k][at] += F32(0.001) * (x * x - self.v[k][at])
            self.p[k][at] -= scale * self.m[k][at] / (np.sqrt(self.v[k][at]) + F32(1e-8))
