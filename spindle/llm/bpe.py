"""Byte-level BPE encoding and decoding by tree concatenation.

A text is cut into halves, the halves into halves again, down to leaves of at most ``LEAF_CHARS``.  Leaves are encoded
independently (those of long texts as separate rows, spread over the cluster).  Going up the tree, two neighbours are
joined by encoding a window around the cut and growing it until both of its ends agree exactly with what the sides
already had; the tokens inside the window are then replaced.

When a window may stop growing.  An end is *clean* when it is an end of the text, or lies before a single space between
two visible characters (pre-tokenisation always cuts there), or lies inside a run of letters, digits or other visible
characters.  In the last case the window's run is cut where the full text's run continues, so nothing but the merges of
that one run can differ, and the outermost token of the window must equal the token the side had there: every two
neighbouring tokens of the result then are neighbours in some correct encoding, which fixes a merge-ordered encoding.
A window that never agrees grows to the whole text, which is exact by definition.

Leaves and windows are encoded by :class:`ByteBPE`, with the ids of the tokenizers library.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import pick, process_cache, slices

LEAF_CHARS = 16_384
FIRST_WINDOW = 8  # tokens on each side of a cut at first; doubled until both ends agree


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: how byte-level pre-tokenisation of this family splits a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBPE:
    """A byte-level BPE vocabulary file of the tokenizers library: ``encode`` to uint32 ids, ``decode`` to text.

    The library itself needs 0.86 CPU seconds a MB of this text, most of it for offsets and alignments nobody reads.
    Where the vocabulary is merge-ordered (token 256 + i is the i-th merge), the same ids follow from ranks alone, so
    leaves are encoded by tiktoken over ranks taken from the same file (0.16 s a MB); any other vocabulary goes through
    the library.  ``encode_library`` always does; tests hold one against the other.
    """

    def __init__(self, path: str):
        self.path = path
        spec = json.load(open(path, encoding="utf-8"))
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special_re = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.bytes_of = self._byte_table(spec)
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.ranks = self._rank_encoding(spec)

    @cached_property
    def tok(self):
        """The library's tokenizer, loaded where it is used; a worker that encodes by ranks does without."""
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.path)
        tok.no_truncation()
        tok.no_padding()
        return tok

    def _byte_table(self, spec: dict) -> list[bytes]:
        """id -> bytes.  Byte-level vocabularies write a byte as its own Latin-1 character where that is printable,
        the others, in order, as the characters from U+0100 on."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocab = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        table = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in byte for c in token)
            table[i] = bytes(byte[c] for c in token) if known else token.encode()
        return table

    def _rank_encoding(self, spec: dict):
        """The same vocabulary as ranks, or None where ranks would not say the same as the file."""
        import tiktoken

        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        ordered = all(model["vocab"].get(m) == 256 + i for i, m in enumerate(merges))
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        bare = all(not t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not (ordered and plain and bare and spec["normalizer"] is None and not model.get("ignore_merges")):
            return None
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {b: i for i, b in enumerate(self.bytes_of) if b and i not in special.values()}
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode_library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def encode_one(self, text: str) -> np.ndarray:
        if self.ranks is None:
            return self.encode_library([text])[0]
        return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_library(texts) if self.ranks is None else [self.encode_one(t) for t in texts]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def bpe(path: str | None) -> ByteBPE:
    path = path or default_tokenizer()
    return process_cache(f"bpe:{path}", lambda: ByteBPE(path))


# ------------------------------------------------------------------------------------------------------------------
# Tree concatenation
# ------------------------------------------------------------------------------------------------------------------


def leaves_of(text: str, specials: list[str], leaf_chars: int = LEAF_CHARS) -> list[str]:
    """Recursive halves of at most ``leaf_chars`` characters; no cut falls inside a special token's string."""
    if len(text) <= leaf_chars:
        return [text]
    cut = len(text) // 2
    for s in specials:
        at = text.find(s, max(0, cut - len(s) + 1), cut + len(s) - 1)
        if 0 <= at < cut < at + len(s):
            cut = at
    if cut == 0:
        return [text]
    return leaves_of(text[:cut], specials, leaf_chars) + leaves_of(text[cut:], specials, leaf_chars)


def char_class(c: str) -> str:
    if c.isspace():
        return "space"
    k = unicodedata.category(c)[0]
    return k if k in "LN" else "other" if k in "PS" else "unsure"


def clean_cut(text: str, p: int) -> str:
    """How a window may end at position ``p`` of ``text``: ``free``, ``run`` (needs an agreeing token) or ``no``."""
    if p <= 0 or p >= len(text):
        return "free"
    before, after = text[p - 1], text[p]
    kinds = char_class(before), char_class(after)
    if after == " " and p + 1 < len(text) and "space" not in (kinds[0], char_class(text[p + 1])):
        return "free"
    # An apostrophe can start a contraction, so a run is never cut beside one.
    if kinds[0] == kinds[1] and kinds[0] in ("L", "N", "other") and "'" not in text[max(0, p - 2) : p + 2]:
        return "run"
    return "no"


def join_two(bpe: ByteBPE, left: np.ndarray, right: np.ndarray, encode: Callable | None = None) -> np.ndarray:
    """The encoding of the two sides' joint text, from the encodings of the sides."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    encode = encode or bpe.encode_one
    w = FIRST_WINDOW
    while True:
        whole_left, whole_right = w >= len(left), w >= len(right)
        # Some tokens beyond the window are decoded with it, to see what stands on the other side of its ends.
        lo, hi = max(0, len(left) - w), min(len(right), w)
        out_l, out_r = left[max(0, lo - 16) : lo], right[hi : hi + 16]
        inner = bpe.decode_bytes(left[lo:]) + bpe.decode_bytes(right[:hi])
        around_l, around_r = bpe.decode_bytes(out_l), bpe.decode_bytes(out_r)
        w *= 2
        if not whole_left and inner[:1] and (inner[0] & 0xC0) == 0x80:
            continue  # the end falls inside a character
        if not whole_right and around_r[:1] and (around_r[0] & 0xC0) == 0x80:
            continue
        text = inner.decode("utf-8", "replace")
        head = around_l.decode("utf-8", "replace")
        seen = head + text + around_r.decode("utf-8", "replace")
        start = "free" if whole_left else clean_cut(seen, len(head))
        end = "free" if whole_right else clean_cut(seen, len(head) + len(text))
        if "no" in (start, end):
            continue
        if bpe.special_re is not None and not (whole_left and whole_right):
            # a special token's string must not stand across an end of the window
            spans = [m.span() for m in bpe.special_re.finditer(seen)]
            if any(a < p < b for a, b in spans for p in (len(head), len(head) + len(text))):
                continue
        new = encode(text)
        if (start == "free" or new[0] == left[lo]) and (end == "free" or new[-1] == right[hi - 1]):
            return np.concatenate([left[:lo], new, right[hi:]])


def join_tree(bpe: ByteBPE, parts: list[np.ndarray]) -> np.ndarray:
    """Neighbours joined pairwise, level by level."""
    while len(parts) > 1:
        parts = [
            join_two(bpe, parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)
        ]
    return parts[0] if parts else np.empty(0, "<u4")


def encode_text(bpe: ByteBPE, text: str | None, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
    """One text by tree concatenation inside one process (what the DataFrame operator does over the cluster)."""
    return join_tree(bpe, bpe.encode(leaves_of(text or "", bpe.specials, leaf_chars)))


# ------------------------------------------------------------------------------------------------------------------
# DataFrame operators
# ------------------------------------------------------------------------------------------------------------------

DIGEST = "n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def digests(bpe: ByteBPE, ids: list[np.ndarray]) -> list[pa.Array]:
    """Token counts, digests of the ids and digests of the text decoded from them."""
    return [
        pa.array([len(x) for x in ids], pa.int64()),
        pa.array([sha256(",".join(map(bpe.text_of.__getitem__, x.tolist())).encode()) for x in ids], pa.string()),
        pa.array([sha256(bpe.decode(x).encode()) for x in ids], pa.string()),
    ]


def packed(ids: list[np.ndarray]) -> list[pa.Array]:
    """Token counts and the ids as little-endian uint32 bytes."""
    return [pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())]


def _encoded(docs: DataFrame, tokenizer: str | None, leaf_chars: int, finish: Callable, result: str) -> DataFrame:
    """``docs(doc_id, text)`` with ``finish``'s columns (``result``) of each text's ids.

    Texts of one leaf are encoded where they are read.  The leaves of longer texts become rows keyed by the text's
    digest (so equal texts are encoded once), are encoded wherever they land, and meet again per text.
    """
    base = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    names = [c.split()[0] for c in result.split(",")]
    whole, parted = base.where(F.length("text") <= leaf_chars), base.where(F.length("text") > leaf_chars)

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        for s in slices(batches, "text"):
            ids = b.encode(s.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), *finish(b, ids)], ["doc_id", *names])

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        for s in slices(batches, "text"):
            for key, text in zip(s.column("key").to_pylist(), s.column("text").to_pylist(), strict=True):
                parts = leaves_of(text, b.specials, leaf_chars)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(parts)), pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())],
                    ["key", "leaf", "part"],
                )

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        for s in slices(batches, "part"):
            ids = b.encode(s.column("part").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [s.column("key"), s.column("leaf"), pa.array([x.tobytes() for x in ids], pa.binary())],
                ["key", "leaf", "ids"],
            )

    def join_leaves(group: pa.Table) -> pa.Table:
        b = bpe(tokenizer)
        order = group.sort_by("leaf")
        ids = join_tree(b, [np.frombuffer(x, "<u4") for x in order.column("ids").to_pylist()])
        return pa.Table.from_arrays([order.column("key").slice(0, 1), *finish(b, [ids])], ["key", *names])

    keyed = parted.withColumn("key", F.sha2("text", 256))
    leaf_rows = keyed.select("key", "text").mapInArrow(cut_rows, "key STRING, leaf INT, part STRING")
    leaves = leaf_rows.groupBy("key", "leaf").agg(F.first("part").alias("part"))
    ids = leaves.mapInArrow(encode_leaves, "key STRING, leaf INT, ids BINARY")
    long = ids.groupBy("key").applyInArrow(join_leaves, f"key STRING, {result}")
    rows = keyed.select("doc_id", "key").join(long, "key").select("doc_id", *names)
    return whole.mapInArrow(encode_rows, f"doc_id BIGINT, {result}").unionByName(rows)


def encode_documents(docs: DataFrame, tokenizer: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian uint32) of every whole text, as the tokenizers library encodes it.

    Null and empty texts have no tokens; a special token's string in a text is that token; repeated rows repeat.
    """
    return _encoded(docs, tokenizer, leaf_chars, lambda _, ids: packed(ids), "n_tokens BIGINT, ids BINARY")


def decode_documents(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to the empty text."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        for s in slices(batches, "ids"):
            texts = [b.decode(np.frombuffer(x or b"", "<u4")) for x in s.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return pick(encoded, "doc_id", "ids").mapInArrow(kernel, "doc_id BIGINT, text STRING")


def encode_digests(docs: DataFrame, tokenizer: str | None = None, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode, then decode the ids again, keeping only digests."""
    return _encoded(docs, tokenizer, leaf_chars, digests, DIGEST)
