"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever the document's length, so the
sketch of a union is the union of sketches, and the share of one sketch found in another estimates containment even
between documents of very unequal length.  The least hash is always kept, so a document with any word has a sketch.

A fingerprint is the kept hashes, ascending, as 12 hexadecimal digits each (48 bits), joined without a separator; a text
without words has the empty fingerprint.  Equal texts have equal fingerprints.

The next document in descending doc_id order is found without a window over everything: rows are dealt into doc_id
ranges, ordered inside them, and each range also gets a copy of the first row of the range that follows it.

Edge cases: a null text counts as empty; null doc_ids come last in the order; rows with equal doc_ids are ordered by
text, descending; an empty table gives no rows; a single document is its own next; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import WordHashes, pick, process_cache, shingle_hashes, slices

FRACTION = 1 / 2  # of short texts, a smaller one keeps too few hashes to estimate from
HASH_BITS = 48
RANGE_ROWS = 64  # documents of a doc_id range, about, until there are MOST_RANGES ranges; then ranges grow
MOST_RANGES = 1 << 16
SAMPLE_PER_RANGE = 20  # doc_ids drawn per range, about, to place the ranges' ends
SEED = 5
NO_ID = -(2**63)  # place of a null doc_id in the order


def sketch(text: bytes, memo: WordHashes, fraction: float = FRACTION) -> np.ndarray:
    """The kept hashes of a text's five-word shingles, ascending."""
    h = shingle_hashes(text, memo) >> np.uint64(64 - HASH_BITS)
    return np.unique(h[: max(1, int(np.searchsorted(h, np.uint64(int(fraction * 2**HASH_BITS)))))])


def to_text(hashes: np.ndarray) -> str:
    return "".join([f"{h:012x}" for h in hashes.tolist()])


def from_text(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, HASH_BITS // 8)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 8 - HASH_BITS // 8 :] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def merge(*fingerprints: str) -> str:
    """The fingerprint of the documents' union: all kept hashes (a least hash kept beyond the fraction goes, unless it
    is all there is)."""
    h = np.unique(np.concatenate([np.empty(0, np.uint64), *map(from_text, fingerprints)]))
    return to_text(h[: max(1, int(np.searchsorted(h, np.uint64(int(FRACTION * 2**HASH_BITS)))))])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True)) if len(a) and len(b) else 0


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; 1 for two empty sketches (texts without words), 0 for one."""
    if not len(a) and not len(b):
        return 1.0
    both = _common(a, b)
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` holds too; 0 for an empty ``a``."""
    return _common(a, b) / len(a) if len(a) else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third (rounded down) replaced by as many first characters of ``following``, or all."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


RESULT = (
    "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, edited_fingerprint STRING, "
    "near_edited DOUBLE, near_next DOUBLE, contained_edited DOUBLE"
)


def in_ranges(docs: DataFrame) -> DataFrame:
    """``p, guest, doc_id, key, text``: rows dealt into doc_id ranges ``p`` (0: the largest ids); each range's first row
    stands once more, as ``guest``, in the range before it, and the first range's in the last.

    Only splitters and first keys, at most ``MOST_RANGES`` numbers each, go through the driver.
    """
    rows = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), "text")
    rows_found = rows.count()
    ranges = int(min(MOST_RANGES, max(1, rows_found // RANGE_ROWS)))
    shares = [i / ranges for i in range(1, ranges)]
    sample = rows.where(F.rand(SEED) * rows_found < ranges * SAMPLE_PER_RANGE)  # ranges say where rows go, never what comes out
    cut = sample.agg(F.percentile_approx("key", shares, 20 * ranges)).first()[0] if shares else None
    splitters = np.unique(np.array(cut or [], np.int64))

    def place(key: pa.Array) -> np.ndarray:
        return len(splitters) - np.searchsorted(splitters, key.to_numpy(zero_copy_only=False), "right")

    def first_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, key = place(b.column("key")), b.column("key").to_numpy(zero_copy_only=False)
            order = np.lexsort((~key, at))  # ~ reverses the order of integers without overflow
            p, i = np.unique(at[order], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(key[order][i])], ["p", "key"])

    found = rows.select("key").mapInArrow(first_keys, "p INT, key BIGINT").groupBy("p").agg(F.max("key").alias("key"))
    first = {r["p"]: r["key"] for r in found.collect()}
    used = sorted(first)
    before = {p: used[i - 1] for i, p in enumerate(used)}  # the range whose last row is followed by p's first

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            at, key = place(b.column("key")), b.column("key").to_numpy(zero_copy_only=False)
            guests = [i for i, (p, k) in enumerate(zip(at.tolist(), key.tolist(), strict=True)) if first[p] == k]
            take = pa.array([*range(b.num_rows), *guests], pa.int64())
            p = pa.array([*at.tolist(), *(before[int(at[i])] for i in guests)], pa.int32())
            guest = pa.array([False] * b.num_rows + [True] * len(guests))
            columns = [b.column(c).take(take) for c in ("doc_id", "key", "text")]
            yield pa.RecordBatch.from_arrays([p, guest, *columns], ["p", "guest", "doc_id", "key", "text"])

    return rows.mapInArrow(deal, "p INT, guest BOOLEAN, doc_id BIGINT, key BIGINT, text STRING")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike both, and the next document, are.

    ``contained_edited`` estimates the share of the document's shingles that the edited text still holds.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = process_cache("words", WordHashes)
        current = None  # p, guest, doc_id, text, sketch of the row that waits for its next
        for s in slices(batches, "text"):
            out = []
            columns = [s.column(c).to_pylist() for c in ("p", "guest", "doc_id", "text")]
            for p, guest, doc_id, text in zip(*columns, strict=True):
                if guest and current is not None and current[0] == p and current[1]:
                    continue  # a further row with the first row's doc_id
                text = text or ""
                mine = sketch(text.encode(), memo)
                if current is not None and current[0] == p and not current[1]:
                    out.append(row_of(*current[2:], text, mine, memo))
                current = (p, guest, doc_id, text, mine)
            if out:
                yield pa.RecordBatch.from_pylist(out, RESULT_ARROW)

    dealt = in_ranges(docs)
    together = dealt.repartition("p").sortWithinPartitions("p", "guest", F.desc("key"), F.desc("text"))
    return together.select("p", "guest", "doc_id", "text").mapInArrow(kernel, RESULT)


RESULT_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("contained_edited", pa.float64()),
    ]
)


def row_of(doc_id: int | None, text: str, mine: np.ndarray, following: str, its: np.ndarray, memo: WordHashes) -> dict:
    new = edited(text, following).encode()
    changed = sketch(new, memo)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(new).hexdigest(),
        "fingerprint": to_text(mine),
        "edited_fingerprint": to_text(changed),
        "near_edited": likeness(mine, changed),
        "near_next": likeness(mine, its),
        "contained_edited": containment(mine, changed),
    }
