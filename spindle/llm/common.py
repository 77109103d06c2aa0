"""Helpers shared by the operators: column picking, bounded batches, word shingles, per-process caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from spindle.session import work_path

SLICE_BYTES = 4 << 20  # text handled at once by a Python kernel; a longer text is a slice of its own
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, found by exact name and position.

    Extra columns go, so none of them can clash with an operator's own columns, not even one that differs in case
    only (which Spark would call ambiguous).
    """
    at = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).selectExpr(*[f"c{at[n]} AS `{n}`" for n in names])


def sheltered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with every column but the named ones under a name nothing else uses, and its own names in order.

    Operators that pass columns through work on the first and end with ``toDF`` of the second, so that no extra column
    can clash with theirs.
    """
    at = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    keep = {at[n] for n in names if n in at}
    return df.toDF(*[n if i in keep else f"_extra_{i}" for i, n in enumerate(df.columns)]), df.columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in Arrow batches of a slice's bytes, where the session does not say otherwise.

    The default bounds a batch by 10,000 rows, which is tens of MB of texts in the JVM and in every worker."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, f"{SLICE_BYTES}b")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the cluster's shared folder and read back.

    Cuts the lineage so that a lost executor costs a re-read, and lets several consumers share one computation.
    """
    path = work_path(df.sparkSession, "llm", tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one slice holds at most ``limit`` bytes of ``column`` (one row at least).

    After the last, what the task has freed goes back to the system: workers wait for their next task beside others."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(size)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def give_back() -> None:
    """Returns memory that a worker has freed to the system, where its C library can; workers outlive their tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def process_cache(name: str, make: Callable[[], object], version: object = None) -> object:
    """An object made once per Python worker process; it outlives a task, as workers are reused.

    A worker holds one object only: another name or version takes its place, so that a worker that has served several
    operators, or several fitted models, holds no more than the largest of them.
    """
    home = sys.modules.setdefault("_spindle_llm_cache", types.ModuleType("_spindle_llm_cache")).__dict__
    if home.get("key") != (name, version):
        home["key"] = home["value"] = None
        give_back()
        home["value"] = make()
        home["key"] = name, version
    return home["value"]


def empty_cache() -> None:
    """Ends what a worker's last operator left in it, for a step that keeps nothing and needs the room."""
    process_cache("", lambda: None)


# ------------------------------------------------------------------------------------------------------------------
# Word shingles
# ------------------------------------------------------------------------------------------------------------------

SHINGLE_WORDS = 5
MEMO_WORDS = 100_000  # entries of a worker's word memo before it is emptied


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text with A-Z in lower case (bytes methods know ASCII only)."""
    return text.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply), vectorised; bijective."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Word -> 64-bit hash, filled on demand."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: bytes | None, memo: WordHashes) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending (uint64).

    Five words to a shingle; with fewer words the whole sequence is the one shingle; without words, or with a null
    text, none.
    """
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    width = min(SHINGLE_WORDS, len(words))
    acc = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(width):  # each position has an odd multiplier of its own, so order counts
            acc += mix64(h[j : j + n] * np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) & (2**64 - 1)))
            acc = mix64(acc)
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()
