"""Token-id files: frequency-ranked ids, byte-aligned variable-length codes, separate control bytes.

A file holds whole documents in ascending doc_id order; the files of a run, in manifest order, are one sequence.

    bytes   content
    8       magic ``VBTOK001``
    8 x 4   number of documents d, of tokens t, of different ids v, of data bytes b (little-endian uint64)
    4 v     the file's ids by falling frequency, ties by id (uint32): place in this table = rank
    d       1 where the doc_id is null
    8 d     doc_ids (int64)
    4 d     tokens per document (uint32)
    t/4     control bytes, rounded up: two bits a token, lowest first, number of data bytes less one
    b       data bytes: each rank, little-endian, without leading zero bytes

The rank table is the file's own, so a file can be written in one pass and read alone, and ranks fit its content; the
256 most frequent ids of a file take one byte.  Decoding looks every control byte up in a 256-row table of four
lengths, turns lengths into offsets by a running sum, and gathers the data bytes.

Documents are range-partitioned by doc_id (texts move once), encoded and written by the task that gets them.  Each file
has a name of its own per attempt; the manifest lists the files of the attempts that succeeded, and readers use nothing
else, so a lost executor or a repeated task leaves at most unread files.

Edge cases: null and empty texts have only the end id; null doc_ids come first; rows with equal doc_ids are ordered by
text; an empty table writes no file; extra columns are ignored; a document is never split between files.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spindle.llm.bpe import bpe, encode_text
from spindle.llm.common import pick, slices, stored
from spindle.session import work_path

MAGIC = b"VBTOK001"
END_ID = 2
FILE_TOKENS = 4 << 20  # a file is closed once it holds this many


def length_table() -> np.ndarray:
    """Control byte -> data bytes of its four tokens."""
    c = np.arange(256)
    return np.stack([(c >> s & 3) + 1 for s in (0, 2, 4, 6)], axis=1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of non-negative ranks below 2**32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[: len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    parts = ranks.view(np.uint8).reshape(-1, 4)
    data = parts[np.arange(4) < size[:, None]]  # row by row, lowest byte first
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = length_table()[control].reshape(-1)[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    out = np.zeros(n, "<u4")
    for k in range(int(size.max(initial=0))):
        longer = size > k
        at = start if longer.all() else start[longer]
        if len(at) == n:
            out |= padded[at + k].astype("<u4") << np.uint32(8 * k)
        else:
            out[longer] |= padded[at + k].astype("<u4") << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """One file's content for documents and their ids (end ids included)."""
    tokens = np.concatenate(ids) if ids else np.empty(0, "<u4")
    counts = np.bincount(tokens) if len(tokens) else np.empty(0, np.int64)
    used = np.flatnonzero(counts)
    used = used[np.argsort(-counts[used], kind="stable")]
    rank = np.zeros(len(counts), "<u4")
    rank[used] = np.arange(len(used))
    control, data = encode_ranks(rank[tokens])
    head = np.array([len(ids), len(tokens), len(used), len(data)], "<u8").tobytes()
    return b"".join([
        MAGIC, head, used.astype("<u4").tobytes(), bytes(d is None for d in doc_ids),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([len(x) for x in ids], "<u4").tobytes(),
        control, data,
    ])


def parse_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``doc_ids``, tokens per document and all ids of a file."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    d, t, v, b = (int(x) for x in np.frombuffer(content, "<u8", 4, 8))
    at = 40

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        x = np.frombuffer(content, kind, n, at)
        at += x.nbytes
        return x

    used, null, doc_ids, sizes = take("<u4", v), take("u1", d), take("<i8", d), take("<u4", d)
    control, data = take("u1", -(-t // 4)), take("u1", b)
    if at != len(content):
        raise ValueError("token file cut short or too long")
    ids = used[decode_ranks(control, data, t)] if t else np.empty(0, "<u4")
    return [None if n else int(i) for n, i in zip(null, doc_ids, strict=True)], sizes, ids


def write_bytes(folder: str, name: str, content: bytes) -> None:
    """To any file system Arrow knows (local paths, file://, hdfs://, s3://, gs://)."""
    from pyarrow import fs

    if "://" in folder:
        system, base = fs.FileSystem.from_uri(folder)
    else:
        system, base = fs.LocalFileSystem(), folder.removeprefix("file:")
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{name}") as f:
        f.write(content)


MANIFEST = "part INT, seq INT, file STRING, docs BIGINT, tokens BIGINT, bytes BIGINT"


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = END_ID,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the files; the manifest (``part, seq`` order the files) is returned, stored in the shared folder."""
    folder = folder or work_path(docs.sparkSession, "llm", "tokens")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, ids, held, seq
            content = file_bytes(doc_ids, ids)
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tok"
            write_bytes(folder, name, content)
            row = [part, seq, name, len(ids), held, len(content)]
            doc_ids, ids, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pylist(
                [dict(zip(("part", "seq", "file", "docs", "tokens", "bytes"), row, strict=True))],
                pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in ("docs", "tokens", "bytes"))]),
            )

        end = np.array([end_id], "<u4")
        for s in slices(batches, "text"):
            for doc_id, text in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist(), strict=True):
                x = np.concatenate([encode_text(b, text), end])
                doc_ids.append(doc_id)
                ids.append(x)
                held += len(x)
                if held >= file_tokens:
                    yield close()
        if ids:
            yield close()

    ordered = pick(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(kernel, MANIFEST), "token-manifest").withColumn("folder", F.lit(folder))


def file_starts(manifest: DataFrame) -> DataFrame:
    """``file, start``: ids in all files before.  First over the files of a part, then over the parts' totals."""
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("part").agg(F.sum("tokens").alias("t"))
    totals = totals.select("part", F.coalesce(F.sum("t").over(parts), F.lit(0)).alias("base"))
    inside = manifest.select("part", "file", F.coalesce(F.sum("tokens").over(within), F.lit(0)).alias("inside"))
    return inside.join(totals, "part").select("file", (F.col("base") + F.col("inside")).alias("start"))


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of the manifest."""
    first = manifest.select("folder").first()
    if first is None:
        return spark.createDataFrame([], "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(first["folder"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column("file"), batch.column("content"), strict=True):
                doc_ids, sizes, ids = parse_file(data.as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file.as_py()] * len(doc_ids)), pa.array(doc_ids, pa.int64()), pa.array(ends - sizes),
                        pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64()),
                    ],
                    ["file", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    schema = "file STRING, doc_id BIGINT, offset BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    docs = content.select(name, "content").mapInArrow(kernel, schema)
    # Files without a row in the manifest are left over from failed attempts and drop out here.
    return docs.join(file_starts(manifest), "file").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
