"""Token counts as delta-maintained rollups.

A ledger is a folder.  A batch is a set of signed changes: a document inserted (+1, +tokens), deleted (-1, -tokens) or
recounted (0, new - old).  Committing a batch sums its changes by source, language and tokenizer version and writes
that small table under the batch's id; the totals are the sum over the committed batches, so inserts, deletes and
revisions cost what they change, never a recount.  A base holds the totals of some batches and their ids in one table;
``totals()`` reads the newest base and the batches it does not name.  A new base is written every ``compact_every``
batches.  Batch ids, which the ledger's folder lists by name, are all that comes to the driver.

Commits are idempotent.  A batch is written to ``batch=<id>`` in one overwrite and counts only once Spark's own success
marker is there; committing an id again that is already complete changes nothing, and an attempt that died leaves a
folder without marker, which readers pass over and the next attempt overwrites.  Bases count by the same marker.  A
batch that stands in a base keeps its folder, so it is never taken twice.

Edge cases: null source or language is a group of its own; a null text has no tokens but is a document; a null doc_id
is inserted and counted, and can be deleted like any other; repeated rows count repeatedly; an empty batch commits an
empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spindle.llm.bpe import LEAF_CHARS, bpe, join_tree, leaves_of
from spindle.llm.common import pick, slices, stored
from spindle.session import work_path

KEYS = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens", "inserted", "deleted", "revised")
ROLLUP = ", ".join([*(f"{k} STRING" for k in KEYS), *(f"{s} BIGINT" for s in SUMS)])
CHANGES = ("source", "lang", "tokenizer", "kind", "tokens")


COUNTS = "doc_id BIGINT, source STRING, lang STRING, th BINARY, tokenizer STRING, tokens BIGINT"
BASE = f"batch STRING, {ROLLUP}"  # totals have no batch; rows with one say that it is in them
HOT_SHARE = 1000  # a text with more than this part of all rows is hot; there are fewer than this many such texts


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``doc_id, source, lang, th, tokenizer, tokens`` of every whole text: one row per tokenizer version.

    Versions: ``byte_bpe_50k`` (or the vocabulary file given) and ``words`` (white-space words).  ``th`` is a
    digest of the text, 128 bits of its SHA-256.
    """
    versions = ["byte_bpe_50k" if tokenizer is None else tokenizer.rsplit("/", 1)[-1], "words"]

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bpe(tokenizer)
        for s in slices(batches, "text"):
            texts = s.column("text").to_pylist()
            bpe_count = [
                len(b.encode_one(t)) if len(t) <= LEAF_CHARS else len(join_tree(b, b.encode(leaves_of(t, b.specials))))
                for t in texts
            ]
            for version, n in zip(versions, (bpe_count, [len(t.encode().split()) for t in texts]), strict=True):
                columns = [s.column(c) for c in ("doc_id", "source", "lang", "th")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                    ["doc_id", "source", "lang", "th", "tokenizer", "tokens"],
                )

    rows = pick(docs, "doc_id", "source", "lang", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("th", F.substring(F.unhex(F.sha2("text", 256)), 1, 16)).mapInArrow(kernel, COUNTS)


def inserts(counts: DataFrame) -> DataFrame:
    return pick(counts, *KEYS, "tokens").selectExpr(*KEYS, "'insert' AS kind", "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return pick(counts, *KEYS, "tokens").selectExpr(*KEYS, "'delete' AS kind", "-tokens AS tokens")


def revisions(counts: DataFrame) -> DataFrame:
    """From ``old_tokens`` and ``tokens`` of documents that were counted before."""
    return pick(counts, *KEYS, "old_tokens", "tokens").selectExpr(*KEYS, "'revise' AS kind", "tokens - old_tokens AS tokens")


class TokenLedger:
    """Committed batches under a folder (``path``) that all executors share."""

    def __init__(self, spark: SparkSession, path: str | None = None, compact_every: int = 64):
        self.spark = spark
        self.path = path or work_path(spark, "llm", "ledger")
        self.compact_every = compact_every

    def _folder(self, batch: str) -> str:
        return f"{self.path}/batch={batch}"

    def _fs(self, path: str):
        """A Hadoop path and its file system."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _complete(self, kind: str) -> list[str]:
        """Names of the folders ``<kind>=<name>`` that have their marker, by one listing."""
        p, fs = self._fs(f"{self.path}/{kind}=*/_SUCCESS")
        names = [s.getPath().getParent().getName() for s in fs.globStatus(p) or []]
        return sorted(n.removeprefix(f"{kind}=") for n in names)

    def committed(self, batch: str) -> bool:
        p, fs = self._fs(f"{self._folder(batch)}/_SUCCESS")
        return fs.exists(p)

    def batches(self) -> list[str]:
        return self._complete("batch")

    def _write(self, rows: DataFrame, path: str) -> None:
        marker = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
        rows.write.mode("overwrite").option(marker, "true").parquet(path)

    def _newest(self) -> tuple[int, DataFrame]:
        """Number and rows of the newest base (0 and none before the first)."""
        n = max(map(int, self._complete("base")), default=0)
        schema = StructType.fromDDL(BASE)
        return n, self.spark.read.schema(schema).parquet(f"{self.path}/base={n}") if n else self.spark.createDataFrame([], schema)

    def _parts(self) -> tuple[int, DataFrame, list[str], list[str]]:
        """The newest base's number and totals, the batches in it, and those after it."""
        n, base = self._newest()
        inside = {r["batch"] for r in base.where("batch IS NOT NULL").select("batch").collect()} if n else set()
        return n, base.where("batch IS NULL").drop("batch"), sorted(inside), [b for b in self.batches() if b not in inside]

    def pending(self) -> list[str]:
        """Committed batches that no base holds yet."""
        return self._parts()[3]

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Add a batch's changes; False if that batch is already in, in which case nothing is read or written."""
        if self.committed(batch):
            return False
        rows = reduce(DataFrame.unionByName, [pick(c, *CHANGES) for c in changes])
        sign = F.when(F.col("kind") == "insert", 1).when(F.col("kind") == "delete", -1).otherwise(0)
        kinds = {"inserted": "insert", "deleted": "delete", "revised": "revise"}
        changed = rows.groupBy(*KEYS).agg(
            F.sum(sign).cast("bigint").alias("docs"),
            F.sum("tokens").alias("tokens"),
            *[F.sum((F.col("kind") == k).cast("bigint")).alias(n) for n, k in kinds.items()],
        )
        self._write(changed, self._folder(batch))
        if len(self.pending()) >= self.compact_every:
            self.compact()
        return True

    def _sum(self, base: DataFrame, after: list[str]) -> DataFrame:
        rows = base
        if after:
            rows = rows.unionByName(self.spark.read.schema(StructType.fromDDL(ROLLUP)).parquet(*map(self._folder, after)))
        return rows.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS])

    def compact(self) -> bool:
        """Write the next base, with every batch committed so far; False if the newest holds them all.

        The base before it stays for readers that have begun with it, older ones go.
        """
        n, base, inside, after = self._parts()
        if not after:
            return False
        ids = self.spark.createDataFrame([(b,) for b in inside + after], "batch STRING")
        rows = self._sum(base, after).withColumn("batch", F.lit(None).cast("string"))
        self._write(rows.unionByName(ids, allowMissingColumns=True), f"{self.path}/base={n + 1}")
        p, fs = self._fs(f"{self.path}/base={n - 1}")
        fs.delete(p, True)
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer`` with the sums over all committed batches."""
        _, base, _, after = self._parts()
        return self._sum(base, after)


def mark_copies(counts: DataFrame) -> DataFrame:
    """``counts`` with ``copy``: the text stands under a smaller doc_id too.

    The smallest doc_ids of hot texts, fewer than ``HOT_SHARE`` rows, are broadcast, so the rows of a hot text stay where
    they are; those of the others are joined by a shuffle.
    """
    texts = stored(counts.groupBy("th").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "token-texts")
    rows = texts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(texts.where(F.col("n") * HOT_SHARE > rows).select("th", "first"))
    cold = texts.where(F.col("n") * HOT_SHARE <= rows).select("th", "first")
    both = counts.join(hot, "th").unionByName(counts.join(hot, "th", "left_anti").join(cold, "th"))
    return both.withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))


def corpus_rollup(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """A corpus's life in four commits, and the totals after them.

    1. All documents are inserted with their counts under each tokenizer version.
    2. Documents whose whole text also stands under a smaller doc_id are deleted again.
    3. The counts of the documents left are revised: the end token of each now counts too.
    4. A base takes the batches in; batches 2 and 3 arrive once more and change nothing.

    Rows with a null doc_id, and repeated rows of the smallest doc_id, are not taken for copies.
    """
    counts = stored(token_counts(docs, tokenizer), "token-counts")
    marked = stored(mark_copies(counts), "token-copies")
    copies = marked.where("copy")
    left = marked.where("NOT copy").withColumnRenamed("tokens", "old_tokens")
    ledger = TokenLedger(docs.sparkSession)
    ledger.commit("0001-insert", inserts(counts))
    for _ in range(2):
        ledger.commit("0002-copies", deletes(copies))
        ledger.commit("0003-end-token", revisions(left.withColumn("tokens", F.col("old_tokens") + 1)))
        ledger.compact()
    return ledger.totals()
