"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input.

1. ``toxicity`` (4): documents the model rejects go.  It is fitted to this stage's documents and the ``labels`` table.
2. ``near_dedup`` (5): one document of every group of near-duplicates stays.
3. ``secrets`` (1): found secrets are masked in the text; every document stays.
4. ``mixing`` (9): documents are repeated or left out so that sources come near their target weights.
5. ``bpe`` (3): token ids of every document left, with their count and digests.

Edge cases, each as its operator's module states it: a null or empty text is scored as one empty window, has no words to
share (all such rows stay), no secrets, size 0 in the mix and no tokens; a null doc_id takes part through its text;
repeated rows are near-duplicates of each other; a null source is a source of its own; a text may be of any length; columns
beyond those of ``documents`` are dropped by each stage, whatever their names; an empty table passes through as one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindle.llm.bpe import encode_digests
from spindle.llm.common import bounded_batches, pick, stored, table
from spindle.llm.minhash import drop_near_duplicates
from spindle.llm.mixing import mix_documents
from spindle.llm.secret_scan import redact_secrets
from spindle.llm.toxicity import drop_toxic

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return drop_toxic(pick(docs, *COLUMNS), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return drop_near_duplicates(pick(docs, *COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return redact_secrets(pick(docs, *COLUMNS))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(pick(docs, *COLUMNS))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return encode_digests(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: No SQL: a trained network, MinHash components, a lexer and BPE; held against a brute-force version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
