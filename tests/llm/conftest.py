from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE), os.path.dirname(os.path.dirname(HERE))]

from llm_support import SCHEMA, odd_rows  # noqa: E402

SF = os.environ.get("SPINDLE_LLM_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    """``doc_id, text`` of the test table."""
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with internal ones and with each other by case."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), SCHEMA)
    names = ["key", "size", "node", "shard", "p", "n", "tokens", "u", "v", "TEXT", "Doc_ID", "kept"]
    return df.select("*", *[F.lit(i).alias(x) for i, x in enumerate(names)])


@pytest.fixture(scope="session")
def odd_pairs():
    return [(r[0], r[1]) for r in odd_rows()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
