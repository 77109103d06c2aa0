"""Document and item sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from spindle.functions.text import parse_item


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """One document per text line: ``(doc_id BIGINT, text STRING)``; the id is unique but position-derived."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("doc_id"), F.col("value").alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``documents`` table: one row is one document (text may hold newlines)."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def parse_items(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(value, item)``: ``item`` is NULL for a line that is not a 64-bit integer; such lines still count as
    processed by the frequency operators."""
    return lines.withColumn("item", parse_item(F.col(value)))


def items_from_column(df: DataFrame, col: Column | str, batch: Column | None = None) -> DataFrame:
    """Item lines taken from a table column rendered as text, with an optional batch key."""
    c = F.col(col) if isinstance(col, str) else col
    cols = [c.cast("string").alias("value")]
    if batch is not None:
        cols.append(batch.alias("batch"))
    if isinstance(df.select(c).schema[0].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return df.select(*cols, c.cast("bigint").alias("item"))  # already a 64-bit integer: nothing to parse
    return parse_items(df.select(*cols))


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items = ``events.user_id``, micro-batch = day of ``ts``."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return items_from_column(ev, "user_id", F.to_date("ts"))


def lineitem_items(spark: SparkSession, sf_dir: str, column: str = "l_partkey") -> DataFrame:
    """Items from a wide-range ``lineitem`` key column."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return items_from_column(li, column)
