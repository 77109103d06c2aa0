"""Word count over documents ``(doc_id, text)``, with plain, salted and per-partition plans.

All four counting plans give the same rows.  The plain one relies on Spark's partial aggregation, which already
combines counts inside each task (a superset of per-document combining), so a word that makes up a third of all
tokens still reaches its reducer as one row per map task.  The salted plans spread each word over ``partitions``
reducers in the first round; their salt is a hash of the token's position, not a random draw, so a retried task
produces the same keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import utf16_length, words
from spindle.session import spread


def tokens(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(doc_id, word)``, one row per token; ``partitions`` spreads the documents first (default: the scan's layout)."""
    return spread(docs, partitions).select("doc_id", F.explode(words(F.col("text"))).alias("word"))


def tokens_with_pos(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    return spread(docs, partitions).select("doc_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))


def doc_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def word_count(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(word, n)``: occurrences of every word (one round)."""
    return tokens(docs, partitions).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_per_doc(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(doc_id, word, n)``: the per-document (word, count) pairs."""
    return tokens(docs, partitions).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def _two_round(keyed: DataFrame) -> DataFrame:
    first = keyed.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
    return first.groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def word_count_salted(docs: DataFrame, salts: int = 8, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Two rounds; every token draws its own key in [0, salts) while mapping."""
    t = tokens_with_pos(docs, partitions)
    salt = F.pmod(F.xxhash64(F.col("doc_id"), F.col("pos"), F.lit(seed)), F.lit(salts))
    return _two_round(t.select(salt.alias("salt"), "word"))


def word_count_salted_pairs(
    docs: DataFrame, salts: int = 8, seed: int = 0, partitions: int | None = None
) -> DataFrame:
    """Two rounds; the key in [0, salts) is drawn per per-document (word, count) pair at grouping time."""
    t = tokens(docs, partitions)
    salt = F.pmod(F.xxhash64(F.col("doc_id"), F.col("word"), F.lit(seed)), F.lit(salts))
    return _two_round(t.select(salt.alias("salt"), "word"))


def word_count_partition(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Two rounds; first count inside each input partition, then sum the partition counts."""
    t = tokens(docs, partitions)
    return _two_round(t.select(F.spark_partition_id().alias("salt"), "word"))


def distinct_words(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count(F.lit(1)).alias("n_words"))


def avg_word_length(counts: DataFrame) -> DataFrame:
    """Average length of the distinct words, in UTF-16 code units."""
    return counts.agg(F.count(F.lit(1)).alias("n_words"), F.avg(utf16_length(F.col("word"))).alias("avg_length"))
