from __future__ import annotations

import os

import pytest
from support import SF001

from spindle.operators import words as wc
from spindle.sources.text import documents, read_docs

# ␣ is one space.
F5 = ["a b  a", "", "   ", " c d  ", "x"]
F5_COUNTS = {"": 3, "a": 2, "b": 1, "c": 1, "d": 1, "x": 1}


@pytest.fixture()
def f5(spark):
    return spark.createDataFrame(list(enumerate(F5)), "doc_id BIGINT, text STRING")


@pytest.mark.parametrize(
    "plan",
    [
        wc.word_count,
        lambda d: wc.word_count_salted(d, 3),
        lambda d: wc.word_count_salted_pairs(d, 3),
        wc.word_count_partition,
    ],
)
def test_f5_counts_every_plan(f5, plan):
    got = {r.word: r.n for r in plan(f5).collect()}
    assert got == F5_COUNTS


def test_f5_summaries(f5):
    assert wc.doc_count(f5).first().n_docs == 5
    counts = wc.word_count(f5)
    assert wc.distinct_words(counts).first().n_words == 6
    assert wc.avg_word_length(counts).first().avg_length == pytest.approx(5 / 6)


def test_tabs_newlines_and_case_stay(spark):
    d = spark.createDataFrame([(0, "A\tb a\nB a")], "doc_id BIGINT, text STRING")
    assert {r.word: r.n for r in wc.word_count(d).collect()} == {"A\tb": 1, "a\nB": 1, "a": 1}


def test_utf16_length_counts_surrogates(spark):
    d = spark.createDataFrame([(0, "\U0001F600 ab")], "doc_id BIGINT, text STRING")
    r = wc.avg_word_length(wc.word_count(d)).first()
    assert r.avg_length == pytest.approx((2 + 2) / 2)


def test_read_docs_one_line_per_document(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "docs.txt")
    with open(path, "w") as f:
        f.write("\n".join(F5) + "\n")
    docs = read_docs(spark, path)
    assert docs.count() == 5
    got = {r.word: r.n for r in wc.word_count(docs).collect()}
    assert got == F5_COUNTS


def test_plans_agree_on_documents(spark):
    d = documents(spark, SF001)
    base = sorted(wc.word_count(d).collect())
    for plan in (wc.word_count_salted, wc.word_count_salted_pairs, wc.word_count_partition):
        assert sorted(plan(d).collect()) == base


def test_explicit_partitions_give_the_same_rows(f5):
    assert {r.word: r.n for r in wc.word_count(f5, partitions=3).collect()} == F5_COUNTS
    assert {r.word: r.n for r in wc.word_count_partition(f5, partitions=5).collect()} == F5_COUNTS
    assert {r.word: r.n for r in wc.word_count_salted(f5, salts=2, partitions=4).collect()} == F5_COUNTS
