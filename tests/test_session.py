"""Session helpers: the explicit spread and the shared checkpoint folder rule."""

from __future__ import annotations

import pytest
from support import SF001

from spindle.session import ensure_checkpoint_dir, spread


def test_spread_is_explicit(spark):
    df = spark.read.parquet(f"{SF001}/lineitem.parquet")
    assert spread(df, None) is df
    assert spread(df, 3).rdd.getNumPartitions() == 3


def test_building_operators_starts_no_job(spark):
    from spindle.operators import clustering as clu
    from spindle.operators import sketch as sk
    from spindle.operators import words as wc
    from spindle.functions.hashing import hash_family
    from spindle.sources.points import lineitem_points
    from spindle.sources.text import documents, lineitem_items

    docs = documents(spark, SF001).groupBy("doc_id").agg({"text": "max"}).toDF("doc_id", "text")
    points, items, fam = lineitem_points(spark, SF001), lineitem_items(spark, SF001), hash_family(3, 10, seed=1)
    spark.sparkContext.setJobGroup("building", "")
    counts = wc.word_count(docs)
    for _ in (wc.distinct_words(counts), wc.avg_word_length(counts), wc.word_count_partition(docs), clu.group_counts(points),
              clu.assign(points, [[1.0, 2.0]]), clu.objectives(points, [[float(i), 0.0] for i in range(40)]),
              sk.item_frequency(items), sk.cell_state(items, fam), sk.count_min_cells(items, fam)):
        pass
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == 0
    spark.sparkContext.setJobGroup("", "")


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default

    def set(self, key, value):
        self.value = value


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, value=None):
        self.conf = _Conf(value)
        self.sparkContext = _Context(master)


def test_cluster_session_needs_a_shared_checkpoint_folder():
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_Session("yarn"))
    s = _Session("yarn", "hdfs:///shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_local_session_gets_a_scratch_folder():
    s = _Session("local[2]")
    path = ensure_checkpoint_dir(s)
    assert path and s.conf.value == path and s.sparkContext.dir == path
