from __future__ import annotations

import os
import time

import pytest
from support import SF001
from pyspark.sql import functions as F

from spindle.functions.hashing import hash_family
from spindle.operators import sketch as sk
from spindle.sources.text import event_items
from spindle.streaming.items import BoundedSink, item_stream, run_bounded, run_running_state

FAM = hash_family(7, 100, seed=48)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_running_state_equals_batch(spark):
    rs = run_running_state(item_stream(spark, SF001, "user_id", glob="events.parquet"), FAM)
    processed, freq, cm, cs = rs.tables()
    items = event_items(spark, SF001)
    assert _rows(rs.state()) == _rows(sk.cell_state(items, FAM))  # the stream's state is the batch state
    assert _rows(freq) == _rows(sk.item_frequency(items))
    assert _rows(cm) == _rows(sk.count_min_cells(items, FAM))
    assert _rows(cs) == _rows(sk.count_sketch_cells(items, FAM))
    assert processed.first().processed == items.count()
    held = list(rs.held)
    assert len(held) == 2 and all(df.storageLevel.useMemory for df in held)
    rs.release()
    assert not rs.held and not any(df.storageLevel.useMemory for df in held)
    assert _rows(freq) == _rows(sk.item_frequency(items))  # read anew


def test_state_has_the_partitions_asked_for(spark, tmp_path):
    from spindle.streaming import items

    before = spark.conf.get("spark.sql.shuffle.partitions")
    lines = item_stream(spark, SF001, "user_id", glob="events.parquet")
    rs = run_running_state(lines, FAM, out_dir=f"{tmp_path}/out", partitions=3)
    assert len([d for d in os.listdir(f"{tmp_path}/out-ckpt/state/0") if d.isdigit()]) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert _rows(rs.state()) == _rows(sk.cell_state(event_items(spark, SF001), FAM))
    assert items.state_partitions(spark, SF001) <= int(before)


def split_by_day(spark, directory):
    """Write one parquet folder per day (``day=...``) with increasing file times: one micro-batch per day."""
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumn("day", F.to_date("ts").cast("string"))
    ev.repartition("day").write.partitionBy("day").parquet(directory)
    days = sorted(d for d in os.listdir(directory) if d.startswith("day="))
    base = int(time.time()) - 1000
    for i, d in enumerate(days):
        for name in os.listdir(os.path.join(directory, d)):
            os.utime(os.path.join(directory, d, name), (base + i, base + i))
    return len(days)


def test_bounded_stream_matches_batch_twin(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "events_by_day")
    n_days = split_by_day(spark, src)
    assert n_days == 30
    lines = item_stream(spark, src, "user_id", max_files_per_trigger=1)
    run = run_bounded(lines, FAM, threshold=300, timeout_s=120, trigger={"availableNow": True})
    assert run.reached and not run.timed_out
    twin = sk.batch_sizes(event_items(spark, SF001), 300).orderBy("batch").collect()
    log = run.sink.log(spark).orderBy("batch_id").collect()
    assert [(r.size, r.before) for r in log] == [(r.size, r.before) for r in twin]
    expect = sk.heavy_hitters(sk.bounded_items(event_items(spark, SF001), 300), FAM, 5)
    got = run.report(FAM, 5)
    assert _rows(got.summary) == _rows(expect.summary)
    assert _rows(got.report) == _rows(expect.report)


def test_bounded_sink_replay_is_idempotent(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "out")
    sink = BoundedSink(spark, out, FAM, threshold=10)
    batch = spark.createDataFrame([("1",), ("2",), ("2",)], "value STRING")
    sink(batch, 0)
    sink(batch, 0)  # replay after a failure
    sink(batch, 1)
    assert sink.total == 6
    restarted = BoundedSink(spark, out, FAM, threshold=10)
    assert restarted.total == 6 and restarted.before(2) == 6
    _, freq, _, _ = __import__("spindle.streaming.items", fromlist=["x"]).tables_from_cells(sink.state(spark))
    assert _rows(freq) == [(1, 2), (2, 4)]


def test_timeout_stops_an_idle_stream(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "lines")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("1\n2\nx\n")
    lines = item_stream(spark, src, "value", fmt="text")
    t = time.monotonic()
    run = run_bounded(lines, FAM, threshold=1000, timeout_s=3)
    assert run.timed_out and not run.reached
    assert time.monotonic() - t < 60
    s = run.report(FAM, 5).summary.first()
    assert (s.processed, s.n_distinct) == (3, 2)


@pytest.mark.parametrize("compact_every", [2, 3, 50])
def test_any_micro_batch_split_gives_the_batch_answer(spark, tmpdir_fresh, compact_every):
    import random

    rng = random.Random(5)
    values = [str(rng.choice([1, 2, 2, 3, 3, 3, 8192, 9000])) for _ in range(60)] + ["x", "+4", " 4"]
    rng.shuffle(values)
    cuts = sorted(rng.sample(range(1, len(values)), 3))
    parts = [values[a:b] for a, b in zip([0, *cuts], [*cuts, len(values)])]
    src = os.path.join(tmpdir_fresh, "lines")
    os.makedirs(src)
    base = int(time.time()) - 100
    for i, part in enumerate(parts):
        path = os.path.join(src, f"part-{i}.txt")
        with open(path, "w") as f:
            f.write("\n".join(part) + "\n")
        os.utime(path, (base + i, base + i))
    lines = item_stream(spark, src, "value", fmt="text", max_files_per_trigger=1)
    rs = run_running_state(lines, FAM, compact_every=compact_every)
    assert rs.query.lastProgress["batchId"] == len(parts) - 1  # one micro-batch per file
    batch = parse_lines(spark, values)
    processed, freq, cm, cs = rs.tables()
    assert processed.first().processed == len(values)
    assert _rows(freq) == _rows(sk.item_frequency(batch))
    assert _rows(cm) == _rows(sk.count_min_cells(batch, FAM))
    assert _rows(cs) == _rows(sk.count_sketch_cells(batch, FAM))


def parse_lines(spark, values):
    from spindle.sources.text import parse_items

    return parse_items(spark.createDataFrame([(v,) for v in values], "value STRING"))


def _cells(spark, *rows):
    return spark.createDataFrame(list(rows), "tag INT, a BIGINT, b BIGINT, v BIGINT").select(
        *[F.col(f.name).cast(f.dataType) for f in _cell_schema()]
    )


def _cell_schema():
    from pyspark.sql.types import StructType

    from spindle.operators.sketch import CELL_SCHEMA

    return StructType.fromDDL(CELL_SCHEMA)


def test_unfinished_snapshot_and_update_are_passed_over(spark, tmpdir_fresh):
    from spindle.streaming.items import _latest, _UpsertSink

    sink = _UpsertSink(tmpdir_fresh, compact_every=0)
    sink(_cells(spark, (1, 5, 0, 3)), 0)
    sink(_cells(spark, (1, 6, 0, 1)), 1)
    os.makedirs(f"{tmpdir_fresh}/snapshots/snap_id=1")  # begun, never completed
    os.makedirs(f"{tmpdir_fresh}/updates/batch_id=2")
    assert sorted(r["a"] for r in _latest(spark, tmpdir_fresh).collect()) == [5, 6]


def test_snapshots_replace_what_they_cover(spark, tmpdir_fresh):
    from spindle.streaming.items import _latest, _UpsertSink

    sink = _UpsertSink(tmpdir_fresh, compact_every=2)
    for i in range(9):
        sink(_cells(spark, (1, i % 4, 0, 10 + i)), i)
    assert sorted((r["a"], r["v"]) for r in _latest(spark, tmpdir_fresh).collect()) == [(0, 18), (1, 15), (2, 16), (3, 17)]
    assert sorted(os.listdir(f"{tmpdir_fresh}/snapshots")) == ["snap_id=5", "snap_id=7"]
    assert sorted(os.listdir(f"{tmpdir_fresh}/updates")) == ["batch_id=6", "batch_id=7", "batch_id=8"]


def _lines(spark, directory, name, text):
    os.makedirs(directory, exist_ok=True)
    with open(os.path.join(directory, name), "w") as f:
        f.write(text)
    return item_stream(spark, directory, "value", fmt="text")


def test_restart_with_the_same_checkpoint_keeps_its_state(spark, tmpdir_fresh):
    src, ckpt = f"{tmpdir_fresh}/in", f"{tmpdir_fresh}/ckpt"
    run_running_state(_lines(spark, src, "a.txt", "1\n2\nx\n"), FAM, checkpoint=ckpt)
    again = run_running_state(_lines(spark, src, "b.txt", "7\n"), FAM, checkpoint=ckpt)
    processed, freq, _, _ = again.tables()
    assert processed.first().processed == 4
    assert _rows(freq) == [(1, 1), (2, 1), (7, 1)]


def test_a_batch_without_log_row_is_not_counted(spark, tmpdir_fresh):
    from spindle.streaming.items import tables_from_cells

    sink = BoundedSink(spark, tmpdir_fresh, FAM, threshold=100)
    sink(spark.createDataFrame([("1",), ("2",)], "value STRING"), 0)
    cells = f"{tmpdir_fresh}/cells/batch_id="
    spark.read.parquet(cells + "0").write.parquet(cells + "1")  # died between cells and log
    again = BoundedSink(spark, tmpdir_fresh, FAM, threshold=100)
    assert again.total == 2
    assert tables_from_cells(again.state(spark))[0].first().processed == 2


def test_deadline_lets_the_running_batch_finish_and_takes_no_other(spark, tmpdir_fresh):
    src = f"{tmpdir_fresh}/in"
    for i in range(6):
        lines = _lines(spark, src, f"{i}.txt", "1\n2\n")
    lines = item_stream(spark, src, "value", fmt="text", max_files_per_trigger=1)
    run = run_bounded(lines, FAM, threshold=1000, timeout_s=0.0, out_dir=f"{tmpdir_fresh}/out")
    assert run.timed_out and run.sink.total in (2, 4)
    assert run.report(FAM, 5).summary.first().processed == run.sink.total
    end = run_bounded(lines, FAM, threshold=1000, timeout_s=60, out_dir=f"{tmpdir_fresh}/out", trigger={"availableNow": True})
    assert not end.timed_out and end.sink.total == 12
    assert end.report(FAM, 5).summary.first().processed == 12


def test_reports_release_what_they_persist(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    rs = run_running_state(item_stream(spark, SF001, "user_id", glob="events.parquet"), FAM)
    for _ in range(2):
        hh = rs.report(FAM, 5)
        hh.summary.collect()
        hh.release()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_items_without_batch_key_are_the_first_batch(spark):
    rows = [(None, "1"), (1, "2"), (2, "3"), (None, "4")]
    items = spark.createDataFrame(rows, "batch INT, value STRING").withColumn("item", F.col("value").cast("bigint"))
    for threshold, n in ((1, 2), (3, 3), (4, 4), (0, 0)):
        assert sk.bounded_items(items, threshold).count() == n
        assert sum(r["size"] for r in sk.batch_sizes(items, threshold).collect()) == n
