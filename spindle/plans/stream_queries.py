"""Registered streaming queries: the ``events`` file replayed through Structured Streaming.

Each query runs a fresh stateful stream (``availableNow``) over ``<sf_dir>/events.parquet`` with its own
checkpoint and output folder under ``spark.checkpoint.dir``, then returns the final relation.  The oracle is the
batch SQL over the same lines, since a stream must end in the batch answer.  Two queries read the events as one file
per day and take one file per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spindle.plans import oracle as orc
from spindle.session import work_path
from spindle.streaming.items import item_stream, run_bounded, run_running_state, state_partitions

COMPACT_EVERY = 10  # below the number of days, so snapshots are written and read


def _state(spark, sf):
    from spindle.plans.catalog import FAM

    lines = item_stream(spark, sf, "user_id", glob="events.parquet")
    return run_running_state(lines, FAM)


def q_stream_item_frequency(spark, sf):
    _, freq, _, _ = _state(spark, sf).tables()
    return freq


def q_stream_count_min(spark, sf):
    _, _, cm, _ = _state(spark, sf).tables()
    return cm


def q_stream_count_sketch(spark, sf):
    _, _, _, cs = _state(spark, sf).tables()
    return cs


def q_stream_hh_report(spark, sf):
    from spindle.plans.catalog import FAM, HH_K, rnd

    rep = _state(spark, sf).report(FAM, HH_K).report
    return rep.select("item", "n", "est_cm", "est_cs", rnd("err_cm"), rnd("err_cs"))


def q_stream_hh_summary(spark, sf):
    from spindle.plans.catalog import FAM, HH_K, rnd

    s = _state(spark, sf).report(FAM, HH_K).summary
    return s.select("processed", "n_distinct", "n_top", rnd("avg_err_cm"), rnd("avg_err_cs"))


def day_files(spark, sf):
    """The folder of the user ids of ``events`` with one file per day, in the order of the days.

    The file source takes files by modification time, which is set to that order; events without a day come first.
    """
    path = work_path(spark, "event-days")
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.to_date("ts").alias("day"))
    events.repartition("day").write.partitionBy("day").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [d.getPath() for d in fs.listStatus(hadoop) if d.isDirectory()]
    days.sort(key=lambda p: ("HIVE_DEFAULT" not in p.getName(), p.getName()))
    for i, day in enumerate(days):
        for file in fs.listStatus(day):
            fs.setTimes(file.getPath(), 1000 * (i + 1), -1)
    return path


def day_stream(spark, path):
    """The user ids of ``day_files`` as a stream with one file, so one day, per micro-batch."""
    return item_stream(spark, path, "user_id", max_files_per_trigger=1)


def q_bounded_stream_run(spark, sf):
    """The log of a bounded run over the day stream: the batches taken before the threshold."""
    from spindle.plans.catalog import FAM, STREAM_T

    run = run_bounded(day_stream(spark, day_files(spark, sf)), FAM, STREAM_T, timeout_s=600, trigger={"availableNow": True})
    return run.sink.log(spark).select("batch_id", "size", "before")


def q_stream_hh_summary_batches(spark, sf):
    from spindle.plans.catalog import FAM, HH_K, rnd

    path = day_files(spark, sf)
    rs = run_running_state(day_stream(spark, path), FAM, compact_every=COMPACT_EVERY, partitions=state_partitions(spark, path))
    s = rs.report(FAM, HH_K).summary
    return s.select("processed", "n_distinct", "n_top", rnd("avg_err_cm"), rnd("avg_err_cs"))


def registry():
    from spindle.plans.catalog import FAM, HH_K, STREAM_T, Entry

    return {
        "stream_item_frequency": Entry(q_stream_item_frequency, orc.item_frequency("events")),
        "stream_count_min": Entry(q_stream_count_min, orc.count_min_cells("events", FAM)),
        "stream_count_sketch": Entry(q_stream_count_sketch, orc.count_sketch_cells("events", FAM)),
        "stream_hh_report": Entry(q_stream_hh_report, orc.hh_error_report("events", FAM, HH_K)),
        "stream_hh_summary": Entry(q_stream_hh_summary, orc.hh_summary("events", FAM, HH_K)),
        "bounded_stream_run": Entry(q_bounded_stream_run, orc.bounded_stream_run("events", STREAM_T)),
        "stream_hh_summary_batches": Entry(q_stream_hh_summary_batches, orc.hh_summary("events", FAM, HH_K)),
    }


__all__ = ["registry"]
