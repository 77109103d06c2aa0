"""Structured Streaming over item lines: running histogram, Count-Min and Count-Sketch, bounded consumption.

Running state.  Each line becomes a few tagged cells ``(tag, a, b, v)``:

* ``(TAG_P, 0, 0, 1)``            processed lines, parsed or not;
* ``(TAG_F, item, 0, 1)``         exact histogram;
* ``(TAG_CM, row, col, 1)`` x D   Count-Min;
* ``(TAG_CS, row, col, ±1)`` x D  Count-Sketch;

and one stateful ``groupBy(tag, a, b).sum(v)`` keeps them all, so a single query and a single state store serve
every relation.  Sketch state is bounded by 2*D*W keys; the histogram state grows with the distinct items, as the
exact answer must (the state store spills to RocksDB when configured).  Updated keys are written by
``foreachBatch`` to ``<out>/updates/batch_id=<n>`` with overwrite, so a replayed batch rewrites the same folder;
every N batches a snapshot of the full state is written too, and readers take, per key, the value of the latest
batch among the newest snapshot and the update folders after it.

Bounded consumption.  A batch is taken whole iff the lines of earlier batches number fewer than T; later batches
are ignored and the caller stops the query.  The sink writes each taken batch's partial cells and a log row
``(batch_id, size, before)``, both keyed by batch id, so replays are idempotent and a restarted driver recovers
the running total from the log.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from spindle.functions.hashing import HashFamily
from spindle.functions.text import parse_item
from spindle.operators.sketch import (
    CELL_SCHEMA,
    TAG_P,
    HeavyHitters,
    hh_from_tables,
    tables_from_cells,
    tagged_cells,
)
from spindle.session import work_path

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
STATE_BYTES = 2 << 20  # of a replay's files for each partition of its state


def item_stream(
    spark: SparkSession,
    directory: str,
    value: Column | str,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    schema=None,
) -> DataFrame:
    """A streaming ``(value STRING)`` relation from a file directory (tests) -- any streaming DataFrame with a
    ``value`` column (Kafka, socket) can be used instead."""
    reader = spark.readStream.format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if schema is None and fmt != "text":
        batch = spark.read.format(fmt)
        if glob:
            batch = batch.option("pathGlobFilter", glob)
        schema = batch.load(directory).schema
    if schema is not None:
        reader = reader.schema(schema)
    v = F.col(value) if isinstance(value, str) else value
    return reader.load(directory).select(v.cast("string").alias("value"))


def cells(lines: DataFrame, fam: HashFamily) -> DataFrame:
    """``(tag, a, b, v)`` contributions of every line (see :func:`spindle.operators.sketch.tagged_cells`)."""
    return tagged_cells(lines.select(parse_item(F.col("value")).alias("item")), fam)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def _partition_ids(spark: SparkSession, path: str, key: str) -> list[int]:
    """Values of ``key=<n>`` sub-folders of ``path`` (a listing, no data read)."""
    if not _exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{key}="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _complete(spark: SparkSession, path: str, key: str) -> list[int]:
    """Values of the ``key=<n>`` folders that their writer finished: Spark's own marker is written after the commit, so
    a folder left by a crash, or one still being written, does not count."""
    return [i for i in _partition_ids(spark, path, key) if _exists(spark, f"{path}/{key}={i}/_SUCCESS")]


def _write(df: DataFrame, path: str) -> None:
    marked = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    marked.parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def _read(spark: SparkSession, base: str, key: str, ids: list[int], schema: str) -> DataFrame | None:
    """Exactly these folders, by explicit path: nothing else under ``base`` is listed or read."""
    if not ids:
        return None
    reader = spark.read.schema(f"{schema}, {key} BIGINT").option("basePath", base)
    return reader.parquet(*[f"{base}/{key}={i}" for i in ids])


def _latest(spark: SparkSession, out_dir: str, upto: int | None = None) -> DataFrame:
    """Latest value per state key: the newest complete snapshot plus only the complete updates written after it."""
    within = lambda i: upto is None or i <= upto
    snaps = [i for i in _complete(spark, f"{out_dir}/snapshots", "snap_id") if within(i)][-1:]
    base = snaps[0] if snaps else -1
    updates = [i for i in _complete(spark, f"{out_dir}/updates", "batch_id") if within(i) and i > base]
    snap = _read(spark, f"{out_dir}/snapshots", "snap_id", snaps, CELL_SCHEMA)
    upd = _read(spark, f"{out_dir}/updates", "batch_id", updates, CELL_SCHEMA)
    parts = [p for p in (snap and snap.withColumnRenamed("snap_id", "batch_id"), upd) if p is not None]
    if not parts:
        return spark.createDataFrame([], CELL_SCHEMA)
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return df.groupBy("tag", "a", "b").agg(F.max_by("v", "batch_id").alias("v"))


class _UpsertSink:
    """foreachBatch: write the batch's updated keys under ``updates/batch_id=<id>`` (overwrite: idempotent on
    replay); every ``compact_every`` batches also write the full latest state as ``snapshots/snap_id=<id>``, so
    readers never scan more than ``compact_every`` update folders.  What the snapshot *before* a complete one already
    covers is deleted then: a reader that started on the older snapshot still finds its files."""

    def __init__(self, out_dir: str, compact_every: int = 50):
        self.out_dir = out_dir
        self.compact_every = compact_every

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        _write(batch_df, f"{self.out_dir}/updates/batch_id={batch_id}")
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            spark = batch_df.sparkSession
            _write(_latest(spark, self.out_dir, upto=batch_id), f"{self.out_dir}/snapshots/snap_id={batch_id}")
            older = [i for i in _complete(spark, f"{self.out_dir}/snapshots", "snap_id") if i < batch_id]
            if older:
                for kind, key in (("updates", "batch_id"), ("snapshots", "snap_id")):
                    for i in _partition_ids(spark, f"{self.out_dir}/{kind}", key):
                        if i < older[-1] or (kind == "updates" and i == older[-1]):
                            _delete(spark, f"{self.out_dir}/{kind}/{key}={i}")


def _folders(spark: SparkSession, kind: str, out_dir: str | None, checkpoint: str | None) -> tuple[str, str]:
    """Output and checkpoint folder.  Each, where it is not given, follows from the other, so a restart with either
    finds both; with neither, both are new."""
    if out_dir is None and checkpoint is None:
        out_dir = work_path(spark, kind)
    if out_dir is None:
        out_dir = checkpoint.rstrip("/") + "-out"
    return out_dir, checkpoint or out_dir.rstrip("/") + "-ckpt"


@dataclass
class RunningState:
    query: StreamingQuery
    out_dir: str
    spark: SparkSession
    held: list[DataFrame] = field(default_factory=list, repr=False)  # states handed out, persisted until release()

    def state(self) -> DataFrame:
        """The latest value of every state key, persisted: each relation of a report reads it.  ``release`` ends that."""
        self.held.append(_latest(self.spark, self.out_dir).persist(StorageLevel.MEMORY_AND_DISK))
        return self.held[-1]

    def tables(self):
        """The histogram and sketch relations, over a state that ``release`` frees."""
        return tables_from_cells(self.state())

    def release(self) -> None:
        """Unpersists every state this object has handed out; relations over them are read anew from the sink."""
        while self.held:
            self.held.pop().unpersist()

    def report(self, fam: HashFamily, k: int) -> HeavyHitters:
        state = self.state()
        hh = hh_from_tables(*tables_from_cells(state), fam, k)
        hh.state = state  # for release()
        return hh


@contextmanager
def _shuffle_partitions(spark: SparkSession, partitions: int | None):
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    if partitions:
        spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)


def state_partitions(spark: SparkSession, path: str) -> int:
    """State partitions for a replay of the files under ``path``: one for each core, more where a partition would have
    more than ``STATE_BYTES`` of them, never more than the session's shuffle partitions."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    least = max(spark.sparkContext.defaultParallelism, -(-fs.getContentSummary(jpath).getLength() // STATE_BYTES))
    return min(least, int(spark.conf.get(SHUFFLE_PARTITIONS)))


def start_running_state(
    lines: DataFrame,
    fam: HashFamily,
    out_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    compact_every: int = 50,
    partitions: int | None = None,
) -> RunningState:
    """Start the stateful query; ``trigger`` defaults to ``{"availableNow": True}``, use
    ``{"processingTime": "100 milliseconds"}`` for an unbounded source.

    Every micro-batch commits every partition of the state, whatever its own size: ``partitions`` is their number, where
    the session's number of shuffle partitions is not to be it.  A restart keeps the number it was started with."""
    spark = lines.sparkSession
    out_dir, checkpoint = _folders(spark, "stream-state", out_dir, checkpoint)
    agg = cells(lines, fam).groupBy("tag", "a", "b").agg(F.sum("v").cast("bigint").alias("v"))
    writer = agg.writeStream.outputMode("update").foreachBatch(_UpsertSink(out_dir, compact_every)).option(
        "checkpointLocation", checkpoint
    )
    if name:
        writer = writer.queryName(name)
    with _shuffle_partitions(spark, partitions):  # the query runs in a copy of the session, taken at its start
        q = writer.trigger(**(trigger or {"availableNow": True})).start()
    return RunningState(q, out_dir, spark)


def run_running_state(lines: DataFrame, fam: HashFamily, **kw) -> RunningState:
    """Run to the end of the available input and return the state handle."""
    rs = start_running_state(lines, fam, **kw)
    rs.query.awaitTermination()
    return rs


# ---------------------------------------------------------------------------------------------------------------
# Bounded consumption
# ---------------------------------------------------------------------------------------------------------------


class BoundedSink:
    """foreachBatch sink applying the stop rule; writes partial cells and a batch log under ``out_dir``.

    A batch counts once its log row is complete, which is written after its cells; :meth:`state` reads no other.
    """

    def __init__(self, spark: SparkSession, out_dir: str, fam: HashFamily, threshold: int):
        self.out_dir = out_dir
        self.fam = fam
        self.threshold = threshold
        self.begun = False  # the query called the sink for the first time
        self.changed = threading.Condition()  # notified when the first batch arrives and when a batch is done
        self._lock = threading.Lock()
        self._closed = False
        # Lines of all taken batches, and the last one (the only one that can come again).
        self.total, self._last, self._last_before = 0, -1, 0
        ids = self._taken(spark)
        if ids:  # restarted driver: recover the running total
            log = self.log(spark)
            self.total = log.agg(F.sum("size")).first()[0]
            self._last = ids[-1]
            self._last_before = log.where(F.col("batch_id") == self._last).first()["before"]

    def _taken(self, spark: SparkSession) -> list[int]:
        return _complete(spark, f"{self.out_dir}/log", "batch_id")

    def before(self, batch_id: int) -> int:
        """Lines taken by the batches before this one, which is a new batch or the last one again."""
        return self._last_before if batch_id <= self._last else self.total

    def close(self) -> None:
        """Refuse further batches; returns when the one being written is done."""
        with self._lock:
            self._closed = True

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        self._notify()
        with self._lock:
            if self._closed:  # the batch stays uncommitted, so a restart takes it
                raise RuntimeError("the bounded run was closed")
            self._write(batch_df, batch_id)
        self._notify()

    def _notify(self) -> None:
        with self.changed:
            self.begun = True
            self.changed.notify_all()

    def _write(self, batch_df: DataFrame, batch_id: int) -> None:
        before = self.before(batch_id)
        if before >= self.threshold:
            return
        # One pass over the batch: its partial cells (at most distinct items + 2*D*W rows) carry the batch size in
        # the processed tag, so no separate count is needed.
        part = cells(batch_df, self.fam).groupBy("tag", "a", "b").agg(F.sum("v").cast("bigint").alias("v"))
        path = f"{self.out_dir}/cells/batch_id={batch_id}"
        _write(part, path)
        spark = batch_df.sparkSession
        written = spark.read.schema(CELL_SCHEMA).parquet(path)
        size = int(written.where(F.col("tag") == TAG_P).agg(F.coalesce(F.sum("v"), F.lit(0))).first()[0])
        row = spark.range(1).select(F.lit(size).cast("bigint").alias("size"), F.lit(before).cast("bigint").alias("before"))
        _write(row, f"{self.out_dir}/log/batch_id={batch_id}")
        self.total, self._last, self._last_before = before + size, batch_id, before

    def state(self, spark: SparkSession) -> DataFrame:
        df = _read(spark, f"{self.out_dir}/cells", "batch_id", self._taken(spark), CELL_SCHEMA)
        if df is None:
            return spark.createDataFrame([], CELL_SCHEMA)
        return df.groupBy("tag", "a", "b").agg(F.sum("v").cast("bigint").alias("v"))

    def log(self, spark: SparkSession) -> DataFrame:
        df = _read(spark, f"{self.out_dir}/log", "batch_id", self._taken(spark), "size BIGINT, before BIGINT")
        if df is None:
            return spark.createDataFrame([], "batch_id BIGINT, size BIGINT, before BIGINT")
        return df.select("batch_id", "size", "before")


class _Progress(StreamingQueryListener):
    """Which queries have begun (a batch made progress, or they wait for data) and which have ended, by run id."""

    def __init__(self, changed: threading.Condition):
        self.changed = changed
        self.begun: set[str] = set()
        self.ended: set[str] = set()

    def _add(self, to: set[str], run_id) -> None:
        with self.changed:
            to.add(str(run_id))
            self.changed.notify_all()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(self.begun, event.progress.runId)

    def onQueryIdle(self, event) -> None:
        self._add(self.begun, event.runId)

    def onQueryTerminated(self, event) -> None:
        self._add(self.ended, event.runId)


@dataclass
class BoundedRun:
    query: StreamingQuery
    sink: BoundedSink
    spark: SparkSession
    reached: bool
    timed_out: bool

    def report(self, fam: HashFamily, k: int) -> HeavyHitters:
        state = self.sink.state(self.spark).persist(StorageLevel.MEMORY_AND_DISK)
        hh = hh_from_tables(*tables_from_cells(state), fam, k)
        hh.state = state  # for release()
        return hh


def run_bounded(
    lines: DataFrame,
    fam: HashFamily,
    threshold: int,
    timeout_s: float = 60.0,
    out_dir: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> BoundedRun:
    """Consume ``lines`` until T lines were taken (at a batch boundary), the input ends, or the timeout passes.

    The clock starts once the query is initialised (its first batch reaches the sink, or it waits for data).  At the
    deadline a batch that is being written is finished, and no other is taken.  Nothing is polled: the sink and a
    listener on the query's progress, idle and end events wake the caller.
    """
    spark = lines.sparkSession
    out_dir, checkpoint = _folders(spark, "bounded", out_dir, checkpoint)
    sink = BoundedSink(spark, out_dir, fam, threshold)
    events = _Progress(sink.changed)
    spark.streams.addListener(events)
    try:
        q = (
            lines.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "100 milliseconds"}))
            .start()
        )
        run_id = str(q.runId)
        with sink.changed:
            sink.changed.wait_for(lambda: sink.begun or run_id in events.begun | events.ended or sink.total >= threshold)
            done = sink.changed.wait_for(lambda: run_id in events.ended or sink.total >= threshold, timeout_s)
        timed_out = not done
    finally:
        spark.streams.removeListener(events)
    sink.close()
    timed_out = timed_out and sink.total < threshold
    q.stop()
    return BoundedRun(q, sink, spark, sink.total >= threshold, timed_out)
