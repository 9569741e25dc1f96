"""Start streaming queries, run them over what is available, report progress."""

from __future__ import annotations

import contextlib
import json
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from spindrift.session import new_dir
from spindrift.sources.tables import Tables


@contextlib.contextmanager
def state_partitions(spark: SparkSession):
    """Number of state partitions for queries started inside.

    A stateful query fixes its partitions at its first start and adaptive execution does
    not merge them, so more than two per core only add tasks and state files. A lower
    setting of the session is kept.
    """
    key = "spark.sql.shuffle.partitions"
    given = spark.conf.get(key)
    spark.conf.set(key, str(min(int(given), 2 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, given)


def table_stream(tables: Tables, name: str, max_files: int | None = None) -> DataFrame:
    """A table as a stream of its files, with the table's schema."""
    return file_stream(tables.spark, tables.stream_path(name), getattr(tables, name), max_files)


def file_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.schema(like.schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def event_time(df: DataFrame, col: str, delay: str) -> DataFrame:
    """Watermark; times without zone are read as session time first, since watermarks need an instant."""
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        df = df.withColumn(col, df[col].cast("timestamp"))
    return df.withWatermark(col, delay)


def start(df: DataFrame, path: str, checkpoint: str, *, mode: str = "append", fmt: str = "parquet",
          trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Start a query into files (or any path-based sink)."""
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    with state_partitions(df.sparkSession):
        return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def run_available(df: DataFrame, label: str, *, mode: str = "append",
                  on_batch: Callable[[DataFrame, int], None] | None = None,
                  checkpoint: str | None = None, out: str | None = None, log: str | None = None) -> tuple[str, StreamingQuery]:
    """Process all available input and stop; returns the output folder and the finished query. ``log`` is a folder for ``progress``."""
    spark = df.sparkSession
    out = out or new_dir(spark, label)
    checkpoint = checkpoint or new_dir(spark, f"{label}-checkpoint")
    if log is not None:
        with progress_log(spark, log) as name:
            return _run(df, mode, on_batch, checkpoint, out, name)
    return _run(df, mode, on_batch, checkpoint, out)


def _run(df: DataFrame, mode: str, on_batch, checkpoint: str, out: str, name: str | None = None) -> tuple[str, StreamingQuery]:
    spark = df.sparkSession
    if on_batch is None and mode == "append":
        query = start(df, out, checkpoint, name=name)
    else:
        def replace(batch: DataFrame, batch_id: int) -> None:
            # complete mode: each batch is the whole result
            batch.write.mode("overwrite").parquet(out)

        writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        writer = writer.queryName(name) if name else writer
        with state_partitions(spark):
            query = writer.foreachBatch(on_batch or replace).start()
    query.awaitTermination()
    return out, query


def result_of(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """The finished output of a stream as a batch frame."""
    out, _ = run_available(df, label, mode=mode)
    plain = df.sparkSession.read.schema(df.schema)
    return plain.parquet(out)


PROGRESS = "run_id string, batch_id bigint, input_rows bigint, state_rows bigint, dropped_rows bigint, duration_ms bigint"


class ProgressLog(StreamingQueryListener):
    """Appends a record of every micro-batch of the queries of one name to files in a folder, ``keep`` records a file.

    Spark's own list of recent progress ends at its last hundred entries; this one holds all batches of a job of any length, and the driver at most
    ``keep`` of them.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, keep: int = 500):
        self.spark, self.name, self.folder, self.keep = spark, name, folder, keep
        self.lines: list[str] = []
        self.runs: set[str] = set()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name:
            return
        state = p.stateOperators or []
        self.lines.append(json.dumps({
            "run_id": str(p.runId), "batch_id": p.batchId, "input_rows": p.numInputRows, "state_rows": sum(s.numRowsTotal for s in state),
            "dropped_rows": sum(s.numRowsDroppedByWatermark for s in state), "duration_ms": int((p.durationMs or {}).get("triggerExecution", 0)),
        }))
        if len(self.lines) >= self.keep:
            self._flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self.runs:
            self._flush()
            self.ended.set()

    def _flush(self) -> None:
        if self.lines:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{uuid.uuid4().hex}.json")
            out = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where)
            out.write(bytearray("\n".join(self.lines).encode()))
            out.close()
            self.lines = []


@contextlib.contextmanager
def progress_log(spark: SparkSession, folder: str, wait_seconds: int = 60):
    """The name to give to a query whose batches are to be logged; its records are complete when the block is left."""
    log = ProgressLog(spark, f"logged-{uuid.uuid4().hex[:8]}", folder)
    spark.streams.addListener(log)
    try:
        yield log.name
        if log.runs and not log.ended.wait(wait_seconds):
            raise TimeoutError("the stream's last events did not arrive")
    finally:
        spark.streams.removeListener(log)


def progress(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, state rows, rows dropped by the watermark and duration of each logged micro-batch.

    A trigger without a new batch reports the last one again, so of equal batches of a run the largest figures count.
    """
    rows = spark.read.schema(PROGRESS).json(folder)
    return rows.groupBy("run_id", "batch_id").agg(*[F.max(c).alias(c) for c in ("input_rows", "state_rows", "dropped_rows", "duration_ms")]).drop("run_id")
