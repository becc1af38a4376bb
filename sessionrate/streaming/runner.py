"""Structured Streaming wiring: file/Kafka streams, watermarks, sinks, runs.

Event time is the record timestamp (``event_time``).  The watermark is
``max(event_time) - delay``; with ``delay = 0`` a window ``[s, e)`` is emitted once a
row with time >= ``e`` has been seen, and a late row is dropped for every window that
had already been closed by the previous micro-batch's watermark.  The maximum is over
all source partitions, so the delay must cover how far one may lag behind another.

A query that keeps its result needs a ``checkpoint``: a folder of its own on shared
storage that stays the same from start to start.  A restarted query goes on from its last
committed batch (file sinks exactly-once, the Kafka sink at-least-once); with a new
folder it would start over.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from sessionrate.session import ensure_state_store, scratch_path

#: sinks that keep nothing: these may run without a checkpoint of their own
EPHEMERAL_SINKS = ("memory", "console", "noop")


def parquet_file_stream(spark: SparkSession, folder: str, file_glob: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files matching ``file_glob`` in ``folder`` (schema read once)."""
    folder = folder.rstrip("/")
    sample = spark.read.option("pathGlobFilter", file_glob).parquet(folder)
    reader = spark.readStream.schema(sample.schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def _checkpoint(spark: SparkSession, checkpoint: str | None, ephemeral: bool) -> str:
    if checkpoint:
        return checkpoint
    if not ephemeral:
        raise ValueError("name a checkpoint folder: the query resumes from it after a restart")
    return scratch_path(spark, "ckpt")


def start_stream(df: DataFrame, sink: str = "console", output_mode: str = "append",
                 checkpoint: str | None = None, path: str | None = None,
                 options: dict | None = None, query_name: str | None = None,
                 available_now: bool = False, processing_time: str | None = None
                 ) -> StreamingQuery:
    """Start ``df`` into one sink: console, noop, memory, parquet, json, text, kafka.

    ``checkpoint`` is required for sinks that keep the result."""
    ensure_state_store(df.sparkSession)
    w = df.writeStream.outputMode(output_mode).format(sink)
    w = w.option("checkpointLocation", _checkpoint(df.sparkSession, checkpoint, sink in EPHEMERAL_SINKS))
    if path:
        w = w.option("path", path)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def start_fan_out(df: DataFrame, writers: list, checkpoint: str, output_mode: str = "append",
                  available_now: bool = False) -> StreamingQuery:
    """One stream, several sinks: each micro-batch is computed once (persisted) and
    handed to every ``writer(batch_df, batch_id)``; a second ``start()`` would re-run
    the whole query per sink.  After a failure a batch is given again with its id."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    ensure_state_store(df.sparkSession)
    w = (df.writeStream.outputMode(output_mode).foreachBatch(each)
           .option("checkpointLocation", _checkpoint(df.sparkSession, checkpoint, False)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


class LateRows(StreamingQueryListener):
    """Counts the rows each query's watermark drops as late, over its whole run.

    (A query's ``recentProgress`` only holds its last batches.)  :meth:`total` counts what the
    windowed operators drop, i.e. (row, window) pairs after partial aggregation;
    :meth:`records` counts source records, in queries made by
    :func:`sessionrate.streaming.watermarks.with_late_records`.

        late = LateRows.attach(spark)
        ...
        late.total(query), late.records(query)
    """

    #: Spark's name of the state operator that ``with_late_records`` adds
    RECORDS = "dedupe"

    def __init__(self):
        self._lock, self._totals, self._records, self._ended = threading.Lock(), {}, {}, {}

    @classmethod
    def attach(cls, spark: SparkSession) -> "LateRows":
        listener = cls()
        spark.streams.addListener(listener)
        return listener

    def _end(self, run_id) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event):  # noqa: N802 - Spark's name
        pass

    def onQueryProgress(self, event):  # noqa: N802
        run = str(event.progress.runId)
        with self._lock:
            for op in event.progress.stateOperators:
                counts = self._records if op.operatorName == self.RECORDS else self._totals
                counts[run] = counts.get(run, 0) + int(op.numRowsDroppedByWatermark or 0)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self._end(event.runId).set()

    def total(self, query: StreamingQuery, timeout: float = 30.0) -> int:
        """Rows dropped so far; for an ended query, when all its events have arrived."""
        return self._read(self._totals, query, timeout)

    def records(self, query: StreamingQuery, timeout: float = 30.0) -> int:
        """Records so far that came after the last of their windows had closed."""
        return self._read(self._records, query, timeout)

    def _read(self, counts: dict, query: StreamingQuery, timeout: float) -> int:
        if not query.isActive:
            self._end(query.runId).wait(timeout)
        with self._lock:
            return counts.get(str(query.runId), 0)


def run_to_parquet(df: DataFrame, name: str, output_mode: str = "append") -> str:
    """Run a stream over everything available now into a parquet folder; return it.

    A single bounded run: folder and checkpoint are new ones in the shared checkpoint
    folder, so the result survives executor loss and can be read back as a batch table.
    """
    spark = df.sparkSession
    out = scratch_path(spark, f"{name}-out")
    q = start_stream(df, sink="parquet", output_mode=output_mode,
                     checkpoint=scratch_path(spark, f"{name}-ckpt"), path=out,
                     available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out
