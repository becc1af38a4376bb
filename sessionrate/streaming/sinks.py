"""Sinks of the jobs: Kafka, log lines, no-op, text files, and fan-out.

Batch and streaming alike: every writer takes a DataFrame and either writes it (batch)
or starts a query (streaming).  Kafka writes go through Spark's ``kafka`` sink (needs
its connector on the class path): rows with ``key``, ``value`` (and optionally
``headers``) columns, at-least-once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionrate.session import scratch_path
from sessionrate.streaming.runner import start_fan_out, start_stream


def write_kafka(records: DataFrame, options: dict[str, str], checkpoint: str | None = None,
                available_now: bool = False):
    """Write ``key, value[, headers]`` rows to the topic named in ``options['topic']``.

    Batch: a plain write.  Stream: a started query (``checkpoint`` required).  The topic
    partition follows the key; the order within it is that of the writer tasks: for one
    writer per session, in window order, pass metrics through
    :func:`sessionrate.operators.metrics.in_session_order` first (streams: in a fan-out).
    """
    cols = [c for c in ("key", "value", "headers") if c in records.columns]
    out = records.select(*cols)
    if not records.isStreaming:
        out.write.format("kafka").options(**options).save()
        return None
    return start_stream(out, sink="kafka", options=options, checkpoint=checkpoint,
                        available_now=available_now)


def echo(df: DataFrame, prefix: str = "") -> DataFrame:
    """Each row as one log line ``prefix + JSON`` (pass-through of the row content)."""
    return df.select(F.concat(F.lit(prefix), F.to_json(F.struct(*df.columns))).alias("value"))


def _print_lines(rows) -> None:
    for row in rows:
        print(row[0], flush=True)


def batch_folder(path: str, batch_id: int, run: str | None = None) -> str:
    """The folder of one micro-batch below ``path``; ``run`` names the query (its checkpoint), so
    that a query started over does not replace another one's batches."""
    own = f"/run={hashlib.sha256(run.encode()).hexdigest()[:12]}" if run else ""
    return f"{path.rstrip('/')}{own}/batch_id={int(batch_id)}"


def write_batch(df: DataFrame, path: str, batch_id: int, run: str | None = None, fmt: str = "parquet") -> None:
    """Write a micro-batch into its own folder, replacing what an earlier attempt left there: a
    batch that is given again after a failure is not written twice."""
    df.write.mode("overwrite").format(fmt).save(batch_folder(path, batch_id, run))


def batch_writer(path: str, run: str | None = None, fmt: str = "parquet"):
    """:func:`write_batch` as a writer ``fn(batch_df, batch_id)`` for fan-outs."""
    return lambda batch, batch_id: write_batch(batch, path, batch_id, run, fmt)


def log_lines(df: DataFrame, prefix: str = "", path: str | None = None, batch_id: int | None = None,
              run: str | None = None) -> None:
    """Log every row of a batch as one line: to text files below ``path``, else to the
    standard output of the executors' tasks.  All rows, none through the driver.

    With ``batch_id`` (in a fan-out) the files are those of the batch and replaced when it is
    given again; without, they are added.  Lines on standard output are printed again."""
    lines = echo(df, prefix)
    if path and batch_id is not None:
        write_batch(lines, path, batch_id, run, "text")
    elif path:
        lines.write.mode("append").text(path)
    else:
        lines.foreachPartition(_print_lines)


def to_log(df: DataFrame, prefix: str = "", path: str | None = None, checkpoint: str | None = None,
           available_now: bool = False) -> StreamingQuery | None:
    """:func:`log_lines` for batch and stream; a stream into ``path`` needs a ``checkpoint``."""
    if not df.isStreaming:
        log_lines(df, prefix, path)
        return None
    if path:
        return write_text(echo(df, prefix), path, checkpoint, available_now)
    return start_fan_out(df, [lambda b, i: log_lines(b, prefix)],
                         checkpoint=checkpoint or scratch_path(df.sparkSession, "log-ckpt"),
                         available_now=available_now)


def to_noop(df: DataFrame, checkpoint: str | None = None) -> StreamingQuery | None:
    """Compute everything, keep nothing (the jobs' default sink)."""
    if not df.isStreaming:
        df.write.format("noop").mode("overwrite").save()
        return None
    return start_stream(df, sink="noop", checkpoint=checkpoint)


def write_text(lines: DataFrame, path: str, checkpoint: str | None = None,
               available_now: bool = False) -> StreamingQuery | None:
    """One text line per row of the single string column ``value`` (e.g. the output of
    ``rates.windowed_group_text``)."""
    if not lines.isStreaming:
        lines.select("value").write.mode("append").text(path)
        return None
    return start_stream(lines.select("value"), sink="text", path=path, checkpoint=checkpoint,
                        available_now=available_now)


def fan_out(df: DataFrame, sinks: list, checkpoint: str | None = None,
            available_now: bool = False) -> StreamingQuery | None:
    """Hand one result to several batch writers ``fn(batch_df, batch_id)``.

    Streaming: one query, each micro-batch persisted once and given to every writer.  After a
    failure a batch is given again with its id to all of them, so each must replace what it
    wrote for that id (:func:`batch_writer`) or, as Kafka, be read by keys that tell repeats:
    a metric is unique per session and window, which its headers hold.
    Batch: the result is persisted once and given to every writer with id 0.
    """
    if df.isStreaming:
        return start_fan_out(df, sinks, checkpoint=checkpoint, available_now=available_now)
    df.persist()
    try:
        for write in sinks:
            write(df, 0)
    finally:
        df.unpersist()
    return None


def run_for(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Let a started query run for ``seconds``, then stop it (a bounded run)."""
    if not query.awaitTermination(seconds):
        query.stop()
    return query
