"""Job entry points wired to Kafka: source -> job -> sinks, as a deployment runs them.

Each returns the started :class:`StreamingQuery` handle (``awaitTermination()`` to block
like a synchronous run, or keep the handle like an asynchronous one).  The jobs
themselves are the DataFrame functions in :mod:`sessionrate.plans.jobs`.

Every start needs a ``checkpoint``: a folder of the job's own on shared storage, the same
at every start.  It holds the offsets read and the open windows, so a restarted job goes
on where it stopped (on the first start, at the source's ``startingOffsets``).  Every
windowed job needs a ``watermark``: how late a record may be.  Given the topic's
``partitions``, it counts from the slowest of them, and ``idle`` (of event time) releases those
without records; else it counts from the newest record of all and must cover the lag
between partitions (``"0 seconds"`` then only suits a single ordered one).

Log files are kept per micro-batch and replaced when one is given again after a failure.

Records that parsing or the feedback checks reject are not in any job's result;
:func:`start_rejects` and :func:`start_feedback_rejects` route them to a topic or folder.

The Kafka parts need Spark's connector on the class path; the container these were built
in has none, so the tests pass ``records`` (any stream of Kafka-shaped records) and
writers instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionrate.functions.predicates import is_blank_text
from sessionrate.operators import metrics as M
from sessionrate.operators import rates as R
from sessionrate.plans import jobs as J
from sessionrate.session import ensure_utc
from sessionrate.sources import kafka as K
from sessionrate.streaming import sinks
from sessionrate.streaming.watermarks import read_partitions, with_late_records


def _records(spark: SparkSession, source: dict | None, records: DataFrame | None,
             headers: bool = False) -> DataFrame:
    ensure_utc(spark)
    if records is not None:
        return records
    return K.read_kafka(spark, source or K.kafka_options(), include_headers=headers)


def _events(spark: SparkSession, source: dict | None, records: DataFrame | None, watermark: str,
            partitions: list[int] | None, idle: str | None) -> DataFrame:
    """Parsed events under their watermark: of the whole stream, or of its slowest partition."""
    if partitions and records is None:
        ensure_utc(spark)
        branches = read_partitions(spark, source or K.kafka_options(), partitions)
        return J.decoded_events(branches, watermark=watermark, idle=idle)
    return J.decoded_events(_records(spark, source, records), watermark=watermark, partitions=partitions, idle=idle)


def _sink_options(sink: dict | None, topic: str | None, default_topic: str) -> dict:
    """Writer options: those given, on top of the default brokers and topic."""
    out = K.kafka_options(topic=default_topic, for_writer=True)
    out.update(sink or {})
    if topic:
        out["topic"] = topic
    return out


def _log_writer(log: bool, log_path: str | None, checkpoint: str, prefix: str = "") -> list:
    if not log and not log_path:
        return []
    return [lambda b, i: sinks.log_lines(b, prefix, log_path, batch_id=i, run=checkpoint)]


def _start(df: DataFrame, writers: list, checkpoint: str, available_now: bool) -> StreamingQuery:
    """One query for all writers; computed and discarded where there is none."""
    discard = [lambda b, i: b.write.format("noop").mode("overwrite").save()]
    return sinks.fan_out(df, writers or discard, checkpoint=checkpoint, available_now=available_now)


def start_kill_rate(spark: SparkSession, checkpoint: str, watermark: str, source: dict | None = None,
                    sink_topic: str | None = None, sink: dict | None = None,
                    event_type: str = "killed", actor_type: str = "player",
                    log: bool = True, log_path: str | None = None,
                    records: DataFrame | None = None, extra_writers: list | None = None,
                    available_now: bool = False, partitions: list[int] | None = None,
                    idle: str | None = None, count_late: bool = False) -> StreamingQuery:
    """Metrics of ``event_type`` per second per player session, every one logged and, when
    ``sink_topic`` is not blank or ``sink`` is given, written to that topic with one writer
    per session in window order (one query, fanned out).

    ``records`` replaces the Kafka source with any stream of Kafka-shaped records;
    ``extra_writers`` (``fn(batch_df, batch_id)``) receive every metric batch too.  With
    ``count_late`` the query's late records are counted (``LateRows.records``).
    """
    events = _events(spark, source, records, watermark, partitions, idle)
    metrics = J.kill_rate_job(None, event_type=event_type, actor_type=actor_type, events=events)
    if count_late:
        metrics = with_late_records(metrics, events, R.KILL_WINDOW_MS, R.KILL_SLIDE_MS)
    writers = _log_writer(log, log_path, checkpoint)
    if sink or not is_blank_text(sink_topic):
        opts = _sink_options(sink, sink_topic, K.METRICS_TOPIC)
        writers.append(lambda b, i: sinks.write_kafka(M.to_kafka_record(M.in_session_order(b)), opts))
    return _start(metrics, writers + (extra_writers or []), checkpoint, available_now)


def start_fine_rates(spark: SparkSession, checkpoint: str, watermark: str, source: dict | None = None,
                     log: bool = True, log_path: str | None = None, records: DataFrame | None = None,
                     extra_writers: list | None = None, width_ms: int = R.FINE_WINDOW_MS,
                     slide_ms: int = R.FINE_SLIDE_MS, available_now: bool = False,
                     partitions: list[int] | None = None, idle: str | None = None,
                     plan: str = "auto") -> StreamingQuery:
    """Players' kills per second and moves per session and window, logged and given to
    ``extra_writers``; computed and discarded without either.  ``plan="panes"`` keeps pane
    state (see :mod:`sessionrate.operators.windows`)."""
    events = _events(spark, source, records, watermark, partitions, idle)
    rates = J.fine_rates_job(None, width_ms, slide_ms, plan=plan, events=events)
    return _start(rates, _log_writer(log, log_path, checkpoint) + (extra_writers or []), checkpoint, available_now)


def start_move_rate(spark: SparkSession, checkpoint: str, watermark: str, source: dict | None = None,
                    log: bool = True, log_path: str | None = None, records: DataFrame | None = None,
                    extra_writers: list | None = None, width_ms: int = R.FINE_WINDOW_MS,
                    slide_ms: int = R.FINE_SLIDE_MS, available_now: bool = False,
                    partitions: list[int] | None = None, idle: str | None = None,
                    plan: str = "auto") -> StreamingQuery:
    """Moves per second per session and window, logged and given to ``extra_writers``."""
    events = _events(spark, source, records, watermark, partitions, idle)
    rates = J.move_rate_job(None, width_ms, slide_ms, plan=plan, events=events)
    return _start(rates, _log_writer(log, log_path, checkpoint) + (extra_writers or []), checkpoint, available_now)


def start_groups(spark: SparkSession, path: str, checkpoint: str, watermark: str,
                 source: dict | None = None, records: DataFrame | None = None,
                 width_ms: int = R.GROUP_WINDOW_MS, slide_ms: int = R.GROUP_SLIDE_MS,
                 parts: int = R.GROUP_PARTS, available_now: bool = False,
                 partitions: list[int] | None = None, idle: str | None = None,
                 block: int | None = None) -> StreamingQuery:
    """Players' events listed per Kafka key and window, as JSON lines in text files: in
    ``parts`` per group, or with ``block`` in pieces of so many offsets, whose state
    rows do not grow with the lists (see :func:`rates.windowed_group_pieces`)."""
    events = _events(spark, source, records, watermark, partitions, idle)
    groups = J.grouped_job(None, width_ms, slide_ms, parts=parts, events=events, block=block)
    return sinks.write_text(R.windowed_group_text(groups), path, checkpoint, available_now)


def start_feedback(spark: SparkSession, checkpoint: str, source: dict | None = None,
                   sink: dict | None = None, sink_topic: str | None = None,
                   records: DataFrame | None = None, writer=None,
                   available_now: bool = False) -> StreamingQuery:
    """Metric records of ``source`` (default: the metrics topic) -> feedback sentences on
    the sink topic, keys and headers kept.  ``records`` replaces the Kafka source, ``writer``
    the Kafka sink (``fn(batch_df, batch_id)``)."""
    source = source or K.kafka_options(topic=K.METRICS_TOPIC)
    out = M.metric_feedback(_records(spark, source, records, headers=True))
    if writer is not None:
        return _start(out, [writer], checkpoint, available_now)
    return sinks.write_kafka(out, _sink_options(sink, sink_topic, K.FEEDBACK_TOPIC),
                             checkpoint=checkpoint, available_now=available_now)


def _route(rows: DataFrame, path: str | None, sink: dict | None, checkpoint: str,
           available_now: bool) -> StreamingQuery:
    if path:
        return sinks.write_text(sinks.echo(rows), path, checkpoint, available_now)
    return sinks.write_kafka(rows, _sink_options(sink, None, K.REJECTS_TOPIC), checkpoint, available_now)


def start_rejects(spark: SparkSession, checkpoint: str, path: str | None = None, source: dict | None = None,
                  sink: dict | None = None, records: DataFrame | None = None,
                  available_now: bool = False) -> StreamingQuery:
    """The records of a job's source that parsing rejects, as they came: JSON lines below
    ``path``, else records on the sink topic.  Run beside the job, on the same source."""
    bad = J.rejected_records(_records(spark, source, records))
    return _route(bad, path, sink, checkpoint, available_now)


def start_feedback_rejects(spark: SparkSession, checkpoint: str, path: str | None = None,
                           source: dict | None = None, sink: dict | None = None,
                           records: DataFrame | None = None, available_now: bool = False) -> StreamingQuery:
    """The metric records that get no sentence, with the reason."""
    source = source or K.kafka_options(topic=K.METRICS_TOPIC)
    bad = M.feedback_rejects(_records(spark, source, records, headers=True))
    bad = bad.withColumns({c: F.col(c).cast("string") for c in ("key", "value") if path})
    return _route(bad, path, sink, checkpoint, available_now)
