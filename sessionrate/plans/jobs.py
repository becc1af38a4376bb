"""The five jobs as DataFrame -> DataFrame compositions.

Each takes Kafka-shaped records (``key, value, timestamp[, headers]``: a Kafka source
DataFrame, or :func:`sessionrate.sources.adapter.events_to_records` in tests) and
returns the job's result; sources and sinks stay outside, so each job runs the same
on batch input, on a stream, and in tests.

==============  ==============================================================
kill_rate_job   players' kills per second per session, 3 s / 500 ms -> metrics
fine_rates_job  players' kills/s and moves per session, 1 s / 25 ms
move_rate_job   moves/s per session (exact-case type, no actor filter), 1 s / 25 ms
grouped_job     players' events listed per Kafka key and window, 1 s / 250 ms
feedback_job    metric records -> feedback sentences
==============  ==============================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.operators import metrics as M
from sessionrate.operators import rates as R
from sessionrate.operators.parse import CORRUPT, parse_events, split_rejects
from sessionrate.sources.kafka import decode_envelope
from sessionrate.streaming.watermarks import slowest_watermark


def decoded_events(records: DataFrame | list[DataFrame], defaults: str = "none", on_error: str = "reject",
                   event_time: str = "record", watermark: str | None = None,
                   time_member: str = "frame.millis", time_base_ms: int = 0,
                   keep_rejects: bool = False, partitions: list[int] | None = None,
                   idle: str | None = None) -> DataFrame:
    """Records -> parsed events (``key, timestamp, headers, event_time`` + event members).

    Rejected records (see :mod:`sessionrate.operators.parse`) are left out, so no rate counts
    them; :func:`rejected_records` gives them, and ``keep_rejects`` keeps them here, told by
    ``_corrupt_record``.

    event_time: ``record`` (the record timestamp), ``processing`` (wall clock, one instant per
    micro-batch), ``arrival`` (the clock when the record is read), or
    ``column``: ``time_base_ms + <time_member>`` milliseconds of the parsed event
    (``frame.millis`` is relative to the game session, hence the base).

    ``watermark`` (a delay such as ``"0 seconds"``, streams only) is attached to the
    records *before* parsing for record/processing time: it then advances with every
    source record, as a source-level watermark does, and no filter on event members
    (which cannot move below the parse) is evaluated before it.  For ``column`` time
    it can only follow the parse.

    With ``partitions`` (of a stream with a ``partition`` column), or ``records`` as one stream
    per topic partition, the watermark is that of the slowest partition and ``idle`` releases
    those without records (see :mod:`sessionrate.streaming.watermarks`).
    """
    if partitions or not isinstance(records, DataFrame):
        if event_time == "column":
            raise ValueError("a watermark per partition needs record time or processing time")
        env = (decode_envelope(records, event_time) if isinstance(records, DataFrame)
               else [decode_envelope(r, event_time) for r in records])
        env = slowest_watermark(env, watermark or "0 seconds", idle, partitions)
        return _good(parse_events(env, defaults=defaults, on_error=on_error), keep_rejects)
    if event_time == "column":
        env = decode_envelope(records, "record")
        ev = _good(parse_events(env, defaults=defaults, on_error=on_error), keep_rejects)
        ev = ev.withColumn("event_time", F.timestamp_millis(
            F.lit(int(time_base_ms)) + F.col(time_member).cast("long")))
        return ev.withWatermark("event_time", watermark) if watermark is not None else ev
    env = decode_envelope(records, event_time)
    if watermark is not None:
        env = env.withWatermark("event_time", watermark)
    return _good(parse_events(env, defaults=defaults, on_error=on_error), keep_rejects)


def _good(parsed: DataFrame, keep_rejects: bool) -> DataFrame:
    return parsed if keep_rejects else split_rejects(parsed)[0].drop(CORRUPT)


def rejected_records(records: DataFrame) -> DataFrame:
    """The records that parsing rejects, as they came (``key, value`` text, ``timestamp,
    headers, [partition, offset]``)."""
    env = decode_envelope(records).drop("event_time")
    bad = split_rejects(parse_events(env, keep_value=True))[1]
    return bad.select(*env.columns)


def kill_rate_job(records: DataFrame | None = None, event_type: str = R.KILLED,
                  actor_type: str = R.PLAYER,
                  width_ms: int = R.KILL_WINDOW_MS, slide_ms: int = R.KILL_SLIDE_MS,
                  unit_ms: int = 1000, plan: str = "auto", events: DataFrame | None = None
                  ) -> DataFrame:
    """Metric per (session, window): ``<event_type> per <unit>`` over players' events."""
    ev = events if events is not None else decoded_events(records)
    players = R.filter_actor_type(ev, actor_type)
    rates = R.event_rate(players, event_type, width_ms, slide_ms, unit_ms, plan=plan)
    return M.to_metric(rates, event_type, unit_ms)


def fine_rates_job(records: DataFrame | None = None, width_ms: int = R.FINE_WINDOW_MS,
                   slide_ms: int = R.FINE_SLIDE_MS, plan: str = "auto",
                   events: DataFrame | None = None) -> DataFrame:
    """Kills per second and move counts from one windowed stream of players' events."""
    ev = events if events is not None else decoded_events(records)
    return R.session_activity(R.filter_actor_type(ev, R.PLAYER), width_ms, slide_ms, plan=plan)


def move_rate_job(records: DataFrame | None = None, width_ms: int = R.FINE_WINDOW_MS,
                  slide_ms: int = R.FINE_SLIDE_MS, plan: str = "auto",
                  events: DataFrame | None = None) -> DataFrame:
    ev = events if events is not None else decoded_events(records)
    return R.action_rate(ev, R.MOVE, width_ms, slide_ms, plan=plan)


def grouped_job(records: DataFrame | None = None, width_ms: int = R.GROUP_WINDOW_MS,
                slide_ms: int = R.GROUP_SLIDE_MS, parts: int = R.GROUP_PARTS,
                events: DataFrame | None = None, length: int | None = None,
                block: int | None = None) -> DataFrame:
    """Players' events (exact-case ``player``) listed per Kafka key and window: in ``parts``,
    in chunks of ``length`` events (batch), or in pieces of ``block`` offsets."""
    ev = events if events is not None else decoded_events(records)
    players = R.filter_actor_type(ev, R.PLAYER, case_sensitive=True)
    if length:
        return R.windowed_group_chunks(players, width_ms, slide_ms, key="key", length=length)
    if block:
        return R.windowed_group_pieces(players, width_ms, slide_ms, key="key", block=block)
    return R.windowed_group(players, width_ms, slide_ms, key="key", parts=parts)


def feedback_job(metric_records: DataFrame) -> DataFrame:
    return M.metric_feedback(metric_records)
