"""Registered queries: each operator of the library run on the given test tables.

Every query reads the whole ``events`` table of ``sf_dir``, maps it to Kafka-shaped
records (:mod:`sessionrate.sources.adapter`) and runs the library on them, so its work
grows with the table.  Nested results are flattened to scalar columns (``a.b`` ->
``a_b``) so they can be compared with the SQL oracles in :mod:`sessionrate.plans.oracle`.

Window widths: each windowed operator is registered at the reference's width/slide
and at a *scaled* width with the same ratio (6 h / 1 h, 40 h / 1 h, 4 h / 1 h), since
the test events are hours apart and reference widths hold one event per window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionrate import schema as S
from sessionrate.operators import accumulators as A
from sessionrate.operators import metrics as M
from sessionrate.operators import parse as P
from sessionrate.operators import rates as R
from sessionrate.plans import jobs as J
from sessionrate.session import ensure_utc
from sessionrate.sources.adapter import game_records
from sessionrate.operators.windows import WINDOW_END, WINDOW_START

HOUR = 3_600_000
SCALED = {"kill": (6 * HOUR, HOUR), "fine": (40 * HOUR, HOUR), "group": (4 * HOUR, HOUR)}


def _events(spark: SparkSession, sf_dir: str, defaults: str = "none", faults: bool = False,
            keep_rejects: bool = False) -> DataFrame:
    ensure_utc(spark)
    return J.decoded_events(game_records(spark, sf_dir, faults), defaults=defaults,
                            keep_rejects=keep_rejects)


def flatten(df: DataFrame, cols: list[str]) -> DataFrame:
    """Select ``cols``; struct members become ``parent_child`` scalar columns."""
    out = []
    for c in cols:
        dt = df.schema[c].dataType
        if isinstance(dt, T.StructType):
            for path, _ in S.leaf_paths(dt, c + "."):
                out.append(F.col(path).alias(path.replace(".", "_")))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _parsed_flat(ev: DataFrame) -> DataFrame:
    ev = ev.withColumn("event_time_ms", F.unix_millis("event_time"))
    return flatten(ev, ["key", "event_time_ms", *P.EVENT_FIELDS, P.CORRUPT])


# ---------------------------------------------------------------------------
# parse / decode / checks
# ---------------------------------------------------------------------------

def q_parse_events(spark, sf_dir):
    return _parsed_flat(_events(spark, sf_dir, "none", keep_rejects=True))


def q_parse_events_sentinel(spark, sf_dir):
    return _parsed_flat(_events(spark, sf_dir, "sentinel", keep_rejects=True))


def q_parse_events_schema(spark, sf_dir):
    return _parsed_flat(_events(spark, sf_dir, "schema", keep_rejects=True))


def q_kafka_envelope_decode(spark, sf_dir):
    ensure_utc(spark)
    from sessionrate.sources.kafka import decode_envelope
    env = decode_envelope(game_records(spark, sf_dir))
    return env.select("key", "value", F.unix_millis("timestamp").alias("timestamp_ms"))


def q_empty_record_flags(spark, sf_dir):
    """On records with faults (see the adapter): some events are empty, some are NULL."""
    flags = P.empty_record_flags(_events(spark, sf_dir, "sentinel", faults=True, keep_rejects=True))
    return flags.select(F.col("offset").alias("record_offset"), "event_empty", "frame_empty",
                        "actor_empty", "actor_position_empty", "target_empty")


def q_parse_rejects(spark, sf_dir):
    """The rejected ones of records with faults, as they came."""
    ensure_utc(spark)
    bad = J.rejected_records(game_records(spark, sf_dir, faults=True))
    return bad.select(F.col("offset").alias("record_offset"), "key", "value")


def _verdicts(spark, sf_dir, defaults):
    ev = _events(spark, sf_dir, defaults, faults=True, keep_rejects=True)
    return ev.select(F.col("offset").alias("record_offset"), F.col(P.CORRUPT).isNotNull().alias("rejected"),
                     "session", "counter", F.col("frame.tic").alias("frame_tic"),
                     F.col("actor.type").alias("actor_type"))


def q_none_rejects(spark, sf_dir):
    return _verdicts(spark, sf_dir, "none")


def q_sentinel_rejects(spark, sf_dir):
    return _verdicts(spark, sf_dir, "sentinel")


def q_schema_rejects(spark, sf_dir):
    return _verdicts(spark, sf_dir, "schema")


def q_sentinels_to_null(spark, sf_dir):
    return _parsed_flat(P.sentinels_to_null(_events(spark, sf_dir, "sentinel", keep_rejects=True)))


def _violations(spark, sf_dir):
    ensure_utc(spark)
    from sessionrate.sources.kafka import decode_envelope
    env = decode_envelope(game_records(spark, sf_dir, faults=True))
    return P.schema_violations(env)


def q_schema_violations(spark, sf_dir):
    v = _violations(spark, sf_dir)
    return v.select(F.col("offset").alias("record_offset"),
                    F.size("violations").alias("n_violations"),
                    F.array_join("violations", "|").alias("violations"))


def q_schema_violations_document(spark, sf_dir):
    """The same, compiled from a JSON Schema document."""
    from sessionrate.operators.json_schema import compile_schema, event_document
    from sessionrate.sources.kafka import decode_envelope
    ensure_utc(spark)
    v = compile_schema(event_document()).violations(decode_envelope(game_records(spark, sf_dir, faults=True)))
    return v.select(F.col("offset").alias("record_offset"), F.size("violations").alias("n_violations"),
                    F.array_join("violations", "|").alias("violations"))


def q_schema_violation_counts(spark, sf_dir):
    return P.schema_violation_counts(_violations(spark, sf_dir))


# ---------------------------------------------------------------------------
# filters
# ---------------------------------------------------------------------------

def _filtered(df):
    return df.select("counter", "session", "type", F.col("actor.type").alias("actor_type"))


def q_filter_actor_type(spark, sf_dir):
    return _filtered(R.filter_actor_type(_events(spark, sf_dir), R.PLAYER))


def q_filter_actor_type_exact(spark, sf_dir):
    return _filtered(R.filter_actor_type(_events(spark, sf_dir), R.PLAYER, case_sensitive=True))


def q_filter_event_type(spark, sf_dir):
    return _filtered(R.filter_event_type(_events(spark, sf_dir), R.MOVE))


def q_filter_event_type_exact(spark, sf_dir):
    return _filtered(R.filter_event_type(_events(spark, sf_dir), R.MOVE, case_sensitive=True,
                                         missing_as_empty=True))


# ---------------------------------------------------------------------------
# rates, counts, spans
# ---------------------------------------------------------------------------

def _kill_metrics(spark, sf_dir, width, slide, unit_ms=1000, plan="auto"):
    ev = _events(spark, sf_dir)
    return J.kill_rate_job(None, width_ms=width, slide_ms=slide, unit_ms=unit_ms,
                           plan=plan, events=ev)


def q_kill_rate(spark, sf_dir):
    return _kill_metrics(spark, sf_dir, R.KILL_WINDOW_MS, R.KILL_SLIDE_MS)


def q_kill_rate_scaled(spark, sf_dir):
    return _kill_metrics(spark, sf_dir, *SCALED["kill"])


def q_kill_rate_panes(spark, sf_dir):
    return _kill_metrics(spark, sf_dir, *SCALED["kill"], plan="panes")


def q_kill_rate_per_minute(spark, sf_dir):
    return _kill_metrics(spark, sf_dir, R.KILL_WINDOW_MS, R.KILL_SLIDE_MS, unit_ms=60_000)


def q_kill_rate_with_rejects(spark, sf_dir):
    """Kill rates from records of which some are rejects: those count nowhere."""
    ev = _events(spark, sf_dir, faults=True)
    return J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1], events=ev)


def _fine_kills(spark, sf_dir, width, slide, plan="auto"):
    players = R.filter_actor_type(_events(spark, sf_dir), R.PLAYER)
    return R.event_rate(players, R.KILLED, width, slide, formula="per_width", plan=plan)


def q_kill_rate_fine(spark, sf_dir):
    return _fine_kills(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS)


def q_kill_rate_fine_scaled(spark, sf_dir):
    return _fine_kills(spark, sf_dir, *SCALED["fine"])


def q_kill_rate_fine_bucketed(spark, sf_dir):
    return _fine_kills(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS, plan="bucketed")


def q_kill_rate_fine_direct(spark, sf_dir):
    return _fine_kills(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS, plan="direct")


def q_kill_rate_fine_panes(spark, sf_dir):
    return _fine_kills(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS, plan="panes")


def _moves(spark, sf_dir, width, slide):
    players = R.filter_actor_type(_events(spark, sf_dir), R.PLAYER)
    return R.event_count(players, R.MOVE, width, slide)


def q_move_count(spark, sf_dir):
    return _moves(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS)


def q_move_count_scaled(spark, sf_dir):
    return _moves(spark, sf_dir, *SCALED["fine"])


def q_action_rate(spark, sf_dir):
    return J.move_rate_job(None, events=_events(spark, sf_dir))


def q_action_rate_scaled(spark, sf_dir):
    return J.move_rate_job(None, *SCALED["fine"], events=_events(spark, sf_dir))


def q_session_activity(spark, sf_dir):
    return J.fine_rates_job(None, events=_events(spark, sf_dir))


def q_session_activity_scaled(spark, sf_dir):
    return J.fine_rates_job(None, *SCALED["fine"], events=_events(spark, sf_dir))


def _span(spark, sf_dir, width, slide):
    players = R.filter_actor_type(_events(spark, sf_dir), R.PLAYER)
    return R.activity_span(players, width, slide)


def q_activity_span(spark, sf_dir):
    return _span(spark, sf_dir, R.FINE_WINDOW_MS, R.FINE_SLIDE_MS)


def q_activity_span_scaled(spark, sf_dir):
    return _span(spark, sf_dir, *SCALED["fine"])


def q_window_summary(spark, sf_dir):
    moves = R.filter_event_type(_events(spark, sf_dir), R.MOVE, case_sensitive=True,
                                missing_as_empty=True)
    return R.window_summary(moves, *SCALED["fine"])


# ---------------------------------------------------------------------------
# grouped event lists
# ---------------------------------------------------------------------------

def _groups(spark, sf_dir, width, slide):
    g = J.grouped_job(None, width, slide, events=_events(spark, sf_dir))
    return g.select("key", WINDOW_START, WINDOW_END, "n_events", "part", "n_parts",
                    F.to_json("events").alias("events_json"))


def q_windowed_group(spark, sf_dir):
    return _groups(spark, sf_dir, R.GROUP_WINDOW_MS, R.GROUP_SLIDE_MS)


def q_windowed_group_scaled(spark, sf_dir):
    return _groups(spark, sf_dir, *SCALED["group"])


def q_windowed_group_text(spark, sf_dir):
    g = J.grouped_job(None, *SCALED["group"], events=_events(spark, sf_dir))
    return R.windowed_group_text(g)


def q_windowed_group_chunks(spark, sf_dir):
    """Lists in chunks of 8 by position: groups below and far above that."""
    g = J.grouped_job(None, *SCALED["group"], events=_events(spark, sf_dir), length=8)
    return g.select("key", WINDOW_START, WINDOW_END, "chunk", "n_chunks", "n_events",
                    F.to_json("events").alias("events_json"))


# ---------------------------------------------------------------------------
# metrics, Kafka records, feedback
# ---------------------------------------------------------------------------

def _metric_records(spark, sf_dir, width, slide, window_headers=True):
    return M.to_kafka_record(_kill_metrics(spark, sf_dir, width, slide), window_headers)


def q_metric_to_kafka_record(spark, sf_dir):
    """Records decoded back: member order, member values and the window headers.

    (Doubles are written in Java notation, e.g. ``4.6E-5``; the check reads the text
    back rather than comparing it with another engine's number formatting.)
    """
    rec = _metric_records(spark, sf_dir, *SCALED["kill"])
    text = F.col("value").cast("string")
    back = F.from_json(text, S.METRIC)
    return rec.select(F.col("key").cast("string").alias("key"),
                      F.array_join(F.json_object_keys(text), ",").alias("value_members"),
                      back["session"].alias("value_session"),
                      back["metric"].alias("value_metric"),
                      back["value"].alias("value_value"),
                      _header("window_start_ms").alias("window_start_ms"),
                      _header("window_end_ms").alias("window_end_ms"))


def _header(name):
    h = F.filter("headers", lambda x: x["key"] == F.lit(name))
    return F.element_at(h, 1)["value"].cast("string").cast("long")


def q_metric_feedback(spark, sf_dir):
    out = M.metric_feedback(_metric_records(spark, sf_dir, *SCALED["kill"]))
    return out.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("sentence"),
                      _header("window_start_ms").alias("window_start_ms"),
                      _header("window_end_ms").alias("window_end_ms"))


def _faulty_metric_records(spark, sf_dir):
    """Metric records of which 10 in 16 are spoiled (by hour of the window and session):
    0 value as text, 1 no metric, 2 session a number, 3 cut, 4 empty, 5 a number no double
    holds, 6 a long extra member (no fault), 7 value null, 8 an array, 9 followed by text."""
    m = _kill_metrics(spark, sf_dir, *SCALED["kill"])
    rec = m.select("session", WINDOW_START, "metric", F.to_json(F.struct("session", "metric", "value")).alias("t"))
    kind = (F.expr(f"{WINDOW_START} div {HOUR}") + F.col("session").cast("long")) % 16
    s = F.col("session")
    named = F.concat(F.lit('{"session":"'), s, F.lit('","metric":"m","value":'))
    texts = {
        0: F.concat(named, F.lit('"1.5"}')),
        1: F.concat(F.lit('{"session":"'), s, F.lit('","value":1}')),
        2: F.concat(F.lit('{"session":'), s, F.lit(',"metric":"m","value":1}')),
        3: F.substring("t", 1, 20),
        4: F.lit(""),
        5: F.concat(named, F.lit("1e400}")),
        6: F.concat(named, F.lit('1,"note":"' + "x" * 5000 + '"}')),
        7: F.concat(named, F.lit("null}")),
        8: F.concat(F.lit("["), F.col("t"), F.lit("]")),
        9: F.concat(F.col("t"), F.lit("x")),
    }
    text = F.col("t")
    for k, bad in texts.items():
        text = F.when(kind == k, bad).otherwise(text)
    return rec.select(F.encode(s, "UTF-8").alias("key"), F.encode(text, "UTF-8").alias("value"))


def q_metric_feedback_rejects(spark, sf_dir):
    """Outcomes counted over metric records with faults."""
    checked = M.feedback_checked(_faulty_metric_records(spark, sf_dir))
    return (checked.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"))
                   .agg(F.count(F.lit(1)).alias("n_records")))


def q_metric_session_order(spark, sf_dir):
    """Per session: how many writer tasks its metrics are dealt to (1) and how often one is
    handed to its writer before an earlier window's (never)."""
    dealt = M.in_session_order(_kill_metrics(spark, sf_dir, *SCALED["kill"]))
    seen = dealt.select("session", WINDOW_START, F.spark_partition_id().alias("writer"),
                        F.monotonically_increasing_id().alias("place"))
    before = F.lag(WINDOW_START).over(Window.partitionBy("session").orderBy("place"))
    return (seen.withColumn("late", F.coalesce(before > F.col(WINDOW_START), F.lit(False)))
                .groupBy("session").agg(F.count_distinct("writer").alias("n_writers"),
                                        F.count(F.lit(1)).alias("n_records"),
                                        F.count_if("late").alias("n_out_of_order")))


# ---------------------------------------------------------------------------
# streaming twins (availableNow over the events file, result read back)
# ---------------------------------------------------------------------------

def _stream_events(spark, sf_dir, delay="0 seconds"):
    from sessionrate.sources.adapter import events_to_records
    from sessionrate.streaming.runner import parquet_file_stream
    ensure_utc(spark)
    stream = parquet_file_stream(spark, sf_dir, "events.parquet")
    return J.decoded_events(events_to_records(stream), watermark=delay)


def q_stream_kill_rate_partitions(spark, sf_dir):
    """Records dealt to four topic partitions, of which the last falls silent on 10 January: the
    watermark follows the slowest one and lets go of the silent one after three days."""
    from sessionrate.sources.adapter import events_to_records
    from sessionrate.streaming.runner import parquet_file_stream
    ensure_utc(spark)
    records = events_to_records(parquet_file_stream(spark, sf_dir, "events.parquet"))
    deal = F.when(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp"), 4).otherwise(3)
    records = records.withColumn("partition", (F.col("offset") % deal).cast("int"))
    ev = J.decoded_events(records, watermark="0 seconds", partitions=[0, 1, 2, 3], idle="3 days")
    return _run(spark, J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1], events=ev),
                "stream_kill_rate_partitions")


def _run(spark, df, name):
    from sessionrate.streaming.runner import run_to_parquet
    return spark.read.parquet(run_to_parquet(df, name))


def q_stream_kill_rate(spark, sf_dir):
    ev = _stream_events(spark, sf_dir)
    return _run(spark, J.kill_rate_job(None, width_ms=SCALED["kill"][0],
                                       slide_ms=SCALED["kill"][1], events=ev), "stream_kill_rate")


def q_stream_move_count(spark, sf_dir):
    players = R.filter_actor_type(_stream_events(spark, sf_dir), R.PLAYER)
    return _run(spark, R.event_count(players, R.MOVE, *SCALED["fine"]), "stream_move_count")


def q_stream_action_rate(spark, sf_dir):
    ev = _stream_events(spark, sf_dir)
    return _run(spark, J.move_rate_job(None, *SCALED["fine"], events=ev), "stream_action_rate")


def q_stream_session_activity(spark, sf_dir):
    """Moves and kills/s of players, one streaming aggregation."""
    ev = _stream_events(spark, sf_dir)
    return _run(spark, J.fine_rates_job(None, *SCALED["fine"], events=ev),
                "stream_session_activity")


def _stored(spark, sf_dir, aggs, pane_ms):
    """Players' accumulators of two runs, before and from a time amid a pane, each stored as a
    table of its own."""
    from sessionrate.session import scratch_path
    players, out = R.filter_actor_type(_events(spark, sf_dir), R.PLAYER), []
    border = F.lit("2024-01-15 06:30:00").cast("timestamp")
    for i, part in enumerate((F.col("event_time") < border, F.col("event_time") >= border)):
        path = scratch_path(spark, f"accumulators-{i}")
        A.accumulate(players.where(part), aggs, pane_ms).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def q_session_activity_merged(spark, sf_dir):
    """Moves and kills/s from the merged accumulators of two runs."""
    width, slide = SCALED["fine"]
    aggs = A.rate_aggs(R.MOVE, R.KILLED)
    return A.activity_of(A.finish(A.merge(aggs, *_stored(spark, sf_dir, aggs, slide)), aggs, width, slide), width)


def q_activity_span_merged(spark, sf_dir):
    """Spans from the merged accumulators of two runs."""
    width, slide = SCALED["fine"]
    aggs = A.span_aggs()
    out = A.finish(A.merge(aggs, *_stored(spark, sf_dir, aggs, slide)), aggs, width, slide)
    return out.select("session", WINDOW_START, WINDOW_END, F.col("n_events").alias("sum"),
                      F.col("n_events").alias("count"), "earliest_millis", "latest_millis")


def q_stream_session_activity_stored(spark, sf_dir):
    """A stream that keeps panes only and stores the closed ones; windows finished on reading."""
    from sessionrate.session import scratch_path
    from sessionrate.streaming.runner import start_stream
    width, slide = SCALED["fine"]
    aggs = A.rate_aggs(R.MOVE, R.KILLED)
    panes = A.accumulate(R.filter_actor_type(_stream_events(spark, sf_dir), R.PLAYER), aggs, slide)
    path = scratch_path(spark, "panes-out")
    q = start_stream(panes, sink="parquet", path=path, checkpoint=scratch_path(spark, "panes-ckpt"), available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    windows = A.finish(spark.read.schema(panes.schema).parquet(path), aggs, width, slide, A.watermark_ms(q))
    return A.activity_of(windows, width)


def q_stream_session_activity_panes(spark, sf_dir):
    """The same through pane state: two chained aggregations."""
    return _run(spark, J.fine_rates_job(None, *SCALED["fine"], plan="panes", events=_stream_events(spark, sf_dir)),
                "stream_session_activity_panes")


def q_stream_activity_span_panes(spark, sf_dir):
    players = R.filter_actor_type(_stream_events(spark, sf_dir), R.PLAYER)
    return _run(spark, R.activity_span(players, *SCALED["fine"], plan="panes"), "stream_activity_span_panes")


def q_stream_activity_span(spark, sf_dir):
    players = R.filter_actor_type(_stream_events(spark, sf_dir), R.PLAYER)
    return _run(spark, R.activity_span(players, *SCALED["fine"]), "stream_activity_span")


def q_stream_windowed_group(spark, sf_dir):
    """Grouped event lists as a stream (closed windows only)."""
    g = J.grouped_job(None, *SCALED["group"], events=_stream_events(spark, sf_dir))
    return _run(spark, g.select("key", WINDOW_START, WINDOW_END, "n_events", "part", "n_parts",
                                F.to_json("events").alias("events_json")),
                "stream_windowed_group")


def q_stream_windowed_group_pieces(spark, sf_dir):
    """Grouped lists as a stream whose state rows do not grow: pieces of 64 offsets."""
    g = J.grouped_job(None, *SCALED["group"], events=_stream_events(spark, sf_dir), block=64)
    return _run(spark, g.select("key", WINDOW_START, WINDOW_END, "part", "sequence", "n_events",
                                F.to_json("events").alias("events_json")), "stream_windowed_group_pieces")


def q_stream_windowed_group_assembled(spark, sf_dir):
    """The same pieces put together to lists in chunks of 8."""
    g = J.grouped_job(None, *SCALED["group"], events=_stream_events(spark, sf_dir), block=64)
    out = R.assemble_groups(_run(spark, g, "stream_windowed_group_assembled"), length=8)
    return out.select("key", WINDOW_START, WINDOW_END, "chunk", "n_chunks", "n_events",
                      F.to_json("events").alias("events_json"))


def q_stream_metric_feedback(spark, sf_dir):
    """Kill-rate metrics and their feedback sentences chained in one streaming query."""
    ev = _stream_events(spark, sf_dir)
    metrics = J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1],
                              events=ev)
    fb = M.metric_feedback(M.to_kafka_record(metrics, window_headers=True))
    return _run(spark, fb.select(F.col("key").cast("string").alias("key"),
                                 F.col("value").cast("string").alias("sentence"),
                                 _header("window_start_ms").alias("window_start_ms"),
                                 _header("window_end_ms").alias("window_end_ms")),
                "stream_metric_feedback")


QUERIES = {
    "parse_events": q_parse_events,
    "parse_events_sentinel": q_parse_events_sentinel,
    "parse_events_schema": q_parse_events_schema,
    "kafka_envelope_decode": q_kafka_envelope_decode,
    "empty_record_flags": q_empty_record_flags,
    "parse_rejects": q_parse_rejects,
    "none_rejects": q_none_rejects,
    "sentinel_rejects": q_sentinel_rejects,
    "schema_rejects": q_schema_rejects,
    "sentinels_to_null": q_sentinels_to_null,
    "schema_violations": q_schema_violations,
    "schema_violations_document": q_schema_violations_document,
    "schema_violation_counts": q_schema_violation_counts,
    "filter_actor_type": q_filter_actor_type,
    "filter_actor_type_exact": q_filter_actor_type_exact,
    "filter_event_type": q_filter_event_type,
    "filter_event_type_exact": q_filter_event_type_exact,
    "kill_rate": q_kill_rate,
    "kill_rate_scaled": q_kill_rate_scaled,
    "kill_rate_panes": q_kill_rate_panes,
    "kill_rate_per_minute": q_kill_rate_per_minute,
    "kill_rate_with_rejects": q_kill_rate_with_rejects,
    "kill_rate_fine_bucketed": q_kill_rate_fine_bucketed,
    "kill_rate_fine_direct": q_kill_rate_fine_direct,
    "kill_rate_fine": q_kill_rate_fine,
    "kill_rate_fine_scaled": q_kill_rate_fine_scaled,
    "kill_rate_fine_panes": q_kill_rate_fine_panes,
    "move_count": q_move_count,
    "move_count_scaled": q_move_count_scaled,
    "action_rate": q_action_rate,
    "action_rate_scaled": q_action_rate_scaled,
    "session_activity": q_session_activity,
    "session_activity_scaled": q_session_activity_scaled,
    "activity_span": q_activity_span,
    "activity_span_scaled": q_activity_span_scaled,
    "window_summary": q_window_summary,
    "windowed_group": q_windowed_group,
    "windowed_group_scaled": q_windowed_group_scaled,
    "windowed_group_chunks": q_windowed_group_chunks,
    "stream_windowed_group_pieces": q_stream_windowed_group_pieces,
    "stream_windowed_group_assembled": q_stream_windowed_group_assembled,
    "windowed_group_text": q_windowed_group_text,
    "metric_to_kafka_record": q_metric_to_kafka_record,
    "metric_session_order": q_metric_session_order,
    "metric_feedback": q_metric_feedback,
    "metric_feedback_rejects": q_metric_feedback_rejects,
    "stream_kill_rate": q_stream_kill_rate,
    "stream_kill_rate_partitions": q_stream_kill_rate_partitions,
    "stream_move_count": q_stream_move_count,
    "stream_action_rate": q_stream_action_rate,
    "stream_metric_feedback": q_stream_metric_feedback,
    "stream_windowed_group": q_stream_windowed_group,
    "stream_session_activity": q_stream_session_activity,
    "stream_activity_span": q_stream_activity_span,
    "session_activity_merged": q_session_activity_merged,
    "activity_span_merged": q_activity_span_merged,
    "stream_session_activity_stored": q_stream_session_activity_stored,
    "stream_session_activity_panes": q_stream_session_activity_panes,
    "stream_activity_span_panes": q_stream_activity_span_panes,
}
