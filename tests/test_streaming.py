"""Structured Streaming: late rows across micro-batches, and stream = batch parity."""

import datetime as dt
import json
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sessionrate.operators import rates as R
from sessionrate.plans import jobs as J
from sessionrate.streaming.runner import LateRows, start_stream

T0 = dt.datetime(2024, 1, 1)
BATCHES = [
    [(100, "a", "killed"), (600, "a", "move"), (1200, "b", "move")],
    [(5000, "a", "killed")],
    [(700, "a", "killed"), (4999, "b", "killed")],
    [(20000, "z", "move")],
]


def _write_batches(folder):
    now = time.time() - 1000
    for i, rows in enumerate(BATCHES):
        recs = [{"key": s, "value": json.dumps({"session": s, "counter": ms, "type": t,
                                                  "actor": {"type": "player"}}),
                 "timestamp": T0 + dt.timedelta(milliseconds=ms)} for ms, s, t in rows]
        path = os.path.join(folder, f"batch-{i}.parquet")
        pq.write_table(pa.Table.from_pylist(recs), path)
        os.utime(path, (now + 10 * i, now + 10 * i))


def _run(spark, delay):
    folder = tempfile.mkdtemp(prefix="late-rows-")
    _write_batches(folder)
    src = (spark.readStream.schema("key string, value string, timestamp timestamp")
           .option("maxFilesPerTrigger", "1").parquet(folder))
    ev = J.decoded_events(src, watermark=delay)
    rates = R.event_rate(R.filter_actor_type(ev, "player"), "killed", 3000, 500)
    name = f"late_{delay.split()[0]}"
    late = LateRows.attach(spark)
    try:
        q = start_stream(rates, sink="memory", query_name=name, available_now=True)
        q.awaitTermination()
        _run.dropped = late.total(q)
    finally:
        spark.streams.removeListener(late)
    rows = spark.sql(f"SELECT * FROM {name}").collect()
    base = 1704067200000
    return {(r.session, r.window_end_ms - base): round(r.value * 3) for r in rows}


def test_late_row_dropped_only_for_closed_window(spark):
    got = _run(spark, "0 seconds")
    assert len(got) == 25
    expect_a = {500: 1, 1000: 1, 1500: 2, 2000: 2, 2500: 2, 3000: 2, 3500: 1}
    expect_a.update({e: 1 for e in range(5500, 8001, 500)})
    expect_b = {e: 0 for e in range(1500, 4001, 500)}
    expect_b.update({e: 1 for e in range(5000, 7501, 500)})
    assert {e: n for (s, e), n in got.items() if s == "a"} == expect_a
    assert {e: n for (s, e), n in got.items() if s == "b"} == expect_b
    assert not any(s == "z" for s, _ in got)
    assert _run.dropped >= 1                       # the late kill, for its closed window


def test_delay_keeps_late_row(spark):
    got = _run(spark, "5 seconds")
    assert len(got) == 25
    assert got[("a", 1000)] == 2
    assert _run.dropped == 0


def test_stream_equals_batch_on_closed_windows(spark):
    from sessionrate.plans.queries import SCALED, _stream_events, _events
    sf = "/root/testdata/sf0.001"
    width, slide = SCALED["kill"]
    stream = J.kill_rate_job(None, width_ms=width, slide_ms=slide, events=_stream_events(spark, sf))
    q = start_stream(stream, sink="memory", query_name="parity", available_now=True)
    q.awaitTermination()
    got = spark.sql("SELECT * FROM parity")
    batch = J.kill_rate_job(None, width_ms=width, slide_ms=slide, events=_events(spark, sf))
    max_ms = spark.read.parquet(f"{sf}/events.parquet").select(
        F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0]
    closed = batch.where(F.col("window_end_ms") <= max_ms)
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).count() == 0


def test_processing_time_event_time(spark):
    """Event time = processing time: every record of a batch falls in the current windows."""
    from sessionrate.sources.kafka import decode_envelope
    recs = spark.createDataFrame([("k", '{"session":"s","type":"killed","actor":{"type":"player"}}',
                                   T0)] * 3, "key string, value string, timestamp timestamp")
    env = decode_envelope(recs, event_time="processing")
    assert env.select(F.countDistinct("event_time")).first()[0] == 1
    ev = J.decoded_events(recs, event_time="processing")
    out = R.event_rate(ev, "killed", 3000, 500).collect()
    assert len(out) == 6 and all(r.value == 1.0 for r in out)
    now = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
    assert all(abs(r.window_end_ms - now) < 60_000 for r in out)


def test_event_time_from_a_member_matches_record_time(spark):
    """frame.millis + the adapter's base is the record time, so the rates agree."""
    from sessionrate.sources.adapter import EPOCH_2024_MS, game_records
    recs = game_records(spark, "/root/testdata/sf0.001")
    by_record = J.kill_rate_job(None, events=J.decoded_events(recs))
    by_member = J.kill_rate_job(None, events=J.decoded_events(
        recs, event_time="column", time_member="frame.millis", time_base_ms=EPOCH_2024_MS))
    assert by_record.count() == by_member.count() > 0
    assert by_record.exceptAll(by_member).count() == 0
