"""Processing time per record: one micro-batch spreads over the windows in which it is read."""

import datetime as dt

from pyspark.sql import functions as F

from sessionrate.operators import rates as R
from sessionrate.plans import jobs as J
from sessionrate.sources.kafka import decode_envelope
from sessionrate.streaming.runner import start_stream

T0 = dt.datetime(2024, 1, 1)
TEXT = '{"session":"s","counter":1,"type":"killed","actor":{"type":"player"}}'


def records(spark, n):
    return spark.range(n).select(F.lit("k").alias("key"), F.lit(TEXT).alias("value"), F.lit(T0).alias("timestamp"))


def test_several_instants_in_one_batch(spark, tmp_path):
    records(spark, 300_000).coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(records(spark, 1).schema).parquet(str(tmp_path / "in"))
    ev = J.decoded_events(src, event_time="arrival", watermark="0 seconds")
    rates = R.event_count(ev, "killed", 25, 25)
    q = start_stream(rates, sink="memory", query_name="arrival", output_mode="update", available_now=True)
    started = dt.datetime.now(dt.timezone.utc).timestamp() * 1000
    q.awaitTermination()
    assert q.exception() is None
    assert sum(p.numInputRows > 0 for p in q.recentProgress) == 1
    got = spark.sql("SELECT window_end_ms, max(count) AS n FROM arrival GROUP BY 1").collect()
    assert len(got) > 3 and sum(r.n for r in got) == 300_000   # one micro-batch, several panes of 25 ms
    assert all(started - 60_000 < r.window_end_ms < started + 120_000 for r in got)


def test_one_clock_reading_per_record(spark):
    """Uses of the column agree: it is not read again for each."""
    df = decode_envelope(records(spark, 50_000), "arrival").select(
        F.col("event_time").alias("a"), F.unix_millis("event_time").alias("b"), F.col("event_time").alias("c"))
    assert df.filter((F.unix_millis("a") != F.col("b")) | (F.col("a") != F.col("c"))).count() == 0
    assert decode_envelope(records(spark, 10), "processing").select("event_time").distinct().count() == 1
