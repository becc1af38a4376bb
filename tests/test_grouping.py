"""Grouped event lists: parts bound the group size, and parts re-assemble exactly."""

import datetime as dt
import hashlib
from collections import Counter

from pyspark.sql import functions as F

from sessionrate.operators import rates as R

T0 = dt.datetime(2024, 1, 1)


def _part(place, parts):
    """The part that a record's place is dealt to."""
    return int(hashlib.md5(str(place).encode()).hexdigest()[:8], 16) % parts


def test_hot_group_split_into_parts(spark):
    # one hot key holding most rows, plus a few cold keys
    data = [("hot", i, T0 + dt.timedelta(milliseconds=i % 900)) for i in range(2000)]
    data += [(f"cold{i}", 10_000 + i, T0 + dt.timedelta(milliseconds=i)) for i in range(5)]
    df = spark.createDataFrame(data, "key string, counter long, event_time timestamp")
    g = R.windowed_group(df, 1000, 1000, key="key", parts=7, element=F.struct(F.col("counter")))
    rows = g.collect()
    hot = [r for r in rows if r.key == "hot"]
    assert {r.n_parts for r in hot} == {7} and len(hot) == 7
    assert all(230 <= len(r.events) <= 345 for r in hot)      # a seventh each, about
    assert all(r.n_events == len(r.events) for r in rows)
    merged = sorted(e.counter for r in hot for e in r.events)
    assert merged == list(range(2000))                        # nothing lost or duplicated
    for r in hot:
        cs = [e.counter for e in r.events]
        assert cs == sorted(cs)                               # each part ordered
    cold = [r for r in rows if r.key != "hot"]
    assert all(r.n_parts == 7 and r.part == _part(10_000 + int(r.key[4:]), 7) and len(r.events) == 1 for r in cold)


def test_equal_events_are_spread_by_their_offsets(spark):
    """Redelivered records: 1,000 equal rows go to all parts, none is lost."""
    data = [("hot", 7, T0, i) for i in range(1000)]
    df = spark.createDataFrame(data, "key string, counter long, event_time timestamp, offset long")
    g = R.windowed_group(df, 1000, 1000, key="key", element=F.struct(F.col("counter"))).collect()
    assert len(g) == R.GROUP_PARTS and sum(r.n_events for r in g) == 1000
    assert all(90 <= r.n_events <= 160 for r in g)


def test_producers_that_take_turns_fill_all_parts(spark):
    """Eight producers in turn: every record of a key has the same offset modulo 8."""
    data = [(f"k{i % 8}", i // 8, T0, 0, i) for i in range(8000)]
    df = spark.createDataFrame(data, "key string, counter long, event_time timestamp, partition int, offset long")
    g = R.windowed_group(df, 1000, 1000, key="key", element=F.struct(F.col("counter"))).collect()
    assert len(g) == 8 * R.GROUP_PARTS
    assert all(80 <= r.n_events <= 180 and r.part < R.GROUP_PARTS for r in g)
    for k in range(8):
        assert sorted(e.counter for r in g if r.key == f"k{k}" for e in r.events) == list(range(1000))


def test_partitions_with_equal_offsets_are_told_apart(spark):
    data = [("k", i, T0, i, 5) for i in range(800)]
    df = spark.createDataFrame(data, "key string, counter long, event_time timestamp, partition int, offset long")
    g = R.windowed_group(df, 1000, 1000, key="key", element=F.struct(F.col("counter"))).collect()
    assert {r.part: r.n_events for r in g} == dict(Counter(_part(f"{i}/5", R.GROUP_PARTS) for i in range(800)))


def test_size_of_a_group_does_not_change_its_shape(spark):
    for n in (1, 10, 7000):
        df = spark.createDataFrame([("k", i, T0) for i in range(n)], "key string, counter long, event_time timestamp")
        g = R.windowed_group(df, 1000, 1000, key="key", parts=4, element=F.struct(F.col("counter"))).collect()
        assert {r.part for r in g} == {_part(i, 4) for i in range(n)}
        assert {r.n_parts for r in g} == {4} and sum(r.n_events for r in g) == n


def test_one_part_is_one_row_per_group(spark):
    df = spark.createDataFrame([("k", i, T0) for i in (3, 1, 2)], "key string, counter long, event_time timestamp")
    r = R.windowed_group(df, 1000, 1000, key="key", parts=1, element=F.struct(F.col("counter"))).first()
    assert [e.counter for e in r.events] == [1, 2, 3] and (r.part, r.n_parts, r.n_events) == (0, 1, 3)


def test_stream_parts_reassemble_to_batch_groups(spark):
    from sessionrate.plans import jobs as J
    from sessionrate.plans.queries import SCALED, _events, _stream_events
    from sessionrate.streaming.runner import start_stream
    sf = "/root/testdata/sf0.001"
    width, slide = SCALED["group"]
    ev = R.filter_actor_type(_stream_events(spark, sf), "player", case_sensitive=True)
    g = R.windowed_group(ev, width, slide, key="key", parts=3)
    q = start_stream(g.select("key", "window_start_ms", "part", "n_parts",
                              F.transform("events", lambda e: e["counter"]).alias("c")),
                     sink="memory", query_name="parts3", available_now=True)
    q.awaitTermination()
    got = {}
    for r in spark.sql("SELECT * FROM parts3").collect():
        assert r.n_parts == 3 and 0 <= r.part < 3 and r.c == sorted(r.c)
        got.setdefault((r.key, r.window_start_ms), []).extend(r.c)
    batch = J.grouped_job(None, width, slide, parts=1, events=_events(spark, sf))
    want = {(r.key, r.window_start_ms): [e.counter for e in r.events] for r in batch.collect()}
    max_ms = spark.read.parquet(f"{sf}/events.parquet").select(
        F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0]
    closed = {k for k in want if k[1] + width <= max_ms}
    assert set(got) == closed and closed
    assert all(sorted(v) == want[k] for k, v in got.items())


def test_records_without_key_form_a_group(spark):
    data = [(None, 1, T0), (None, 2, T0 + dt.timedelta(milliseconds=10)), ("k", 3, T0)]
    df = spark.createDataFrame(data, "key string, counter long, event_time timestamp")
    g = R.windowed_group(df, 1000, 1000, key="key", element=F.struct(F.col("counter")))
    got = {}
    for r in g.orderBy("part").collect():
        got.setdefault(r.key, []).extend(e.counter for e in r.events)
    assert got == {None: [1, 2], "k": [3]}
