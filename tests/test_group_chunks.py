"""Grouped lists in chunks by position, and in pieces whose state does not grow."""

import glob
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sessionrate.operators import rates as R
from sessionrate.streaming.runner import start_stream

BASE = 1704067200000


def element():
    return F.struct("counter", "partition", "offset")


def frame(spark, rows):
    df = spark.createDataFrame(rows, "key string, counter long, ms long, partition int, offset long")
    return df.select("key", "counter", F.timestamp_millis(F.lit(BASE) + F.col("ms")).alias("event_time"), "partition", "offset")


def lists(df, *at):
    """{(key, window end): the list of its rows in order}, after checks of the rows' own shape."""
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: tuple(r[c] for c in at)):
        assert r.n_events == len(r.events) > 0
        out[r.key, r.window_end_ms - BASE].append(r)
    return out


def brute(rows, width, slide):
    out = defaultdict(list)
    for key, counter, ms, p, o in rows:
        for k in range(width // slide):
            out[key, ms // slide * slide - k * slide + width].append((counter, p, o))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("length", [1, 7, 1000])
def test_chunks_are_the_list_by_position(spark, length):
    rng = random.Random(length)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(300), rng.randrange(3000), i % 4, i) for i in range(900)]
    want = brute(rows, 1000, 250)
    got = lists(R.windowed_group_chunks(frame(spark, rows).repartition(5), 1000, 250, length=length, element=element()), "chunk")
    assert set(got) == set(want)
    for k, parts in got.items():
        n = -(-len(want[k]) // length)
        assert [r.chunk for r in parts] == list(range(n)) and {r.n_chunks for r in parts} == {n}
        assert all(r.n_events == length for r in parts[:-1]) and parts[-1].n_events <= length
        assert [tuple(e) for r in parts for e in r.events] == want[k]


def test_a_million_rows_of_one_group(spark):
    n, length = 1_000_000, 10_000
    df = spark.range(n).select(F.lit("hot").alias("key"), ((F.col("id") * 7919) % n).alias("counter"),
                               F.timestamp_millis(F.lit(BASE) + F.col("id") % 1000).alias("event_time"))
    g = R.windowed_group_chunks(df, 1000, 1000, length=length, element=F.struct("counter"))
    rows = g.select("chunk", "n_chunks", "n_events", F.element_at("events", 1)["counter"].alias("first"),
                    F.element_at("events", -1)["counter"].alias("last"),
                    F.aggregate("events", F.lit(0).cast("long"), lambda s, e: s + e["counter"]).alias("total")).collect()
    assert sorted((r.chunk, r.n_chunks, r.n_events, r.first, r.last) for r in rows) == [
        (c, 100, length, c * length, c * length + length - 1) for c in range(100)]
    assert sum(r.total for r in rows) == n * (n - 1) // 2


def test_equal_rows_and_no_offsets(spark):
    """Redelivered records: equal in every column, still cut by position."""
    df = spark.createDataFrame([("k", 5, BASE)] * 100, "key string, counter long, ms long").select(
        "key", "counter", F.timestamp_millis("ms").alias("event_time"))
    got = R.windowed_group_chunks(df.repartition(4), 1000, 1000, length=30, element=F.struct("counter")).collect()
    assert sorted((r.chunk, r.n_events) for r in got) == [(0, 30), (1, 30), (2, 30), (3, 10)]
    assert R.windowed_group_chunks(df.limit(0), 1000, 1000, element=F.struct("counter")).collect() == []


def test_producers_that_take_turns(spark):
    """Eight producers in turn on one partition: each key's offsets are equal modulo 8, which a
    hash of the place does not see; chunks and pieces stay bounded too."""
    rows = [(f"p{i % 8}", i, 10, 0, i) for i in range(4000)]
    parts = R.windowed_group(frame(spark, rows), 1000, 1000, element=element()).collect()
    assert max(r.n_events for r in parts) < 2 * 500 / R.GROUP_PARTS
    chunks = R.windowed_group_chunks(frame(spark, rows), 1000, 1000, length=64, element=element()).collect()
    assert max(r.n_events for r in chunks) == 64 and sum(r.n_events for r in chunks) == 4000
    pieces = R.windowed_group_pieces(frame(spark, rows), 1000, 1000, block=256, element=element()).collect()
    assert max(r.n_events for r in pieces) == 32 and sum(r.n_events for r in pieces) == 4000


def test_pieces_are_the_list_in_topic_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(2000), i % 3, i // 3) for i in range(600)]
    want = brute(rows, 1000, 500)
    pieces = R.windowed_group_pieces(frame(spark, rows).repartition(4), 1000, 500, block=16, element=element())
    got = lists(pieces, "part", "sequence")
    assert {k: sorted(tuple(e) for r in v for e in r.events) for k, v in got.items()} == want
    for v in got.values():
        assert all(r.n_events <= 16 and {(e.partition, e.offset // 16) for e in r.events} == {(r.part, r.sequence)} for r in v)
        for p in range(3):
            own = [e.offset for r in v if r.part == p for e in r.events]
            assert own == sorted(own)
    whole = lists(R.assemble_groups(pieces, length=10), "chunk")
    assert {k: [tuple(e) for r in v for e in r.events] for k, v in whole.items()} == want
    assert all(r.n_events == 10 for v in whole.values() for r in v[:-1])


def _written(folder):
    """{batch: bytes of state written in it} of a query's checkpoint."""
    out = defaultdict(int)
    for f in glob.glob(f"{folder}/state/0/*/*.changelog"):
        out[int(os.path.basename(f).split(".")[0].split("_")[0])] += os.path.getsize(f)
    return out


def test_state_written_per_batch_does_not_grow(spark, tmp_path):
    """One hot group that 6 batches of 400 records each add to."""
    for i in range(6):
        frame(spark, [("hot", 400 * i + k, 100 * i + k // 4, 0, 400 * i + k) for k in range(400)]).coalesce(1).write.parquet(
            str(tmp_path / f"in/{i}"))
    wrote, shapes = {}, {}
    for name, make in (("list", lambda s: R.windowed_group(s, 5000, 5000, parts=1, element=element())),
                       ("pieces", lambda s: R.windowed_group_pieces(s, 5000, 5000, block=200, element=element()))):
        src = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in/0")).schema).option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in")).withWatermark("event_time", "0 seconds"))
        q = start_stream(make(src), sink="noop", checkpoint=str(tmp_path / name), available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        sizes = _written(tmp_path / name)
        wrote[name] = [sizes[v] for v in sorted(sizes)][:6]
        shapes[name] = max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators)
    assert shapes == {"list": 1, "pieces": 12}
    assert wrote["list"][5] > 3 * wrote["list"][0]             # the whole list, every time
    assert wrote["pieces"][5] < 1.3 * wrote["pieces"][0]       # what the batch added


def test_stream_pieces_equal_batch_pieces(spark, tmp_path):
    rows = [(f"k{i % 3}", i, 40 * i, i % 2, i // 2) for i in range(200)]
    for i in range(4):
        frame(spark, rows[50 * i:50 * i + 50]).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    frame(spark, [("end", 999, 60_000, 0, 999)]).write.parquet(str(tmp_path / "in/9"))
    src = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in/0")).schema).option("recursiveFileLookup", "true")
           .parquet(str(tmp_path / "in")).withWatermark("event_time", "0 seconds"))
    q = start_stream(R.windowed_group_pieces(src, 1000, 250, block=20, element=element()), sink="memory",
                     query_name="pieces_mem", available_now=True)
    q.awaitTermination()
    got = sorted(map(str, spark.sql("SELECT * FROM pieces_mem").collect()))
    want = R.windowed_group_pieces(frame(spark, rows), 1000, 250, block=20, element=element())
    assert got == sorted(map(str, want.collect())) and got
