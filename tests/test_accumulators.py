"""Stored accumulators: merged runs equal one run; a stream keeps panes only."""

import random

import pytest
from pyspark.sql import functions as F

from sessionrate.operators import accumulators as A
from sessionrate.operators import rates as R
from sessionrate.streaming.runner import start_stream

BASE = 1704067200000


def frame(spark, rows):
    df = spark.createDataFrame(rows, "session string, type string, ms long, millis long")
    return df.select("session", "type", F.struct("millis").alias("frame"),
                     F.timestamp_millis(F.lit(BASE) + F.col("ms")).alias("event_time")).repartition(4)


def events(n=600, seed=1):
    rng = random.Random(seed)
    return [(rng.choice(["a", "b", "c", None]), rng.choice(["move", "killed", "KILLED", "hit", None]), rng.randrange(20_000),
             rng.choice([None, rng.randrange(1000)])) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_any_split_merges_to_one_run(spark, cut):
    data = events()
    for aggs in (A.rate_aggs("killed", "move"), A.span_aggs()):
        parts = [A.accumulate(frame(spark, data[i::cut]), aggs, 500) for i in range(cut)]
        whole = A.accumulate(frame(spark, data), aggs, 500)
        assert rows(A.merge(aggs, *parts)) == rows(whole)
        assert rows(A.finish(A.merge(aggs, *parts), aggs, 3000, 500)) == rows(A.finish(whole, aggs, 3000, 500))
        again = A.merge(aggs, A.merge(aggs, *parts[:1]), *parts[1:])     # in any order, in any grouping
        assert rows(again) == rows(whole)


def test_finished_windows_equal_the_rates(spark):
    df, aggs = frame(spark, events()), A.rate_aggs("killed", "move")
    windows = A.finish(A.accumulate(df, aggs, 500), aggs, 3000, 500)
    assert rows(A.rate_of(windows, "killed", 3000)) == rows(R.event_rate(df, "killed", 3000, 500))
    assert rows(A.activity_of(windows, 3000)) == rows(R.session_activity(df, 3000, 500))


def test_finer_panes_serve_several_windows(spark):
    df, aggs = frame(spark, events()), A.rate_aggs("killed")
    panes = A.accumulate(df, aggs, 100)
    for width, slide in ((3000, 500), (1000, 100), (2000, 2000)):
        assert rows(A.rate_of(A.finish(panes, aggs, width, slide), "killed", width)) == rows(R.event_rate(df, "killed", width, slide))
    with pytest.raises(ValueError, match="multiple of the slide"):
        A.finish(panes, aggs, 1000, 300)


def test_no_events(spark):
    aggs = A.span_aggs()
    none = A.accumulate(frame(spark, []), aggs, 500)
    assert rows(A.finish(A.merge(aggs, none, none), aggs, 3000, 500)) == []
    one = A.accumulate(frame(spark, events(20)), aggs, 500)
    assert rows(A.merge(aggs, one, none)) == rows(one)


def test_a_stream_keeps_panes_only(spark, tmp_path):
    """One session, a record every 10 ms: state rows and bytes of both plans, and equal windows."""
    data = [("a", ("move", "killed", "hit")[k % 3], 10 * k, k) for k in range(300)]
    for i in range(3):
        frame(spark, data[100 * i:100 * i + 100]).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))

    def run(make, name):
        src = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in/0")).schema).option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in")).withWatermark("event_time", "0 seconds"))
        q = start_stream(make(src), sink="parquet", path=str(tmp_path / name), checkpoint=str(tmp_path / f"{name}-ckpt"),
                         available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        ops = [op for p in q.recentProgress for op in p.stateOperators]
        return q, max(op.numRowsTotal for op in ops), sum(op.numRowsUpdated for op in ops)

    aggs = A.rate_aggs("move", "killed")
    q, rows_panes, updates_panes = run(lambda s: A.accumulate(s, aggs, 25), "panes")
    _, rows_direct, updates_direct = run(lambda s: R.session_activity(s, 1000, 25), "direct")
    panes = spark.read.parquet(str(tmp_path / "panes"))
    got = rows(A.activity_of(A.finish(panes, aggs, 1000, 25, A.watermark_ms(q)), 1000))
    assert got == rows(spark.read.parquet(str(tmp_path / "direct"))) and len(got) > 100
    assert A.watermark_ms(q) == BASE + 2990
    assert rows_panes * 1.9 < rows_direct and updates_panes * 1.5 < updates_direct


def test_state_of_many_sparse_sessions(spark, tmp_path):
    """One record a session: 1 state row each instead of 40."""
    frame(spark, [(f"s{i}", "move", i % 20, i) for i in range(500)]).coalesce(1).write.parquet(str(tmp_path / "in/0"))
    src = (spark.readStream.schema(spark.read.parquet(str(tmp_path / "in/0")).schema).parquet(str(tmp_path / "in/0"))
           .withWatermark("event_time", "0 seconds"))
    sizes = {}
    for name, df in (("panes", A.accumulate(src, A.rate_aggs("move", "killed"), 25)), ("direct", R.session_activity(src, 1000, 25))):
        q = start_stream(df, sink="noop", checkpoint=str(tmp_path / name), available_now=True)
        q.awaitTermination()
        sizes[name] = max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators)
    assert sizes == {"panes": 500, "direct": 20_000}
