"""Late records are counted once each, whatever the fan-out of their windows."""

import datetime as dt
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sessionrate.operators import rates as R
from sessionrate.plans import deploy
from sessionrate.plans import jobs as J
from sessionrate.streaming.runner import LateRows, start_stream
from sessionrate.streaming.watermarks import LATE_SPREAD, with_late_records

T0 = dt.datetime(2024, 1, 1)


def _records(spark, folder, batches):
    """One file, hence one micro-batch, per list of (milliseconds, session)."""
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        recs = [{"key": s, "value": json.dumps({"session": s, "counter": ms, "type": "killed",
                                                "actor": {"type": "player"}}),
                 "timestamp": T0 + dt.timedelta(milliseconds=ms)} for ms, s in rows]
        path = os.path.join(folder, f"batch-{i}.parquet")
        pq.write_table(pa.Table.from_pylist(recs), path)
        os.utime(path, (now + 10 * i, now + 10 * i))
    return (spark.readStream.schema("key string, value string, timestamp timestamp")
            .option("maxFilesPerTrigger", "1").parquet(str(folder)))


def _stream(spark, folder, batches):
    return J.decoded_events(_records(spark, folder, batches), watermark="0 seconds")


def _run(spark, df, name):
    late = LateRows.attach(spark)
    try:
        q = start_stream(df, sink="memory", query_name=name, available_now=True)
        q.awaitTermination()
        assert q.exception() is None
        counts = late.records(q), late.total(q)
        states = [op for p in q.recentProgress for op in p.stateOperators if op.operatorName == LateRows.RECORDS]
        return counts, max((op.numRowsTotal for op in states), default=0)
    finally:
        spark.streams.removeListener(late)


def _rows(spark, name):
    return sorted(map(tuple, spark.sql(f"SELECT * FROM {name}").collect()))


@pytest.mark.parametrize("width, slide", [(1000, 25), (3000, 500), (1000, 1000)])
def test_ten_late_records_count_ten(spark, tmp_path, width, slide):
    # records are late by the watermark of the micro-batch before: 60,000 ms for the fourth
    batches = [[(100, "a"), (600, "b")], [(60_000, "a")], [(60_001, "b")],
               [(100 + 7 * (i % 4), "abc"[i % 3]) for i in range(10)] + [(60_000 - slide // 2, "a")], [(120_000, "z")]]
    if width == slide:
        batches[3][-1] = (60_001, "a")                  # else: late for the windows that have closed only
    events = _stream(spark, tmp_path, batches)
    rates = R.event_rate(events, "killed", width, slide)
    name = f"late_records_{width}_{slide}"
    (records, pairs), _ = _run(spark, with_late_records(rates, events, width, slide), name)
    assert records == 10
    assert pairs != 10 and pairs > 0                    # what the aggregation itself reports
    _run(spark, rates, name + "_plain")
    assert _rows(spark, name) == _rows(spark, name + "_plain") != []


def test_state_hangs_on_open_slides_and_not_on_records(spark, tmp_path):
    events = _stream(spark, tmp_path, [[(i % 50, f"s{i}") for i in range(3000)], [(10_000, "z")]])
    rates = R.event_rate(events, "killed", 1000, 25)
    (records, pairs), most = _run(spark, with_late_records(rates, events, 1000, 25), "late_state")
    assert (records, pairs) == (0, 0)
    assert 0 < most <= 3 * LATE_SPREAD                  # slides at 0, 25 and 10,000 ms


def test_without_late_records_nothing_is_counted(spark, tmp_path):
    events = _stream(spark, tmp_path, [[(100, "a")], [(5000, "a")], [(9000, "b")]])
    rates = R.event_rate(events, "killed", 1000, 250)
    (records, _), _ = _run(spark, with_late_records(rates, events, 1000, 250), "late_none")
    assert records == 0


def test_the_kill_rate_job_counts_its_late_records(spark, tmp_path):
    folder, rows = tmp_path / "in", []
    folder.mkdir()
    records = _records(spark, folder, [[(100, "a")], [(60_000, "a")], [(60_001, "a")], [(200, "a"), (300, "b")], [(90_000, "z")]])
    late = LateRows.attach(spark)
    try:
        q = deploy.start_kill_rate(spark, str(tmp_path / "ckpt"), "0 seconds", records=records, log=False, available_now=True,
                                   count_late=True, extra_writers=[lambda b, i: rows.extend(b.collect())])
        q.awaitTermination()
        assert q.exception() is None and late.records(q) == 2
    finally:
        spark.streams.removeListener(late)
    assert rows and all(r.session is not None and r.value is not None for r in rows)
