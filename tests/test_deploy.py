"""Deployed jobs on file streams: restart, complete log, rejects, order, all start functions."""

import datetime as dt
import glob
import json
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sessionrate.operators import metrics as M
from sessionrate.operators import rates as R
from sessionrate.plans import deploy
from sessionrate.plans import jobs as J
from sessionrate.plans.queries import SCALED, _kill_metrics
from sessionrate.sources import kafka as K
from sessionrate.sources.adapter import game_records
from sessionrate.streaming import runner, sinks

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)
SCHEMA = "key string, value string, timestamp timestamp"


def event(ms, session="a", kind="killed", text=None):
    value = text or json.dumps({"session": session, "counter": ms, "type": kind, "actor": {"type": "player"}})
    return {"key": session, "value": value, "timestamp": T0 + dt.timedelta(milliseconds=ms)}


def add_file(folder, number, rows):
    path = os.path.join(folder, f"part-{number}.parquet")
    pq.write_table(pa.Table.from_pylist(rows), path)
    at = time.time() - 1000 + 10 * number
    os.utime(path, (at, at))


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(str(folder))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def read_lines(path):
    return [line for f in glob.glob(f"{path}/**/part-*", recursive=True) for line in open(f).read().splitlines()]


FIRST = [event(i * 40, "ab"[i % 2], "killed" if i % 3 == 0 else "move") for i in range(100)]
SECOND = [event(4000 + i * 40, "ab"[i % 2], "killed" if i % 3 == 0 else "move") for i in range(100)]
LAST = [event(60_000, "z", "move")]


def test_a_restarted_job_goes_on_where_it_stopped(spark, tmp_path):
    """Stop, add a file, start again on the same checkpoint: the uninterrupted result."""
    for name in ("stopped", "whole"):
        (tmp_path / name).mkdir()
        add_file(tmp_path / name, 0, FIRST)
    for n, rows in ((1, SECOND), (2, LAST)):
        add_file(tmp_path / "whole", n, rows)

    def start(name):
        return deploy.start_kill_rate(spark, str(tmp_path / f"{name}-ckpt"), "0 seconds",
                                      records=stream(spark, tmp_path / name), log=False,
                                      log_path=str(tmp_path / f"{name}-out"), available_now=True)

    run(start("whole"))
    run(start("stopped"))
    before = read_lines(tmp_path / "stopped-out")
    run(start("stopped"))                                       # nothing new: nothing again
    assert read_lines(tmp_path / "stopped-out") == before
    for n, rows in ((1, SECOND), (2, LAST)):
        add_file(tmp_path / "stopped", n, rows)
    run(start("stopped"))
    whole = sorted(read_lines(tmp_path / "whole-out"))
    assert sorted(read_lines(tmp_path / "stopped-out")) == whole
    assert len(whole) == len(set(whole)) > len(before) + 20 > 20
    batch = J.kill_rate_job(spark.createDataFrame(FIRST + SECOND, SCHEMA))
    assert len(whole) == batch.count()


def test_every_metric_is_logged(spark, tmp_path, capfd):
    (tmp_path / "in").mkdir()
    add_file(tmp_path / "in", 0, FIRST + LAST)
    add_file(tmp_path / "in", 1, LAST)
    run(deploy.start_kill_rate(spark, str(tmp_path / "ckpt"), "0 seconds", records=stream(spark, tmp_path / "in"),
                               log=False, log_path=str(tmp_path / "log"), available_now=True))
    lines = read_lines(tmp_path / "log")
    want = J.kill_rate_job(spark.createDataFrame(FIRST, SCHEMA)).count()
    assert len(lines) == want > 20 and all(json.loads(x)["metric"] == "killed per second" for x in lines)
    sinks.log_lines(spark.range(50).repartition(3), "row ")
    sinks.log_lines(spark.range(50), "row ", str(tmp_path / "rows"))
    assert sorted(read_lines(tmp_path / "rows")) == sorted(f'row {{"id":{i}}}' for i in range(50))


def test_a_kept_result_needs_a_checkpoint(spark, tmp_path):
    rows = spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("value"))
    with pytest.raises(ValueError, match="checkpoint"):
        runner.start_stream(rows, sink="text", path=str(tmp_path / "out"))
    with pytest.raises(ValueError, match="checkpoint"):
        sinks.fan_out(rows, [print], checkpoint=None)
    with pytest.raises(TypeError):
        deploy.start_kill_rate(spark)                           # no checkpoint, no watermark


def test_other_jobs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    add_file(tmp_path / "in", 0, FIRST + SECOND)
    add_file(tmp_path / "in", 1, LAST)
    batch = J.decoded_events(spark.createDataFrame(FIRST + SECOND, SCHEMA))

    def start(f, name, **how):
        run(f(spark, checkpoint=str(tmp_path / f"{name}-ckpt"), watermark="0 seconds",
              records=stream(spark, tmp_path / "in"), available_now=True, **how))

    start(deploy.start_fine_rates, "fine", log=False, log_path=str(tmp_path / "fine"))
    got = spark.read.json(str(tmp_path / "fine"))
    want = J.fine_rates_job(None, events=batch)
    assert got.count() == want.count() > 0
    assert got.select(sorted(want.columns)).exceptAll(want.select(sorted(want.columns))).count() == 0
    seen = []
    start(deploy.start_move_rate, "move", log=False, extra_writers=[lambda b, i: seen.extend(b.collect())])
    want = J.move_rate_job(None, events=batch)
    assert sorted(map(str, seen)) == sorted(map(str, want.collect()))
    start(deploy.start_groups, "groups", path=str(tmp_path / "groups"), parts=2)
    groups = J.grouped_job(None, parts=2, events=batch)
    assert sorted(read_lines(tmp_path / "groups")) == sorted(r.value for r in R.windowed_group_text(groups).collect())
    start(deploy.start_fine_rates, "discard", log=False)        # no sink: computed and discarded


BAD = [event(10, text="{bad"), event(20, text=event(20)["value"] + " more"),
       event(30, text='{"session":"a","counter":"30","type":"killed","actor":{"type":"player"}}'),
       event(40, text='{"session":"a","counter":4.5,"type":"killed","actor":{"type":"player"}}')]


def test_rejects_are_routed_and_never_counted(spark, tmp_path):
    rows = FIRST + BAD
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.value for r in J.rejected_records(df).collect()) == sorted(r["value"] for r in BAD)
    clean = J.kill_rate_job(spark.createDataFrame(FIRST, SCHEMA))
    assert J.kill_rate_job(df).exceptAll(clean).count() == 0 and J.kill_rate_job(df).count() == clean.count()
    (tmp_path / "in").mkdir()
    add_file(tmp_path / "in", 0, rows)
    run(deploy.start_rejects(spark, str(tmp_path / "ckpt"), path=str(tmp_path / "bad"),
                             records=stream(spark, tmp_path / "in"), available_now=True))
    assert sorted(json.loads(x)["value"] for x in read_lines(tmp_path / "bad")) == sorted(r["value"] for r in BAD)
    metrics = [{"key": "a", "value": v, "timestamp": T0} for v in
               ('{"session":"a","metric":"m","value":1}', '{"session":"a","metric":"m","value":1e400}', "x")]
    (tmp_path / "metrics").mkdir()
    add_file(tmp_path / "metrics", 0, metrics)
    run(deploy.start_feedback_rejects(spark, str(tmp_path / "ckpt2"), path=str(tmp_path / "bad2"),
                                      records=stream(spark, tmp_path / "metrics"), available_now=True))
    got = {json.loads(x)["value"]: json.loads(x)["reject_reason"] for x in read_lines(tmp_path / "bad2")}
    assert got == {metrics[1]["value"]: "value", "x": "not an object"}


def test_one_writer_per_session_in_window_order(spark):
    metrics = _kill_metrics(spark, SF, *SCALED["kill"])
    seen = M.in_session_order(metrics).withColumn("writer", F.spark_partition_id()).collect()
    writers, last = {}, {}
    for r in seen:                                              # rows come in task order
        writers.setdefault(r.session, set()).add(r.writer)
        assert last.get(r.session, -1) < r.window_start_ms
        last[r.session] = r.window_start_ms
    assert all(len(w) == 1 for w in writers.values()) and len(seen) == metrics.count()
    raw = metrics.withColumn("writer", F.spark_partition_id()).groupBy("session").agg(
        F.count_distinct("writer").alias("n"))
    assert raw.agg(F.max("n")).first()[0] >= 1


def test_watermark_delay_covers_a_lagging_partition(spark, tmp_path):
    """Two topic partitions, one 5 s behind: without a delay its records are late."""
    ahead = [event(10_000 + i * 100, "ahead") for i in range(10)]
    behind = [event(5000 + i * 100, "behind") for i in range(10)]
    (tmp_path / "in").mkdir()
    for n, rows in enumerate((ahead, [event(11_500, "ahead")], behind, LAST, LAST)):
        add_file(tmp_path / "in", n, rows)
    found = {}
    for delay in ("0 seconds", "6 seconds"):
        late = runner.LateRows.attach(spark)
        out = str(tmp_path / delay[0])
        q = deploy.start_kill_rate(spark, str(tmp_path / f"ckpt{delay[0]}"), delay, log=False, log_path=out,
                                   records=stream(spark, tmp_path / "in"), available_now=True)
        run(q)
        found[delay] = ({json.loads(x)["session"] for x in read_lines(out)}, late.total(q) > 0)
        spark.streams.removeListener(late)
    assert found == {"0 seconds": ({"ahead"}, True), "6 seconds": ({"ahead", "behind"}, False)}


def test_default_sink_options():
    opts = deploy._sink_options(None, "metrics", K.METRICS_TOPIC)
    assert opts["topic"] == "metrics" and opts["kafka.bootstrap.servers"] == K.DEFAULT_BROKERS
    opts = deploy._sink_options({"kafka.bootstrap.servers": "b:1"}, None, K.FEEDBACK_TOPIC)
    assert opts["topic"] == K.FEEDBACK_TOPIC and opts["kafka.bootstrap.servers"] == "b:1"


def test_bucketed_plan_gives_the_same_rates(spark):
    ev = R.filter_actor_type(J.decoded_events(game_records(spark, SF)), "player")
    for width, slide in ((1000, 25), (3000, 500), SCALED["fine"]):
        how = dict(width_ms=width, slide_ms=slide)
        direct, bucketed = (R.event_rate(ev, "killed", plan=p, **how) for p in ("direct", "bucketed"))
        assert direct.count() == bucketed.count() > 0
        assert direct.exceptAll(bucketed).count() == 0 and bucketed.exceptAll(direct).count() == 0


@pytest.mark.parametrize("plan", ["panes", "bucketed"])
def test_plans_that_do_not_apply_are_refused(spark, plan):
    ev = spark.createDataFrame([("a", T0, "killed")], "session string, event_time timestamp, type string")
    with pytest.raises(ValueError):
        R.event_rate(ev, "killed", 1000, 300, plan=plan)
    with pytest.raises(ValueError):
        R.event_rate(ev, "killed", plan="other")


def test_no_folder_of_the_drivers_on_a_cluster():
    from sessionrate.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_sizing():
    from sessionrate.session import sizing
    assert sizing(10e12, 4000)["spark.sql.shuffle.partitions"] == str(-(-int(10e12) // (128 << 20)))
    assert sizing(0, 8)["spark.sql.shuffle.partitions"] == "16"
