"""A batch that fails after its write is given again and leaves nothing twice."""

import json

import pytest

from sessionrate.plans import deploy
from sessionrate.plans import jobs as J
from sessionrate.streaming import sinks

from test_deploy import FIRST, LAST, SCHEMA, SECOND, add_file, read_lines, run, stream


class Crash:
    """A writer that fails in its first attempt at each of the given batches."""

    def __init__(self, *batches):
        self.left, self.seen = set(batches), []

    def __call__(self, batch, batch_id):
        self.seen.append(batch_id)
        if batch_id in self.left:
            self.left.remove(batch_id)
            raise RuntimeError("crash after the write")


def go(spark, tmp_path, crash, parts):
    """Start as often as it takes; the number of failures."""
    failures = 0
    while True:
        q = deploy.start_kill_rate(spark, str(tmp_path / "ckpt"), "0 seconds", records=stream(spark, tmp_path / "in"),
                                   log=False, log_path=str(tmp_path / "log"),
                                   extra_writers=[sinks.batch_writer(str(tmp_path / "table"), str(tmp_path / "ckpt")), *parts, crash],
                                   available_now=True)
        try:
            run(q)
            return failures
        except Exception as e:  # noqa: BLE001
            assert "crash after the write" in str(e)
            failures += 1


def test_no_line_twice_after_a_crash(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, rows in enumerate((FIRST, SECOND, LAST)):
        add_file(tmp_path / "in", i, rows)
    crash = Crash(1, 2)
    added = lambda b, i: sinks.log_lines(b, "", str(tmp_path / "added"))
    assert go(spark, tmp_path, crash, [added]) == 2
    assert crash.seen.count(1) == 2 and crash.seen.count(2) == 2
    want = J.kill_rate_job(spark.createDataFrame(FIRST + SECOND, SCHEMA))
    lines = read_lines(tmp_path / "log")
    assert len(lines) == len(set(lines)) == want.count()
    table = spark.read.parquet(str(tmp_path / "table")).drop("run", "batch_id")
    assert table.count() == want.count() and table.select(want.columns).exceptAll(want).count() == 0
    once_more = read_lines(tmp_path / "added")                  # what a plain append leaves
    assert len(once_more) > len(set(once_more)) == want.count()
    assert {json.loads(x)["metric"] for x in lines} == {"killed per second"}


def test_a_failed_attempt_that_wrote_more_is_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_batch(spark.range(100).repartition(7), out, 3, "job")
    sinks.write_batch(spark.range(10), out, 3, "job")
    sinks.write_batch(spark.range(5), out, 4, "job")
    sinks.write_batch(spark.range(2), out, 3, "another job")    # started over: a run of its own
    got = spark.read.parquet(out).groupBy("run", "batch_id").count().collect()
    assert sorted((r.batch_id, r["count"]) for r in got) == [(3, 2), (3, 10), (4, 5)] and len({r.run for r in got}) == 2
    sinks.write_batch(spark.range(0), out, 4, "job")            # an empty batch replaces too
    assert spark.read.parquet(sinks.batch_folder(out, 4, "job")).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_batches_in_other_formats(spark, tmp_path, fmt):
    sinks.batch_writer(str(tmp_path), fmt=fmt)(spark.range(3), 0)
    assert spark.read.format(fmt).load(str(tmp_path)).count() == 3
