"""Metric -> sentence transform and its number formatting."""

import random
import struct

from pyspark.sql import functions as F

from sessionrate.functions.formatting import fmt3
from sessionrate.operators.metrics import (feedback_checked, feedback_rejects, metric_feedback, metric_name,
                                            to_kafka_record)


def _records(spark, texts):
    return spark.createDataFrame([("a", t) for t in texts], "key string, value string")


def test_sentences_of_fixtures(spark):
    texts = ['{"session":"a","metric":"killed per second","value":0.6666666666666666}',
             '{"session":"a","metric":"killed per second","value":1.0005}',
             '{"session":"a","metric":"m","value":0.0005}',
             '{"session":"a","metric":"m","value":3}']
    out = [r.value.decode() for r in metric_feedback(_records(spark, texts)).collect()]
    assert out == ["Your killed per second is 0.667.", "Your killed per second is 1.000.",
                   "Your m is 0.001.", "Your m is 3.000."]


def test_rejects(spark):
    texts = ['{"session":"a","metric":"m","value":"1.5"}', '{"session":"a","metric":"m"}',
             '{"session":5,"metric":"m","value":1}', '', '{"session":"a","metric":"m","value":null}',
             '{"session":"a","metric":"m","value":1e400}', '{"session":"a","metric":"m","value":1}x',
             '[{"session":"a","metric":"m","value":1}]', 'nope']
    checked = feedback_checked(_records(spark, texts)).collect()
    assert all(r.sentence is None and r.reject_reason for r in checked)
    assert metric_feedback(_records(spark, texts)).count() == 0
    bad = feedback_rejects(_records(spark, texts)).collect()
    assert sorted(r.value for r in bad) == sorted(texts)
    reasons = {r.value: r.reject_reason for r in bad}
    assert [reasons[t] for t in texts] == ["value", "value", "session", "empty", "value", "value",
                                           "not an object", "not an object", "not an object"]


def test_long_records_are_no_rejects_unless_asked(spark):
    text = '{"session":"a","metric":"m","value":1,"note":"' + "x" * 5000 + '"}'
    assert metric_feedback(_records(spark, [text])).first().value == b"Your m is 1.000."
    long_name = '{"session":"a","metric":"' + "x" * 90 + '","value":1}'
    checked = feedback_checked(_records(spark, [text, long_name]), max_bytes=100).collect()
    assert [r.reject_reason for r in checked] == ["too big", "too big"]


def test_metric_names_follow_the_unit():
    assert [metric_name("killed", u) for u in (1000, 60_000, 3_600_000, 250)] == [
        "killed per second", "killed per minute", "killed per hour", "killed per 250 ms"]


def test_headers_and_key_copied(spark):
    m = spark.createDataFrame([("s1", 100, 200, "killed per second", 0.5)],
                              "session string, window_start_ms long, window_end_ms long, metric string, value double")
    out = metric_feedback(to_kafka_record(m, window_headers=True)).collect()[0]
    assert out.key == b"s1" and out.value == b"Your killed per second is 0.500."
    assert [(h.key, bytes(h.value)) for h in out.headers] == [("window_start_ms", b"100"), ("window_end_ms", b"200")]


def test_fmt3_matches_exact_rounding(spark):
    random.seed(7)
    vals = [0.0005, -0.0005, 1.0005, 2.6665, 12345.6785, 2.0005, 0.0, -0.0001, 1e15 + 0.5]
    vals += [random.randint(-10**6, 10**6) / 2000.0 for _ in range(3000)]
    vals += [random.uniform(-5, 5) for _ in range(3000)]
    vals += [struct.unpack("d", struct.pack("Q", random.getrandbits(62)))[0] for _ in range(500)]
    vals = [v for v in vals if v == v and abs(v) < 1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    got = {r.i: r.s for r in df.select("i", fmt3(F.col("x")).alias("s")).collect()}
    assert all(got[i] == "%.3f" % v for i, v in enumerate(vals))
