"""Kafka options, sinks and fan-out (no broker here: Kafka reads/writes are not run)."""

import os
import tempfile

import pytest

from sessionrate.plans import jobs as J
from sessionrate.plans.queries import SCALED, _stream_events
from sessionrate.sources.kafka import jaas_config, kafka_options, security_protocol
from sessionrate.streaming import sinks


def test_security_protocol_matrix():
    assert security_protocol(False, None) == "PLAINTEXT"
    assert security_protocol(True, None) == "SSL"
    assert security_protocol(False, "u") == "SASL_PLAINTEXT"
    assert security_protocol(True, "u") == "SASL_SSL"


def test_reader_and_writer_options():
    r = kafka_options("b:9092", "events", "u", "p", "scram-sha-256", use_tls=True, min_partitions=16)
    assert r["kafka.bootstrap.servers"] == "b:9092" and r["subscribe"] == "events"
    assert r["kafka.security.protocol"] == "SASL_SSL" and r["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert r["kafka.sasl.jaas.config"].startswith("org.apache.kafka.common.security.scram.ScramLoginModule required ")
    assert 'username="u" password="p";' in r["kafka.sasl.jaas.config"]
    assert r["startingOffsets"] == "latest" and r["minPartitions"] == "16"
    g = kafka_options("b:9092", "events", group_id_prefix="kill-rate", client_id_prefix="kr")
    assert g["groupIdPrefix"] == "kill-rate" and g["kafka.client.id"] == "kr"
    assert "group.instance.id" not in r and "auto.offset.reset" not in r
    assert "failOnDataLoss" not in r                       # Spark's default: lost offsets fail
    assert kafka_options("b", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    w = kafka_options("b:9092", "out", None, None, for_writer=True)
    assert w == {"kafka.bootstrap.servers": "b:9092", "kafka.security.protocol": "PLAINTEXT", "topic": "out"}
    assert " required username=" in jaas_config("PLAIN", "a", "b")
    with pytest.raises(ValueError):
        jaas_config("GSSAPI", "a", "b")


def test_stream_fan_out_to_two_sinks(spark):
    ev = _stream_events(spark, "/root/testdata/sf0.001")
    metrics = J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1], events=ev)
    a, b = tempfile.mkdtemp(prefix="fan-a-"), tempfile.mkdtemp(prefix="fan-b-")
    writers = [lambda df, i: df.write.mode("append").parquet(a),
               lambda df, i: df.select("session").write.mode("append").parquet(b)]
    q = sinks.fan_out(metrics, writers, checkpoint=tempfile.mkdtemp(prefix="fan-ckpt-"), available_now=True)
    q.awaitTermination()
    n_a = spark.read.parquet(a).count()
    assert n_a > 0 and n_a == spark.read.parquet(b).count()


def test_group_text_sink(spark):
    from sessionrate.operators import rates as R
    from sessionrate.plans.queries import _events
    g = J.grouped_job(None, *SCALED["group"], events=_events(spark, "/root/testdata/sf0.001"))
    path = os.path.join(tempfile.mkdtemp(prefix="groups-"), "out")
    sinks.write_text(R.windowed_group_text(g), path)
    lines = spark.read.text(path)
    assert lines.count() == g.count()
    first = spark.read.json(path).first()
    assert first["key"].startswith("k") and len(first["events"]) >= 1


def test_echo_prefix(spark):
    df = spark.createDataFrame([("s", 1.5)], "session string, value double")
    assert sinks.echo(df, "kills: ").first().value == 'kills: {"session":"s","value":1.5}'


def test_deploy_entry_points_on_a_file_stream(spark):
    """The deployment wiring (source watermark, fan-out, echo) on a file stream, and the
    feedback job reading the metric records the first one produced."""
    from sessionrate.operators.metrics import to_kafka_record
    from sessionrate.plans import deploy
    from sessionrate.sources.adapter import events_to_records
    from sessionrate.streaming.runner import parquet_file_stream
    stream = parquet_file_stream(spark, "/root/testdata/sf0.001", "events.parquet")
    out = tempfile.mkdtemp(prefix="deploy-metrics-")
    q = deploy.start_kill_rate(spark, tempfile.mkdtemp(prefix="ckpt-"), "0 seconds",
                               records=events_to_records(stream), log=False,
                               extra_writers=[lambda b, i: to_kafka_record(b).write.mode("append").parquet(out)],
                               available_now=True)
    q.awaitTermination()
    n = spark.read.parquet(out).count()
    assert n > 0
    fb_out = tempfile.mkdtemp(prefix="deploy-feedback-")
    metric_stream = spark.readStream.schema(spark.read.parquet(out).schema).parquet(out)
    q2 = deploy.start_feedback(spark, tempfile.mkdtemp(prefix="ckpt-"), records=metric_stream, available_now=True,
                               writer=lambda b, i: b.write.mode("append").parquet(fb_out))
    q2.awaitTermination()
    sentences = spark.read.parquet(fb_out)
    assert sentences.count() == n
    assert sentences.first().value.decode().startswith("Your killed per second is ")


def test_batch_kafka_read_bounds_offsets(spark, monkeypatch):
    """A batch read turns the stream default 'latest' into earliest..latest."""
    from sessionrate.sources import kafka as K
    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def load(self):
            return "loaded"

    class FakeSpark:
        read = Reader()
        readStream = Reader()

    assert K.read_kafka(FakeSpark(), kafka_options(), streaming=False) == "loaded"
    assert seen["startingOffsets"] == "earliest" and seen["endingOffsets"] == "latest"
    seen.clear()
    K.read_kafka(FakeSpark(), kafka_options(), streaming=True, include_headers=True)
    assert seen["startingOffsets"] == "latest" and "endingOffsets" not in seen
    assert seen["includeHeaders"] == "true"


def test_stream_group_text_sink(spark):
    """The grouped-events job end to end as a stream: one JSON text line per closed group."""
    from sessionrate.operators import rates as R
    g = J.grouped_job(None, *SCALED["group"], events=_stream_events(spark, "/root/testdata/sf0.001"))
    path = os.path.join(tempfile.mkdtemp(prefix="stream-groups-"), "out")
    with pytest.raises(ValueError, match="checkpoint"):
        sinks.write_text(R.windowed_group_text(g), path, available_now=True)
    q = sinks.write_text(R.windowed_group_text(g), path, tempfile.mkdtemp(prefix="ckpt-"), available_now=True)
    q.awaitTermination()
    lines = spark.read.json(path)
    assert lines.count() > 0
    row = lines.orderBy("window_start_ms").first()
    assert row["n_parts"] == R.GROUP_PARTS and 0 <= row["part"] < R.GROUP_PARTS and len(row["events"]) >= 1


def test_bounded_run_stops_a_log_stream(spark):
    """A stream with no end is stopped after the given seconds (bounded run)."""
    ev = _stream_events(spark, "/root/testdata/sf0.001")
    metrics = J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1], events=ev)
    q = sinks.to_log(metrics, prefix="kills: ")
    sinks.run_for(q, 3)
    assert not q.isActive


def test_batch_fan_out_and_noop(spark):
    from sessionrate.plans.queries import _events
    metrics = J.kill_rate_job(None, width_ms=SCALED["kill"][0], slide_ms=SCALED["kill"][1],
                              events=_events(spark, "/root/testdata/sf0.001"))
    seen = []
    sinks.fan_out(metrics, [lambda df, i: seen.append((i, df.count())),
                            lambda df, i: seen.append((i, df.select("session").distinct().count()))])
    assert seen[0][0] == 0 and seen[0][1] == metrics.count() and 0 < seen[1][1] <= seen[0][1]
    assert not metrics.is_cached
    assert sinks.to_noop(metrics) is None
