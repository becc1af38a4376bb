"""Kafka connection options, reader and envelope decoding.

The reader/writer go through Spark's own ``kafka`` data source; this module only
builds its option map from the few settings a user of the jobs has (brokers, topic,
SASL mechanism, user, password, TLS) and decodes the binary key/value columns.

Not passed to Spark on purpose: ``group.instance.id`` (all executors would share one
static member id) and ``auto.offset.reset`` (Spark rejects it; starting offsets are
``startingOffsets``, committed progress is the query checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Connection defaults (a local broker, no authentication); override per deployment.
# ---------------------------------------------------------------------------
DEFAULT_BROKERS = "localhost:9092"
DEFAULT_TOPIC = "game-events"
DEFAULT_USER = None
DEFAULT_PASSWORD = None
DEFAULT_MECHANISM = "PLAIN"
METRICS_TOPIC = "game-metrics"
FEEDBACK_TOPIC = "game-feedback"
REJECTS_TOPIC = "game-rejects"
# SASL login module per mechanism (Kafka client classes).
LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}
# ---------------------------------------------------------------------------


def security_protocol(use_tls: bool, username: str | None) -> str:
    if use_tls and username:
        return "SASL_SSL"
    if use_tls:
        return "SSL"
    if username:
        return "SASL_PLAINTEXT"
    return "PLAINTEXT"


def jaas_config(mechanism: str, username: str, password: str) -> str:
    mech = mechanism.upper()
    if mech not in LOGIN_MODULES:
        raise ValueError(f"unsupported SASL mechanism {mechanism!r}; "
                         f"use one of {sorted(LOGIN_MODULES)}")
    return f'{LOGIN_MODULES[mech]} required username="{username}" password="{password}";'


def kafka_options(brokers: str = DEFAULT_BROKERS, topic: str | None = DEFAULT_TOPIC,
                  username: str | None = DEFAULT_USER, password: str | None = DEFAULT_PASSWORD,
                  mechanism: str | None = DEFAULT_MECHANISM, use_tls: bool = False,
                  for_writer: bool = False, starting_offsets: str = "latest",
                  client_id_prefix: str | None = None,
                  min_partitions: int | None = None,
                  group_id_prefix: str | None = None,
                  fail_on_data_loss: bool | None = None) -> dict[str, str]:
    """Reader (``subscribe``) or writer (``topic``) options for ``format("kafka")``.

    The consumer group: Spark tracks offsets in the query checkpoint and gives each
    query its own group id; ``group_id_prefix`` names it (``groupIdPrefix``), so the
    group shows up under the job's name on the broker.

    ``starting_offsets`` only counts on a query's first start; afterwards its checkpoint
    tells where to go on.  Offsets that are gone by then (retention, a re-created topic)
    fail the query, as Spark does by default; ``fail_on_data_loss=False`` skips them.
    """
    opts = {"kafka.bootstrap.servers": brokers,
            "kafka.security.protocol": security_protocol(use_tls, username)}
    if username:
        mech = (mechanism or DEFAULT_MECHANISM).upper()
        opts["kafka.sasl.mechanism"] = mech
        opts["kafka.sasl.jaas.config"] = jaas_config(mech, username, password or "")
    if topic:
        opts["topic" if for_writer else "subscribe"] = topic
    if not for_writer:
        opts["startingOffsets"] = starting_offsets
        if fail_on_data_loss is not None:
            opts["failOnDataLoss"] = str(bool(fail_on_data_loss)).lower()
        # split each topic partition's offset range over several tasks when the topic
        # has fewer partitions than the cluster has cores (the topic may have one)
        if min_partitions:
            opts["minPartitions"] = str(int(min_partitions))
        if client_id_prefix:
            opts["kafka.client.id"] = client_id_prefix
        if group_id_prefix:
            opts["groupIdPrefix"] = group_id_prefix
    return opts


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True,
               include_headers: bool = False) -> DataFrame:
    """Raw Kafka records (needs the Spark Kafka connector on the class path)."""
    reader = spark.readStream if streaming else spark.read
    options = dict(options)
    if not streaming:
        # a batch read is a bounded offset range: "latest" cannot be its start
        if options.get("startingOffsets", "earliest") == "latest":
            options["startingOffsets"] = "earliest"
        options.setdefault("endingOffsets", "latest")
    reader = reader.format("kafka").options(**options)
    if include_headers:
        reader = reader.option("includeHeaders", "true")
    return reader.load()


def decode_envelope(records: DataFrame, event_time: str = "record") -> DataFrame:
    """Kafka records -> ``key STRING, value STRING, timestamp, headers, [partition,
    offset,] event_time`` (the record's place in the topic is kept where there is one).

    ``event_time``: ``record`` = the record's (CreateTime) timestamp, the event-time
    of every windowed job; ``processing`` = the wall clock at processing time, one instant
    for all records of a micro-batch; ``arrival`` = the clock of the executor's JVM when it
    reads the record, so records of one micro-batch fall into the windows in which
    they were read (a batch that is given again after a failure gets new times).
    """
    cols = records.columns
    out = records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp"),
        (F.col("headers") if "headers" in cols
         else F.lit(None).cast("array<struct<key:string,value:binary>>")).alias("headers"),
        *[F.col(c) for c in ("partition", "offset") if c in cols],
    )
    if event_time == "record":
        return out.withColumn("event_time", F.col("timestamp"))
    if event_time == "processing":
        return out.withColumn("event_time", F.current_timestamp())
    if event_time == "arrival":
        # a nondeterministic call: made once per row, and never folded or repeated
        clock = F.expr("reflect('java.lang.System', 'currentTimeMillis')")
        return out.withColumn("event_time", F.timestamp_millis(clock.cast("long")))
    raise ValueError("event_time must be 'record', 'processing' or 'arrival'")
