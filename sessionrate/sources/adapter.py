"""Adapter: the driver's ``events`` table -> Kafka-shaped game-event records.

The library's input is a Kafka topic of JSON game events.  No broker is available in
tests, so the given ``events`` table is mapped, row by row and entirely in Catalyst
expressions, onto records of exactly the shape the Spark Kafka source produces
(``key`` / ``value`` binary, ``timestamp``, ``headers``).  Everything downstream then
runs unchanged on a real topic.

Mapping (one output record per input row, no shuffle, scales with the scan):

* ``session``  = user id as text; Kafka key = ``'k' || user_id % 10`` (differs from
  the session on purpose: the grouped-events job keys by the Kafka key).
* event type   = error -> killed, purchase -> hit, signup -> spawn, else move; every
  7th event id upper-cased (exercises the case rules).
* ``actor``    absent for event ids ending in 1; type 'barrel' for ids ending in 0,
  'PLAYER' for ids ending in 2, else 'player'; ``position`` absent for ids divisible
  by 4; a ``target`` barrel for hit/killed events with ids divisible by 3.
* ``frame.millis`` = ms since 2024-01-01, ``frame.tic`` = millis * 35 / 1000.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionrate.schema import TICS_PER_SECOND

# ---------------------------------------------------------------------------
# Fixed values of the test adapter (chosen from the event schema's examples).
# ---------------------------------------------------------------------------
EPOCH_2024_MS = 1704067200000          # 2024-01-01T00:00:00Z in epoch ms
ACTOR_ID_BASE = 140365466484344        # actor.id example
SUBSECTOR_BASE = 140365466405016       # actor.position.subsector example
TARGET_ID = 140365466491112            # target.id example
TARGET_TYPE = "barrel"
TARGET_HEALTH = 10
EVENT_TYPE_MAP = (("error", "killed"), ("purchase", "hit"), ("signup", "spawn"))
OTHER_EVENT_TYPE = "move"
# ---------------------------------------------------------------------------


def _game_type() -> Column:
    expr = F.lit(OTHER_EVENT_TYPE)
    for src, dst in reversed(EVENT_TYPE_MAP):
        expr = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(expr)
    return expr


def game_columns(events: DataFrame) -> DataFrame:
    """Flat game-event columns derived from ``events`` (one row per event)."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    eid, uid = F.col("event_id"), F.col("user_id")
    t = _game_type()
    return events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("k"), (uid % 10).cast("string")).alias("kafka_key"),
        uid.cast("string").alias("session"),
        eid.alias("counter"),
        F.when(eid % 7 == 0, F.upper(t)).otherwise(t).alias("type"),
        F.when(t == "hit", F.floor("value").cast("long")).alias("damage"),
        (ms - F.lit(EPOCH_2024_MS)).alias("millis"),
        F.floor((ms - F.lit(EPOCH_2024_MS)) * TICS_PER_SECOND / 1000).cast("int").alias("tic"),
        F.when(eid % 10 == 1, F.lit(None).cast("string"))
         .when(eid % 10 == 0, F.lit("barrel"))
         .when(eid % 10 == 2, F.lit("PLAYER"))
         .otherwise(F.lit("player")).alias("actor_type"),
        F.floor("value").cast("int").alias("health"),
        (F.lit(ACTOR_ID_BASE) + uid).alias("actor_id"),
        (eid % 4 != 0).alias("has_position"),
        (eid * 65536).alias("x"), (uid * 65536).alias("y"), F.lit(0).cast("long").alias("z"),
        ((eid * 1048576) % F.lit(4294967296)).alias("angle"),
        (F.lit(SUBSECTOR_BASE) + eid % 8).alias("subsector"),
        (t.isin("hit", "killed") & (eid % 3 == 0)).alias("has_target"),
    )


def game_event_struct(g: DataFrame) -> Column:
    """The nested event struct of ``game_columns`` rows (NULL = absent member)."""
    position = F.when(F.col("has_position"), F.struct(
        F.col("x"), F.col("y"), F.col("z"), F.col("angle"), F.col("subsector")))
    actor = F.when(F.col("actor_type").isNotNull(), F.struct(
        position.alias("position"), F.col("actor_type").alias("type"),
        F.col("health"), F.lit(0).alias("armor"), F.col("actor_id").alias("id")))
    target = F.when(F.col("has_target"), F.struct(
        F.lit(TARGET_TYPE).alias("type"), F.lit(TARGET_HEALTH).alias("health"),
        F.lit(TARGET_ID).alias("id")))
    return F.struct(
        F.col("session"), F.col("counter"), F.col("type"), F.col("damage"),
        F.struct(F.col("millis"), F.col("tic")).alias("frame"),
        actor.alias("actor"), target.alias("target"))


def faulty_text(text: Column) -> Column:
    """The record text with a fault in 13 of 40 event ids (by ``counter % 40``).

    Rejects: 1 cut, 3 followed by text, 5 two objects, 7 an array, 9 a number as a string,
    11 a fraction, 13 a number out of range, 15 an actor that is no object.
    Not rejects: 17 JSON null and 19 blank (NULL events), 21 no member at all, 23 a repeated
    name (the last one counts), 25 no session.
    """
    c = F.col("counter")
    number, session = c.cast("string"), F.col("session")
    faults = {
        1: F.substring(text, 1, 40),
        3: F.concat(text, F.lit(" trailing")),
        5: F.concat(text, text),
        7: F.concat(F.lit("["), text, F.lit("]")),
        9: F.concat(F.lit('{"session":"'), session, F.lit('","counter":"'), number, F.lit('"}')),
        11: F.concat(F.lit('{"session":"'), session, F.lit('","counter":'), number, F.lit(".5}")),
        13: F.concat(F.lit('{"counter":'), number, F.lit(',"frame":{"millis":1,"tic":99999999999}}')),
        15: F.concat(F.lit('{"session":"'), session, F.lit('","counter":'), number, F.lit(',"actor":"x"}')),
        17: F.lit("null"),
        19: F.lit(" "),
        21: F.lit("{}"),
        23: F.concat(F.lit('{"session":"first",'), text.substr(F.lit(2), F.length(text))),
        25: F.concat(F.lit("{"), text.substr(F.instr(text, ',"counter"') + 1, F.length(text))),
    }
    out = text
    for k, bad in faults.items():
        out = F.when(c % 40 == k, bad).otherwise(out)
    return out


def events_to_records(events: DataFrame, faults: bool = False) -> DataFrame:
    """``events`` -> Kafka records ``key BINARY, value BINARY, timestamp, headers,
    partition, offset`` (one topic partition, the event id as the offset).

    ``to_json`` omits NULL members, so absent members are really absent in the text.
    ``faults`` spoils the texts of some records, see :func:`faulty_text`.
    """
    g = game_columns(events)
    text = F.to_json(game_event_struct(g))
    if faults:
        text = faulty_text(text)
    return g.select(
        F.encode(F.col("kafka_key"), "UTF-8").alias("key"),
        F.encode(text, "UTF-8").alias("value"),
        F.col("timestamp"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"),
        F.lit(0).alias("partition"), F.col("counter").alias("offset"),
    )


#: rows of a task, on average: in the tasks behind, a row becomes a JSON text, dozens of checks
#: and one group for each of its windows (40 for the fine ones)
TASK_ROWS = 50_000


def spread(df: DataFrame, min_partitions: int | None = None, rows: int | None = None) -> DataFrame:
    """``df`` dealt evenly over at least ``min_partitions`` tasks (default: the cluster's
    cores) and, where the number of its ``rows`` is given, one for every ``TASK_ROWS``, when its
    source has fewer splits.  The per-row work after it (JSON, window expansion, partial
    aggregation) then runs on every core, and a task's share of it does not grow with the table.

    Splits are cut by bytes (128 MB hold millions of small rows), and a row costs far more
    behind them than its one shuffle here.  Rows are dealt by a hash of their place, so equal
    ones and NULL keys part too, and without the sort of a round-robin.  A source with enough
    splits is left alone.
    Streams are never spread (their split count is only known per micro-batch).
    """
    if df.isStreaming:
        return df
    want = max(min_partitions or df.sparkSession.sparkContext.defaultParallelism,
               -(-(rows or 0) // TASK_ROWS))
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.withColumn("__place", F.monotonically_increasing_id()).repartition(want, "__place").drop("__place")


def load_events(spark, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return spread(events, rows=events.count())      # of the files' footers alone


def game_records(spark, sf_dir: str, faults: bool = False) -> DataFrame:
    """Kafka-shaped records for the test scale ``sf_dir``."""
    return events_to_records(load_events(spark, sf_dir), faults)
