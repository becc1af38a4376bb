"""Metric records, their Kafka serialisation, and the feedback sentence transform.

* :func:`to_metric` -- ``(session, rate)`` -> ``{session, "<type> per second", value}`` (P6)
* :func:`to_kafka_record` -- metric -> key = session, value = metric JSON (P7, K1)
* :func:`metric_feedback` -- metric JSON -> ``"Your <metric> is <value %.3f>."`` with the
  record key and headers carried over (P9, F7, K5)

All stateless, column-only: they run per record on batch or streaming input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionrate.functions.formatting import fmt3
from sessionrate.functions.json import EVENT_ROOT, is_object, with_variant
from sessionrate.operators.windows import WINDOW_END, WINDOW_START

# ---------------------------------------------------------------------------
# Metric naming and the feedback sentence format.
# ---------------------------------------------------------------------------
METRIC_PER = " per "
METRIC_UNITS = {1: "millisecond", 1000: "second", 60_000: "minute", 3_600_000: "hour"}   # ms
SENTENCE_PREFIX = "Your "
SENTENCE_MIDDLE = " is "
SENTENCE_SUFFIX = "."
# ---------------------------------------------------------------------------


def metric_name(event_type: str, unit_ms: int = 1000) -> str:
    """``killed per second``; units without a name of their own read ``killed per 250 ms``."""
    return event_type + METRIC_PER + METRIC_UNITS.get(unit_ms, f"{unit_ms} ms")


def to_metric(rates: DataFrame, event_type: str, unit_ms: int = 1000,
              keep_window: bool = True) -> DataFrame:
    """``session, [window bounds,] metric, value`` from an :func:`event_rate` result that
    was computed with the same ``unit_ms``."""
    win = [WINDOW_START, WINDOW_END] if keep_window and WINDOW_START in rates.columns else []
    return rates.select("session", *win, F.lit(metric_name(event_type, unit_ms)).alias("metric"),
                        F.col("value").cast("double").alias("value"))


def to_kafka_record(metrics: DataFrame, window_headers: bool = False) -> DataFrame:
    """Metric rows -> Kafka records (``key``, ``value`` binary, ``headers``).

    Key = session, so one session's metrics land in one topic partition; their order there
    is that of the writers, see :func:`in_session_order`.
    Value = ``{"session":..,"metric":..,"value":..}``.  ``window_headers`` adds the
    window bounds as record headers ``window_start_ms`` / ``window_end_ms``.
    """
    value = F.to_json(F.struct(F.col("session"), F.col("metric"), F.col("value")))
    if window_headers:
        headers = F.array(
            F.struct(F.lit(WINDOW_START).alias("key"),
                     F.encode(F.col(WINDOW_START).cast("string"), "UTF-8").alias("value")),
            F.struct(F.lit(WINDOW_END).alias("key"),
                     F.encode(F.col(WINDOW_END).cast("string"), "UTF-8").alias("value")))
    else:
        headers = F.lit(None).cast("array<struct<key:string,value:binary>>")
    return metrics.select(F.encode(F.col("session"), "UTF-8").alias("key"),
                          F.encode(value, "UTF-8").alias("value"),
                          headers.alias("headers"))


def in_session_order(metrics: DataFrame, key: str = "session", order: str = WINDOW_START) -> DataFrame:
    """Metrics dealt to writer tasks by session and sorted by window within each task (K6).

    The windowed aggregate leaves one session's windows in many tasks, which would write
    its topic partition at the same time; after this each session has one writer, which
    writes its windows in order.  (A producer keeps the order of what one task sends.)
    """
    return metrics.repartition(key).sortWithinPartitions(key, order)


def _variant_type(v, member: str):
    return F.schema_of_variant(F.try_variant_get(v, f"{EVENT_ROOT}.{member}", "variant"))


def feedback_checked(records: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Metric records with the sentence, or the reason it was rejected.

    A record is rejected (``reject_reason`` set, ``sentence`` NULL) when its value is
    empty, not one JSON object, ``session``/``metric`` are not JSON strings, or ``value``
    is not a JSON number that a double can hold (1e400 cannot).  ``max_bytes`` (default: no
    limit) also rejects longer texts, and sentences that do not fit with a closing byte.

    Plan: the text is parsed once (generator), the members and their JSON types are
    extracted once (projection), the sentence is formatted once (projection), and
    the verdict is a generator output so the accept filter cannot be pushed below it.
    """
    cols = [c for c in records.columns if c != "value"]
    r = with_variant(records.withColumn("__text", F.col("value").cast("string")), "__text")
    v = F.col("__v")
    r = r.select(*cols, "__text",
                 is_object(v).alias("__root_obj"),
                 _variant_type(v, "session").alias("__session_t"),
                 _variant_type(v, "metric").alias("__metric_t"),
                 _variant_type(v, "value").alias("__value_t"),
                 F.try_variant_get(v, f"{EVENT_ROOT}.session", "string").alias("__session"),
                 F.try_variant_get(v, f"{EVENT_ROOT}.metric", "string").alias("__metric"),
                 F.try_variant_get(v, f"{EVENT_ROOT}.value", "double").alias("__number"))
    r = r.withColumn("__sentence", F.concat(F.lit(SENTENCE_PREFIX), F.col("__metric"),
                                            F.lit(SENTENCE_MIDDLE), fmt3(F.col("__number")),
                                            F.lit(SENTENCE_SUFFIX)))
    text, number = F.col("__text"), F.col("__number")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    never = F.lit(False)
    too_long = never if max_bytes is None else F.octet_length(text) > F.lit(max_bytes)
    no_room = never if max_bytes is None else F.octet_length(F.col("__sentence")) + 1 > F.lit(max_bytes)
    reason = (F.when(text.isNull() | (F.octet_length(text) == 0), F.lit("empty"))
              .when(too_long, F.lit("too big"))
              .when(~F.col("__root_obj"), F.lit("not an object"))
              .when(F.coalesce(F.col("__session_t") != "STRING", F.lit(True)), F.lit("session"))
              .when(F.coalesce(F.col("__metric_t") != "STRING", F.lit(True)), F.lit("metric"))
              .when(F.coalesce(~F.col("__value_t").rlike(r"^(BIGINT|DOUBLE|DECIMAL|FLOAT)"),
                               F.lit(True)) | ~finite, F.lit("value"))
              .when(no_room, F.lit("too big")))
    out = r.select(*cols, F.explode(F.array(F.struct(
        F.when(reason.isNull(), F.col("__sentence")).alias("sentence"),
        reason.alias("reject_reason"), F.col("__session").alias("session")))).alias("__r"))
    return out.select(*cols, "__r.sentence", "__r.reject_reason", "__r.session")


def feedback_rejects(records: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """The records without a sentence, with their ``reject_reason`` and text (``value``)."""
    kept = records.withColumn("__raw", F.col("value"))
    bad = feedback_checked(kept, max_bytes).where(F.col("reject_reason").isNotNull())
    return bad.select(*[F.col("__raw").alias("value") if c == "value" else F.col(c) for c in records.columns],
                      "reject_reason")


def metric_feedback(records: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Accepted records -> ``key, value (sentence, UTF-8), headers`` (input key and
    headers copied); the others are in :func:`feedback_rejects`."""
    checked = feedback_checked(records, max_bytes)
    out = checked.where(F.col("reject_reason").isNull())
    headers = (F.col("headers") if "headers" in records.columns
               else F.lit(None).cast("array<struct<key:string,value:binary>>"))
    return out.select(F.col("key"), F.encode(F.col("sentence"), "UTF-8").alias("value"),
                      headers.alias("headers"))
