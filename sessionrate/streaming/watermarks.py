"""Watermark of the slowest topic partition, with a rule that releases idle ones.

``withWatermark`` on a whole source follows its fastest partition: with delay 0 a record of a
partition that lags behind is late as soon as another one has moved on.  Here every topic
partition is a branch of its own with its own watermark; the branches are united, and Spark's
policy for several watermarks (``spark.sql.streaming.multipleWatermarkPolicy=min``) takes
the least of them, so nothing is late as long as each partition is in order.

A partition without records would hold that minimum for ever.  The rule that releases it: a
partition holds the watermark back by at most ``idle`` of event time behind the fastest one.
Each branch's watermark is thus the later of its own newest record and the newest record of
all partitions less ``idle``.  It hangs on the records alone, not on a clock, so a replay
gives the same result; a partition that lags by more than ``idle`` while it still delivers counts
as idle too, so ``idle`` must cover a backlog that is being worked off.  ``idle=None``: never
released.

The newest times travel as markers: one row per task and Arrow batch, gathered once per
micro-batch (one small exchange that all branches reuse) and dropped behind the watermark.

The number of partitions is part of the query: it is fixed in the checkpoint, and a record of a
partition that no branch reads is an error.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionrate.operators.windows import window_column
from sessionrate.sources.kafka import read_kafka

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"
_MARK = "__mark"


def read_partitions(spark: SparkSession, options: dict[str, str], partitions: list[int]) -> list[DataFrame]:
    """One stream per partition of the subscribed topic (each is read once, by its branch)."""
    topic = options["subscribe"]
    own = {k: v for k, v in options.items() if k != "subscribe"}
    return [read_kafka(spark, {**own, "assign": json.dumps({topic: [p]})}) for p in partitions]


def _newest(branches: list[DataFrame], time_col: str) -> DataFrame:
    """The newest time of each task's batches, in one partition: the same exchange for every
    branch that uses it."""
    times = branches[0].select(time_col)
    for b in branches[1:]:
        times = times.unionByName(b.select(time_col))

    def newest(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            top = pc.max(batch.column(0))
            if top.is_valid:
                yield pa.RecordBatch.from_arrays([pa.array([top.as_py()], type=batch.schema[0].type)], [time_col])

    return times.mapInArrow(newest, times.schema).repartition(1)


def slowest_watermark(records: DataFrame | list[DataFrame], delay: str = "0 seconds", idle: str | None = None,
                      partitions: list[int] | None = None, time_col: str = "event_time") -> DataFrame:
    """``records`` with a watermark of ``delay`` behind their slowest partition.

    ``records``: one stream per partition (:func:`read_partitions`), or one stream with a
    ``partition`` column, of which those named in ``partitions`` are the branches (for
    sources that cannot be split: each branch then reads the whole stream).  Rows
    of other partitions fail the query.  ``idle``: an interval such as ``"3 seconds"``.
    """
    if isinstance(records, DataFrame):
        if not partitions:
            raise ValueError("name the partitions")
        whole, at = records, F.col("partition")
        known = at.isin(*partitions)
        # the first branch also meets the rows that belong nowhere
        stray = F.raise_error(F.concat(F.lit("no branch for partition "), F.coalesce(at.cast("string"), F.lit("NULL"))))
        checked = F.when(F.coalesce(known, F.lit(False)), at == F.lit(partitions[0])).otherwise(stray.cast("boolean"))
        branches = [whole.filter(checked)] + [whole.filter(at == F.lit(p)) for p in partitions[1:]]
    else:
        branches, whole = list(records), records[0]
    spark = branches[0].sparkSession
    if spark.conf.get(POLICY, "min") != "min":
        raise ValueError(f"{POLICY} must be min")
    newest = _newest(branches, time_col) if idle else None
    out = None
    for b in branches:
        if newest is not None:
            mark = newest.select(*[(F.col(time_col) - F.expr(f"INTERVAL {idle}")).alias(time_col) if f.name == time_col
                                   else F.lit(None).cast(f.dataType).alias(f.name) for f in b.schema],
                                 F.lit(True).alias(_MARK))
            b = b.withColumn(_MARK, F.lit(False)).unionByName(mark).withWatermark(time_col, delay)
            # hangs on the time as well, so that it is not evaluated before the watermark
            b = b.filter(~F.col(_MARK) | (F.col(time_col) < F.lit("0001-01-02").cast("timestamp"))).drop(_MARK)
        else:
            b = b.withWatermark(time_col, delay)
        out = b if out is None else out.unionByName(b)
    return out


#: state rows that the count of late records keeps per open slide
LATE_SPREAD = 16


def with_late_records(result: DataFrame, events: DataFrame, width_ms: int, slide_ms: int,
                      time_col: str = "event_time") -> DataFrame:
    """``result`` (append mode), in a query that also counts its late records (T5).

    A windowed aggregation drops (key, window) pairs, so Spark's own figure is that of pairs.
    Here each record of ``events`` (what ``result`` was computed from, under its watermark)
    also passes a deduplication by its last window; it does not combine rows before it
    looks at the watermark, so it drops, and counts, one row per record whose windows have all
    closed.  A record that is late for some of its windows only is not counted.  The branch adds
    no row to the result and reads the same micro-batches under the same watermark;
    ``LateRows.records`` gives the number.

    Cost: a second read of the time (and of partition and offset, where there are any), one
    shuffle of a few bytes per record, and at most ``LATE_SPREAD`` state rows per open slide,
    however many records there are.
    """
    place = [F.col(c) for c in ("partition", "offset") if c in events.columns]
    salt = F.pmod(F.xxhash64(F.col(time_col), *place), F.lit(LATE_SPREAD))
    last = F.unix_micros("__last.start") + F.lit(slide_ms * 1000) > F.unix_micros(time_col)
    seen = (events.select(time_col, salt.alias("__salt"), window_column(time_col, width_ms, slide_ms).alias("__last"))
                  .filter(last).select("__last", "__salt").dropDuplicates(["__last", "__salt"]))
    none = seen.filter(F.col("__salt") < 0)            # never true, which the optimizer cannot know
    return result.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in result.schema]))
