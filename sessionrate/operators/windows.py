"""Sliding event-time windows and decomposable per-(key, window) aggregation.

Windows are epoch aligned and half open, ``[start, start + width)``, with ``start`` a
multiple of ``slide`` -- the same windows as the reference's sliding event-time
windows and Spark's ``window()``.  A key has a window only if at least one of its rows
falls in it.

Three plans compute the same result:

``direct``  each row is expanded into its ``ceil(width/slide)`` windows (integer
            window starts in one generator when ``width % slide == 0``, else
            ``window()``), then one hash aggregate with map-side partial aggregation
            and one shuffle on ``(key, window)``.  Streams always use ``window()``:
            the watermark is tracked through it.  The only plan for widths that are no
            multiple of the slide; asking for another one there is an error.
``panes``   ("No Pane, No Gain"): first aggregate rows into slide-wide panes per key,
            then fan each *pane* out to the windows that contain it and re-aggregate.
            The fan-out multiplies panes instead of rows; pays when many rows share
            a pane.  On a stream these are two chained aggregations, linked by
            ``window_time``: a micro-batch updates a key's panes in the state, and only a
            closed pane, once, the windows it lies in; pays when micro-batches are shorter
            than the slide (else see :mod:`sessionrate.operators.accumulators`, which keeps
            no windows in the state at all).  Closed windows are the same as with ``direct``; a late row is not: a row whose pane has closed is dropped, where
            ``direct`` still counts it in those of its windows that are open (so give a
            delay that covers late rows; with none, nothing differs).
``bucketed``  for large fan-outs with few rows per window, where partial aggregation before
            the shuffle removes nothing and ``direct`` shuffles ``width/slide`` rows per
            row: windows are dealt to time buckets of ``BUCKET_WIDTHS`` window widths, each
            row is shuffled once (twice at a bucket's border) on ``(key, bucket)``, and the
            fan-out happens after the shuffle.  No row is combined before it, so a key's
            rows must spread over many buckets: meant for windows far shorter than the
            time a key is active.
``auto``    (default) ``bucketed`` for batch input with a fan-out of ``AUTO_FAN_OUT`` or more
            and windows of ``AUTO_WIDTH_MS`` or less, else ``direct``.  The choice hangs on
            the widths asked for, never on the data.

Aggregates are declared as ``(name, kind, column)`` with ``kind`` in ``count``,
``count_if``, ``sum``, ``min``, ``max`` so both plans can merge partial results.

Skew: the shuffle key is ``(key, window)``, never ``key`` alone, so a session holding
a third of all rows is still spread over all its windows; partial aggregation runs
before the shuffle, so the shuffled volume is bounded by distinct (key, window) pairs
per map task, not by rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_START = "window_start_ms"
WINDOW_END = "window_end_ms"
#: time bucket of the ``bucketed`` plan, in window widths: a row is sent twice once per bucket
#: of this many widths, and a hot key's rows spread over as many tasks as it has buckets
BUCKET_WIDTHS = 64
PLANS = ("auto", "direct", "panes", "bucketed")
#: ``auto``: from this fan-out on, for windows up to this wide, batch input is bucketed
AUTO_FAN_OUT, AUTO_WIDTH_MS = 16, 10_000


def fan_out(width_ms: int, slide_ms: int) -> int:
    return math.ceil(width_ms / slide_ms)


def _interval(ms: int) -> str:
    return f"{int(ms)} milliseconds"


def window_column(time_col: str, width_ms: int, slide_ms: int) -> Column:
    return F.window(F.col(time_col), _interval(width_ms), _interval(slide_ms))


def bounds_ms(window_col: str = "window") -> list[Column]:
    return [F.unix_millis(F.col(f"{window_col}.start")).alias(WINDOW_START),
            F.unix_millis(F.col(f"{window_col}.end")).alias(WINDOW_END)]


def _partial(kind: str, col: Column | None) -> Column:
    if kind == "count":
        return F.count(F.lit(1)) if col is None else F.count(col)
    if kind == "count_if":
        return F.count_if(col)
    if kind == "sum":
        return F.sum(col)
    if kind == "min":
        return F.min(col)
    if kind == "max":
        return F.max(col)
    raise ValueError(f"not a decomposable aggregate: {kind}")


def _merge(kind: str, name: str) -> Column:
    c = F.col(name)
    if kind in ("count", "count_if"):
        return F.sum(c).cast("long")
    if kind == "sum":
        return F.sum(c)
    if kind == "min":
        return F.min(c)
    return F.max(c)


def windowed_aggregate(df: DataFrame, keys: list[str], aggs: list[tuple[str, str, Column | None]],
                       width_ms: int, slide_ms: int, time_col: str = "event_time",
                       plan: str = "auto") -> DataFrame:
    """``keys + [window_start_ms, window_end_ms] + agg names`` per key and window."""
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}")
    aligned = width_ms % slide_ms == 0 and not df.isStreaming
    if plan == "panes" and df.isStreaming and width_ms % slide_ms == 0:
        return _stream_panes(df, keys, aggs, width_ms, slide_ms, time_col)
    if plan == "auto":
        short = aligned and width_ms <= AUTO_WIDTH_MS and fan_out(width_ms, slide_ms) >= AUTO_FAN_OUT
        plan = "bucketed" if short else "direct"
    if plan != "direct":
        if not aligned:
            raise ValueError(f"the {plan} plan needs a width that is a multiple of the slide"
                             + (", and a batch input" if plan == "bucketed" else ""))
        make = _panes if plan == "panes" else _bucketed
        return make(df, keys, aggs, width_ms, slide_ms, time_col)
    if aligned:
        out = (expand_windows(df, width_ms, slide_ms, time_col)
               .groupBy(*keys, WINDOW_START)
               .agg(*[_partial(kind, c).alias(n) for n, kind, c in aggs]))
        return out.select(*keys, WINDOW_START,
                          (F.col(WINDOW_START) + F.lit(width_ms)).alias(WINDOW_END),
                          *[n for n, _, _ in aggs])
    out = (df.groupBy(*[F.col(k) for k in keys],
                      window_column(time_col, width_ms, slide_ms).alias("window"))
             .agg(*[_partial(kind, c).alias(n) for n, kind, c in aggs]))
    return out.select(*keys, *bounds_ms("window"), *[n for n, _, _ in aggs])


def expand_windows(df: DataFrame, width_ms: int, slide_ms: int,
                   time_col: str = "event_time") -> DataFrame:
    """Each row once per window containing it, with ``window_start_ms``/``window_end_ms``.

    Batch with ``width % slide == 0``: the windows of a row at ``t`` ms start at
    ``p - k * slide`` for ``k < width / slide`` with ``p = t - t mod slide`` -- integer
    arithmetic in one generator (about a third cheaper than ``window()``'s
    timestamp projections and containment filter at fan-out 40).  Otherwise (streams,
    other widths) Spark's ``window()``.
    """
    if width_ms % slide_ms == 0 and not df.isStreaming:
        n = width_ms // slide_ms
        ms = F.unix_millis(F.col(time_col))
        pane = (ms - F.pmod(ms, F.lit(slide_ms))).alias("__pane")
        k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__k")
        start = F.col("__pane") - F.col("__k") * F.lit(slide_ms)
        return (df.select("*", pane, k).where(F.col(time_col).isNotNull())
                  .withColumn(WINDOW_START, start)
                  .withColumn(WINDOW_END, start + F.lit(width_ms))
                  .drop("__pane", "__k"))
    w = df.withColumn("__window", window_column(time_col, width_ms, slide_ms))
    return w.select("*", *bounds_ms("__window")).drop("__window")


def _panes(df: DataFrame, keys, aggs, width_ms: int, slide_ms: int, time_col: str) -> DataFrame:
    ms = F.unix_millis(F.col(time_col))
    pane = ms - F.pmod(ms, F.lit(slide_ms))
    per_pane = (df.where(F.col(time_col).isNotNull())
                  .groupBy(*[F.col(k) for k in keys], pane.alias("__pane"))
                  .agg(*[_partial(kind, c).alias(name) for name, kind, c in aggs]))
    return _windows_of_panes(per_pane, keys, aggs, width_ms, slide_ms)


def _stream_panes(df: DataFrame, keys, aggs, width_ms: int, slide_ms: int, time_col: str) -> DataFrame:
    by = [F.col(k) for k in keys]
    panes = (df.groupBy(*by, F.window(F.col(time_col), _interval(slide_ms)).alias("__pane"))
               .agg(*[_partial(kind, c).alias(name) for name, kind, c in aggs]))
    at = F.window_time(F.col("__pane"))                       # the pane's last instant
    out = (panes.groupBy(*by, F.window(at, _interval(width_ms), _interval(slide_ms)).alias("window"))
                .agg(*[_merge(kind, name).alias(name) for name, kind, _ in aggs]))
    return out.select(*keys, *bounds_ms("window"), *[name for name, _, _ in aggs])


def _windows_of_panes(per_pane: DataFrame, keys, aggs, width_ms: int, slide_ms: int,
                      bucket: Column | None = None) -> DataFrame:
    """Fan each pane out to its windows and merge; with ``bucket`` (of a window start) only
    the windows of the pane row's own bucket."""
    n = width_ms // slide_ms
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__k")
    fanned = per_pane.select("*", k).withColumn(
        WINDOW_START, F.col("__pane") - F.col("__k") * F.lit(slide_ms))
    by = [*keys, WINDOW_START]
    if bucket is not None:
        fanned = fanned.where(bucket == F.col("__bucket"))
        by.append("__bucket")
    return (fanned.groupBy(*by)
                  .agg(*[_merge(kind, name).alias(name) for name, kind, _ in aggs])
                  .select(*keys, WINDOW_START,
                          (F.col(WINDOW_START) + F.lit(width_ms)).alias(WINDOW_END),
                          *[name for name, _, _ in aggs]))


def _bucketed(df: DataFrame, keys, aggs, width_ms: int, slide_ms: int, time_col: str) -> DataFrame:
    size = F.lit(width_ms * BUCKET_WIDTHS)

    def bucket(ms: Column) -> Column:
        return ms - F.pmod(ms, size)

    ms = F.unix_millis(F.col(time_col))
    pane = F.col("__pane")
    first = bucket(pane - F.lit(width_ms - slide_ms))          # of the pane's earliest window
    rows = (df.where(F.col(time_col).isNotNull())
              .withColumn("__pane", ms - F.pmod(ms, F.lit(slide_ms)))
              .withColumn("__bucket", F.explode(F.when(first < bucket(pane), F.array(first, bucket(pane)))
                                                .otherwise(F.array(bucket(pane))))))
    # the one shuffle: both groupings below are finer than its keys.  With a stated number of
    # partitions, as the work behind it is the fan-out times what AQE would coalesce by size
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_pane = (rows.repartition(parts, *keys, "__bucket").groupBy(*keys, "__bucket", "__pane")
                    .agg(*[_partial(kind, c).alias(name) for name, kind, c in aggs]))
    return _windows_of_panes(per_pane, keys, aggs, width_ms, slide_ms, bucket(F.col(WINDOW_START)))
