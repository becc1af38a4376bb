"""Stored, mergeable accumulators: partial results per key and pane.

A pane is a tumbling window as long as the slide.  Its accumulator (counts, sums, minima,
maxima) is written once; accumulators of several runs, days or sources are merged later, and
any sliding windows that are made of whole panes are finished from them, without the events:

    day1 = accumulate(events_of_day_1, RATE, slide)      # a table of its own
    day2 = accumulate(events_of_day_2, RATE, slide)
    finish(merge(RATE, day1, day2), RATE, width, slide)  # as one run over both days

create, add and merge of an accumulator are thus ``accumulate`` and ``merge``: both are one
aggregation with map-side sums and a shuffle on (key, pane).  ``finish`` fans panes, not events,
out to windows.

On a stream ``accumulate`` keeps one state row per key and open pane, and none per window
(``width / slide`` times fewer); the closed panes are its result, appended to a table.
Windows are finished on reading that table, up to the watermark that the stream had reached.
A late row is dropped if its pane is closed, though a window of it may still be open.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sessionrate.functions.predicates import match_flag
from sessionrate.operators import rates as R
from sessionrate.operators.windows import WINDOW_END, WINDOW_START, _interval, _merge, _partial, _windows_of_panes

PANE_START = "pane_start_ms"
Aggs = list[tuple[str, str, Column | None]]


def rate_aggs(*event_types: str) -> Aggs:
    """Number of events, and of those of each type as ``n_<type>``."""
    return [("n_events", "count", None)] + [(f"n_{t}", "count_if", match_flag(F.col("type"), t)) for t in event_types]


def span_aggs() -> Aggs:
    """Number of events, earliest and latest ``frame.millis``."""
    millis = F.col("frame.millis")
    return [("n_events", "count", None), ("earliest_millis", "min", millis), ("latest_millis", "max", millis)]


def accumulate(events: DataFrame, aggs: Aggs, pane_ms: int, keys: list[str] | None = None,
               time_col: str = "event_time") -> DataFrame:
    """``keys + [pane_start_ms] + agg names``; batch, or a stream with a watermark on ``time_col``."""
    keys = keys or ["session"]
    made = [_partial(kind, c).alias(name) for name, kind, c in aggs]
    if events.isStreaming:
        out = events.groupBy(*[F.col(k) for k in keys], F.window(time_col, _interval(pane_ms)).alias("window")).agg(*made)
        return out.select(*keys, F.unix_millis("window.start").alias(PANE_START), *[n for n, _, _ in aggs])
    ms = F.unix_millis(F.col(time_col))
    return (events.where(F.col(time_col).isNotNull())
                  .groupBy(*[F.col(k) for k in keys], (ms - F.pmod(ms, F.lit(pane_ms))).alias(PANE_START)).agg(*made))


def merge(aggs: Aggs, *tables: DataFrame) -> DataFrame:
    """The accumulators of all ``tables`` (equal columns), one row per key and pane."""
    names = [n for n, _, _ in aggs]
    keys = [c for c in tables[0].columns if c not in (PANE_START, *names)]
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole.groupBy(*keys, PANE_START).agg(*[_merge(kind, name).alias(name) for name, kind, _ in aggs])


def finish(panes: DataFrame, aggs: Aggs, width_ms: int, slide_ms: int, until_ms: int | None = None) -> DataFrame:
    """Sliding windows of accumulators made with ``pane_ms = slide_ms`` (or a divisor of it):
    ``keys + [window_start_ms, window_end_ms] + agg names``; those that end by ``until_ms``."""
    if width_ms % slide_ms:
        raise ValueError("the width must be a multiple of the slide")
    names = [n for n, _, _ in aggs]
    keys = [c for c in panes.columns if c not in (PANE_START, *names)]
    start = F.col(PANE_START)
    per_slide = panes.select(*keys, (start - F.pmod(start, F.lit(slide_ms))).alias("__pane"), *names)
    out = _windows_of_panes(per_slide, keys, aggs, width_ms, slide_ms)
    return out if until_ms is None else out.where(F.col(WINDOW_END) <= F.lit(int(until_ms)))


def rate_of(windows: DataFrame, event_type: str, width_ms: int, unit_ms: int = 1000) -> DataFrame:
    """``value`` from the counts of :func:`finish`, as :func:`rates.event_rate` has it."""
    value = (F.lit(float(unit_ms)) * F.col(f"n_{event_type}")) / F.lit(width_ms)
    return windows.select("session", WINDOW_START, WINDOW_END, value.alias("value"))


def activity_of(windows: DataFrame, width_ms: int) -> DataFrame:
    """Moves and kills per second from counts of both types, as :func:`rates.session_activity`."""
    n = F.col(f"n_{R.KILLED}")
    rate = F.when(n == 0, F.lit(0.0)).otherwise(((n * F.lit(1.0)) / F.lit(width_ms)) * F.lit(1000.0))
    return windows.select("session", WINDOW_START, WINDOW_END, F.col(f"n_{R.MOVE}").alias("move_count"), rate.alias("kill_rate"))


def watermark_ms(query: StreamingQuery) -> int | None:
    """The watermark that a query had reached in its last batch: the ``until_ms`` of its table."""
    mark = ((query.lastProgress or {}).get("eventTime") or {}).get("watermark")
    return None if mark is None else round(datetime.fromisoformat(mark.replace("Z", "+00:00")).timestamp() * 1000)
