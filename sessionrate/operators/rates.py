"""Per-session windowed rates, counts, spans and grouped event lists.

Every function takes parsed events (see :func:`sessionrate.operators.parse.parse_events`,
with an ``event_time`` timestamp column) and returns a DataFrame with one row per
``(key, window)``.  They run unchanged on batch and on streaming DataFrames (in
streaming put a watermark on ``event_time`` first, see ``sessionrate.streaming``).

Match flags (``is this a kill``) are computed as a column *before* windowing so the
case-insensitive compare runs once per row, not once per expanded (row, window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionrate.functions.predicates import match_flag, type_is
from sessionrate.operators.windows import (WINDOW_END, WINDOW_START, bounds_ms,
                                           expand_windows, window_column, windowed_aggregate)
from sessionrate.session import stored

# ---------------------------------------------------------------------------
# Window widths / slides (ms) and names used by the jobs.
# ---------------------------------------------------------------------------
KILL_WINDOW_MS, KILL_SLIDE_MS = 3000, 500          # kill rate job
FINE_WINDOW_MS, FINE_SLIDE_MS = 1000, 25           # kills/moves per second jobs
GROUP_WINDOW_MS, GROUP_SLIDE_MS = 1000, 250        # grouped event lists job
PLAYER = "player"
KILLED = "killed"
MOVE = "move"
SUMMARY = "(key: %s, sz: %d, start: %d, end: %d)"  # log line of a window
# ---------------------------------------------------------------------------


# ---------------------------------------------------------------------------
# filters (F1-F5)
# ---------------------------------------------------------------------------

def filter_actor_type(df: DataFrame, actor_type: str = PLAYER,
                      case_sensitive: bool = False) -> DataFrame:
    """Rows whose ``actor.type`` equals ``actor_type`` (a NULL event/actor/type never)."""
    return df.where(type_is(F.col("actor.type"), actor_type, case_sensitive))


def filter_event_type(df: DataFrame, event_type: str, case_sensitive: bool = False,
                      missing_as_empty: bool = False) -> DataFrame:
    """Rows whose event ``type`` equals ``event_type``."""
    return df.where(type_is(F.col("type"), event_type, case_sensitive, missing_as_empty))


# ---------------------------------------------------------------------------
# rates and counts (A1-A4, A9)
# ---------------------------------------------------------------------------

def event_rate(events: DataFrame, event_type: str = KILLED, width_ms: int = KILL_WINDOW_MS,
               slide_ms: int = KILL_SLIDE_MS, unit_ms: int = 1000, key: str = "session",
               formula: str = "scaled", time_col: str = "event_time",
               plan: str = "auto") -> DataFrame:
    """Rate of ``event_type`` events per ``unit_ms`` in each (key, window) (A1/A2).

    Every row of the input counts towards the window's existence, only matching rows
    towards the rate, so a window with activity but no match yields 0.0.

    formula ``scaled``: ``(unit_ms * n) / width_ms``; ``per_width``: ``n == 0 -> 0.0``,
    else ``(n / width_ms) * 1000`` (the two orders may differ in the last bit).
    """
    flagged = events.withColumn("__hit", match_flag(F.col("type"), event_type))
    out = windowed_aggregate(flagged, [key], [("__n", "count_if", F.col("__hit"))],
                             width_ms, slide_ms, time_col, plan)
    n = F.col("__n")
    if formula == "scaled":
        value = (F.lit(float(unit_ms)) * n) / F.lit(width_ms)
    elif formula == "per_width":
        value = F.when(n == 0, F.lit(0.0)).otherwise(
            ((n * F.lit(1.0)) / F.lit(width_ms)) * F.lit(1000.0))
    else:
        raise ValueError("formula must be 'scaled' or 'per_width'")
    return out.select(key, WINDOW_START, WINDOW_END, value.alias("value"))


def event_count(events: DataFrame, event_type: str = MOVE, width_ms: int = FINE_WINDOW_MS,
                slide_ms: int = FINE_SLIDE_MS, key: str = "session",
                time_col: str = "event_time", plan: str = "auto") -> DataFrame:
    """Number of ``event_type`` events per (key, window); no zero rows (A3)."""
    matching = filter_event_type(events, event_type)
    return windowed_aggregate(matching, [key], [("count", "count", None)],
                              width_ms, slide_ms, time_col, plan)


def action_rate(events: DataFrame, action: str = MOVE, width_ms: int = FINE_WINDOW_MS,
                slide_ms: int = FINE_SLIDE_MS, time_col: str = "event_time",
                plan: str = "auto") -> DataFrame:
    """Python job's rate: exact-case type match, no actor filter, FLOAT value (A4).

    Output ``session, window_start_ms, window_end_ms, value FLOAT, max_timestamp, action``
    with ``value = n / ((end - start) / 1000)`` and ``max_timestamp = end - 1``.
    """
    matching = (filter_event_type(events, action, case_sensitive=True, missing_as_empty=True)
                .withColumn("session", F.coalesce(F.col("session"), F.lit(""))))
    out = windowed_aggregate(matching, ["session"], [("__n", "count", None)],
                             width_ms, slide_ms, time_col, plan)
    seconds = (F.col(WINDOW_END) - F.col(WINDOW_START)) / F.lit(1000.0)
    return out.select(
        "session", WINDOW_START, WINDOW_END,
        (F.col("__n").cast("double") / seconds).cast("float").alias("value"),
        (F.col(WINDOW_END) - 1).alias("max_timestamp"),
        F.lit(action).alias("action"))


def session_activity(events: DataFrame, width_ms: int = FINE_WINDOW_MS,
                     slide_ms: int = FINE_SLIDE_MS, move_type: str = MOVE,
                     kill_type: str = KILLED, key: str = "session",
                     time_col: str = "event_time", plan: str = "auto") -> DataFrame:
    """Moves and kills/s from one windowed stream, one aggregation (A9).

    ``move_count`` 0 marks a window that has no row in :func:`event_count`;
    ``kill_rate`` follows the ``per_width`` formula.
    """
    flagged = events.select(
        key, time_col,
        match_flag(F.col("type"), move_type).alias("__move"),
        match_flag(F.col("type"), kill_type).alias("__kill"))
    out = windowed_aggregate(flagged, [key], [("move_count", "count_if", F.col("__move")),
                                              ("__kills", "count_if", F.col("__kill"))],
                             width_ms, slide_ms, time_col, plan)
    n = F.col("__kills")
    rate = F.when(n == 0, F.lit(0.0)).otherwise(((n * F.lit(1.0)) / F.lit(width_ms)) * F.lit(1000.0))
    return out.select(key, WINDOW_START, WINDOW_END, "move_count", rate.alias("kill_rate"))


def activity_span(events: DataFrame, width_ms: int = FINE_WINDOW_MS,
                  slide_ms: int = FINE_SLIDE_MS, key: str = "session",
                  time_col: str = "event_time", plan: str = "auto") -> DataFrame:
    """Row sum/count and earliest/latest ``frame.millis`` per (key, window) (A7, A8).

    The earliest value is the true minimum (no 0 start value).
    """
    millis = F.col("frame.millis")
    return windowed_aggregate(
        events.select(key, time_col, millis.alias("__millis")), [key],
        [("sum", "sum", F.lit(1).cast("long")), ("count", "count", None),
         ("earliest_millis", "min", F.col("__millis")),
         ("latest_millis", "max", F.col("__millis"))],
        width_ms, slide_ms, time_col, plan)


def window_summary(events: DataFrame, width_ms: int = FINE_WINDOW_MS,
                   slide_ms: int = FINE_SLIDE_MS, key: str = "session",
                   time_col: str = "event_time", plan: str = "auto") -> DataFrame:
    """One log line ``(key: k, sz: n, start: s, end: e)`` per (key, window) (A5)."""
    out = windowed_aggregate(events, [key], [("size", "count", None)],
                             width_ms, slide_ms, time_col, plan)
    text = F.format_string(SUMMARY, F.col(key),
                           F.col("size"), F.col(WINDOW_START), F.col(WINDOW_END))
    return out.select(key, WINDOW_START, WINDOW_END, "size", text.alias("summary"))


# ---------------------------------------------------------------------------
# grouped event lists (A6)
# ---------------------------------------------------------------------------

#: parts that every (key, window) group is dealt to
GROUP_PARTS = 8


def windowed_group(events: DataFrame, width_ms: int = GROUP_WINDOW_MS,
                   slide_ms: int = GROUP_SLIDE_MS, key: str = "key",
                   time_col: str = "event_time", parts: int = GROUP_PARTS,
                   deal_by: str | None = None, element: Column | None = None) -> DataFrame:
    """All events of each (key, window) as lists ordered by ``counter`` (A6).

    A group is written as up to ``parts`` rows, so no task holds more than about
    ``1 / parts`` of a group, however hot the key: a row goes to the part that a hash of its
    place names, whatever the size of its group and however producers take turns.  The place
    is the record's ``partition`` and ``offset`` where there are any (so equal records part too),
    else ``counter``; ``deal_by`` names another column.  ``parts`` should follow the largest
    group expected.  Each part is sorted on its own (by counter, then the event); the
    parts of a group together, ordered by ``counter``, are the full list; nothing is
    dropped, and ``parts=1`` gives one row per group.  Output: ``key, window_start_ms,
    window_end_ms, n_events`` (in this part), ``part, n_parts, events`` (array of structs);
    parts without events have no row.

    One parse and one shuffle, on (key, window, part), of the projected rows.  The same
    for batch and streaming input (watermark on ``time_col``), where each part is a state
    row (RocksDB) until the watermark passes the window's end.
    """
    from sessionrate.operators.parse import event_struct  # local: avoid import cycle

    elem = element if element is not None else event_struct()
    if deal_by is not None:
        place = [deal_by]
    else:
        place = [c for c in ("partition", "offset") if c in events.columns] if "offset" in events.columns else ["counter"]
    digest = F.md5(F.concat_ws("/", *[F.col(c).cast("string") for c in place]))
    part = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % int(parts)).cast("int").alias("part")
    rows = events.select(F.col(key).alias(key), F.col(time_col), part,
                         F.struct(F.col("counter").alias("__order"), elem.alias("__ev")).alias("__row"))
    if events.isStreaming:
        rows = rows.withColumn("window", window_column(time_col, width_ms, slide_ms))
        by, bounds = ["window"], bounds_ms("window")
    else:
        rows = expand_windows(rows, width_ms, slide_ms, time_col)
        by, bounds = [WINDOW_START, WINDOW_END], [WINDOW_START, WINDOW_END]
    grouped = rows.groupBy(key, *by, "part").agg(F.collect_list("__row").alias("__l"))
    return grouped.select(
        key, *bounds, F.size("__l").cast("long").alias("n_events"), "part",
        F.lit(int(parts)).alias("n_parts"),
        F.transform(F.sort_array("__l"), lambda x: x["__ev"]).alias("events"))


def _event_rows(events: DataFrame, key: str, time_col: str, element: Column | None, *more: Column) -> DataFrame:
    """key, time, what orders the list (counter, then the record's place), and the event."""
    from sessionrate.operators.parse import event_struct  # local: avoid import cycle

    place = [F.col(c) for c in ("partition", "offset") if c in events.columns]
    order = F.struct(F.col("counter"), *place).alias("__order")
    return events.select(F.col(key).alias(key), F.col(time_col), order,
                         (element if element is not None else event_struct()).alias("__ev"), *more)


#: events of a chunk, at most
GROUP_CHUNK = 10_000


def windowed_group_chunks(events: DataFrame, width_ms: int = GROUP_WINDOW_MS, slide_ms: int = GROUP_SLIDE_MS,
                          key: str = "key", time_col: str = "event_time", length: int = GROUP_CHUNK,
                          element: Column | None = None) -> DataFrame:
    """All events of each (key, window) in chunks of at most ``length``, by position (A6, batch).

    The list of a group is ordered by ``counter`` (then by the record's partition and offset);
    chunk c holds its places ``c * length`` to ``(c + 1) * length - 1``, so every chunk but
    the last is full and the chunks in order are the list, however hot the key and however
    the input is split.  Output: ``key, window_start_ms, window_end_ms, chunk, n_chunks,
    n_events`` (in the chunk), ``events``.

    The projected rows are stored once in the shared folder; group sizes are counted on their
    key and time alone.  Groups of up to ``length`` events take one shuffle.  Rows of larger
    groups are range-partitioned and sorted by (key, window, order), so a group spreads over as
    many tasks as its rows fill; a place in the group is the place in the task plus the rows of
    the group in the tasks before, one number per task and group.
    """
    rows = stored(_event_rows(events, key, time_col, element), "group-rows")
    return _chunks(expand_windows(rows, width_ms, slide_ms, time_col).drop(time_col), key, length)


def _chunks(rows: DataFrame, key: str, length: int) -> DataFrame:
    """``rows``: key, window bounds, __order, __ev; stored ones, as they are read several times."""
    by = [key, WINDOW_START]
    hot = stored(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > length)
                     .withColumnsRenamed({key: "__k", WINDOW_START: "__w"}), "group-sizes")
    met = F.col(key).eqNullSafe(F.col("__k")) & (F.col(WINDOW_START) == F.col("__w"))
    row = F.struct("__order", "__ev").alias("__row")

    def lists(df: DataFrame, chunk: Column, chunks: Column) -> DataFrame:
        g = (df.select(*by, WINDOW_END, chunk.alias("chunk"), chunks.alias("n_chunks"), row)
               .groupBy(*by, WINDOW_END, "chunk", "n_chunks").agg(F.collect_list("__row").alias("__l")))
        return g.select(*by, WINDOW_END, "chunk", "n_chunks", F.size("__l").cast("long").alias("n_events"),
                        F.transform(F.sort_array("__l"), lambda x: x["__ev"]).alias("events"))

    small = lists(rows.join(hot, met, "left_anti"), F.lit(0).cast("long"), F.lit(1).cast("long"))
    if hot.isEmpty():
        return small
    big = rows.join(hot, met).drop("__k", "__w")
    # the last member parts equal rows, which a range of the others could not
    order = [*by, "__order", "__ev", "__tie"]
    big = big.withColumn("__tie", F.monotonically_increasing_id())
    big = stored(big.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("__id", F.monotonically_increasing_id()), "group-sorted")
    task = F.shiftright("__id", 33).alias("__task")
    runs = big.groupBy(*by, task).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__m"))
    earlier = Window.partitionBy(*by).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)   # one row a task
    runs = runs.select(F.col(key).alias("__k"), F.col(WINDOW_START).alias("__w"), F.col("__task").alias("__t"), "__first",
                       F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__before"))
    placed = big.withColumn("__task", F.shiftright("__id", 33)).join(
        runs, (F.col("__task") == F.col("__t")) & met)
    at = F.col("__before") + F.col("__id") - F.col("__first")
    many = lists(placed, F.floor(at / F.lit(length)).cast("long"), F.ceil(F.col("__n") / F.lit(length)).cast("long"))
    return small.unionByName(many)


#: offsets of a topic partition that make one piece
GROUP_BLOCK = 1000


def windowed_group_pieces(events: DataFrame, width_ms: int = GROUP_WINDOW_MS, slide_ms: int = GROUP_SLIDE_MS,
                          key: str = "key", time_col: str = "event_time", block: int = GROUP_BLOCK,
                          element: Column | None = None) -> DataFrame:
    """All events of each (key, window) in pieces of one block of offsets each (A6, streams).

    A piece holds the group's events whose records lie in one block of ``block`` consecutive
    offsets of a topic partition, so ``block`` of them at most.  On a stream a piece is a
    state row of its own: as offsets move on new rows are added, and rows of blocks that are
    read stay as they are, so what a micro-batch writes to the state does not grow
    with the lists.  Output: ``key, window_start_ms, window_end_ms, part`` (the topic
    partition), ``sequence`` (of the block), ``n_events, events``; the pieces of a group in the
    order of (part, sequence) are its records in topic order, :func:`assemble_groups` makes
    whole lists of them.  Records must have an ``offset``.
    """
    at = (F.col("partition") if "partition" in events.columns else F.lit(0)).cast("int").alias("part")
    rows = _event_rows(events, key, time_col, element, at, F.floor(F.col("offset") / F.lit(block)).cast("long").alias("sequence"))
    rows = rows.withColumn("__row", F.struct("__order", "__ev")).drop("__order", "__ev")
    if events.isStreaming:
        rows = rows.withColumn("window", window_column(time_col, width_ms, slide_ms))
        by, bounds = ["window"], bounds_ms("window")
    else:
        rows = expand_windows(rows, width_ms, slide_ms, time_col)
        by, bounds = [WINDOW_START, WINDOW_END], [WINDOW_START, WINDOW_END]
    grouped = rows.groupBy(key, *by, "part", "sequence").agg(F.collect_list("__row").alias("__l"))
    return grouped.select(key, *bounds, "part", "sequence", F.size("__l").cast("long").alias("n_events"),
                          F.transform(F.sort_array("__l"), lambda x: x["__ev"]).alias("events"))


def assemble_groups(pieces: DataFrame, key: str = "key", length: int = GROUP_CHUNK) -> DataFrame:
    """The lists of stored pieces in chunks, as :func:`windowed_group_chunks` (ordered by the
    events' ``counter``, then by the record's partition and place)."""
    one = pieces.select(key, WINDOW_START, WINDOW_END, "part", "sequence", F.posexplode("events").alias("__at", "__ev"))
    order = F.struct(F.col("__ev.counter").alias("counter"), "part", "sequence", "__at").alias("__order")
    return _chunks(one.select(key, WINDOW_START, WINDOW_END, order, "__ev"), key, length)


def windowed_group_text(groups: DataFrame, key: str = "key") -> DataFrame:
    """One JSON line per row of a group (part, chunk or piece):
    ``{"key":..,"window_start_ms":..,..,"events":[..]}``."""
    at = [c for c in ("part", "n_parts", "sequence", "chunk", "n_chunks") if c in groups.columns]
    return groups.select(F.to_json(F.struct(
        F.col(key).alias("key"), WINDOW_START, WINDOW_END, *at, "events"))
        .alias("value"))
