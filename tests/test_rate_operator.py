"""The rate aggregation, on tiny frames (cases of the reference's operator test)."""

import datetime as dt

from pyspark.sql import functions as F

from sessionrate.operators import rates as R

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _events(spark, rows):
    """rows: (ms after T0, session, type, actor type)."""
    data = [(T0 + dt.timedelta(milliseconds=ms), s, t, a) for ms, s, t, a in rows]
    df = spark.createDataFrame(data, "event_time timestamp, session string, type string, a string")
    return df.select("event_time", "session", "type", F.struct(F.col("a").alias("type")).alias("actor"))


def test_two_matching_events_rate_two(spark):
    ev = _events(spark, [(100, "session", "type", "player"), (200, "session", "type", "player")])
    out = R.event_rate(ev, "type", 1000, 1000).collect()
    assert [(r.session, r.value) for r in out] == [("session", 2.0)]


def test_non_matching_type_does_not_count(spark):
    ev = _events(spark, [(100, "session", "type", "player"), (200, "session", "jump", "player")])
    out = R.event_rate(ev, "type", 1000, 1000).collect()
    assert [(r.session, r.value) for r in out] == [("session", 1.0)]


def test_case_insensitive_and_zero_rows(spark):
    ev = _events(spark, [(100, "s", "KILLED", "player"), (1600, "s", "move", "player")])
    out = sorted((r.window_start_ms - 1704067200000, r.value)
                 for r in R.event_rate(ev, "killed", 3000, 500).collect())
    # windows containing 100 ms: starts -2500..0; containing 1600 ms: -1000..1500
    assert out[0] == (-2500, 1 / 3)
    assert (500, 0.0) in out and (1500, 0.0) in out
    assert len(out) == 9


def test_per_width_formula_and_null_type(spark):
    ev = _events(spark, [(10, "s", None, "player"), (20, "s", "killed", "player")])
    out = R.event_rate(ev, "killed", 1000, 1000, formula="per_width").collect()
    assert [r.value for r in out] == [((1 * 1.0) / 1000) * 1000]


def test_panes_equal_direct(spark):
    rows = [(ms, f"s{ms % 3}", "killed" if ms % 5 == 0 else "move", "player")
            for ms in range(0, 20000, 37)]
    ev = _events(spark, rows)
    a = R.event_rate(ev, "killed", 1000, 25, plan="direct")
    b = R.event_rate(ev, "killed", 1000, 25, plan="panes")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_actor_filters(spark):
    ev = _events(spark, [(1, "a", "move", "PLAYER"), (2, "b", "move", "player"),
                         (3, "c", "move", None), (4, "d", "move", "barrel")])
    assert sorted(r.session for r in R.filter_actor_type(ev, "player").collect()) == ["a", "b"]
    assert [r.session for r in R.filter_actor_type(ev, "player", case_sensitive=True).collect()] == ["b"]


def test_action_rate_float_and_max_timestamp(spark):
    ev = _events(spark, [(100, None, "move", None), (150, None, "Move", None), (200, "x", "move", None)])
    out = {(r.session, r.window_start_ms - 1704067200000): r
           for r in R.action_rate(ev, "move", 1000, 1000).collect()}
    r = out[("", 0)]
    assert r.value == 1.0 and r.max_timestamp == r.window_end_ms - 1 and r.action == "move"
