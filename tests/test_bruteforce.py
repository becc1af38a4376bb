"""Windowed rates against a brute-force enumeration in plain Python (random fixtures)."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sessionrate.operators import rates as R

T0 = dt.datetime(2024, 1, 1)
BASE = 1704067200000


def _brute(rows, width, slide, event_type):
    """rows: (ms, session, type) -> {(session, start): (n_all, n_match)}."""
    out = defaultdict(lambda: [0, 0])
    for ms, s, t in rows:
        t_abs = BASE + ms
        m = t_abs // slide
        while m * slide > t_abs - width:          # every start in (t - width, t]
            key = (s, m * slide)
            out[key][0] += 1
            out[key][1] += int(t is not None and t.lower() == event_type)
            m -= 1
    return out


@pytest.mark.parametrize("seed,width,slide", [(1, 1000, 25), (2, 3000, 500), (3, 1000, 300),
                                              (4, 700, 250), (5, 1000, 1000)])
def test_event_rate_and_count_match_brute_force(spark, seed, width, slide):
    rnd = random.Random(seed)
    types = ["killed", "KILLED", "move", "Killed", None]
    rows = [(rnd.randint(0, 5000), rnd.choice("abc"), rnd.choice(types)) for _ in range(300)]
    df = spark.createDataFrame([(T0 + dt.timedelta(milliseconds=ms), s, t) for ms, s, t in rows],
                               "event_time timestamp, session string, type string")
    want = _brute(rows, width, slide, "killed")
    for plan in ("direct", "panes", "bucketed") if width % slide == 0 else ("direct",):
        got = {(r.session, r.window_start_ms): r for r in
               R.event_rate(df, "killed", width, slide, plan=plan).collect()}
        assert set(got) == set(want), plan
        for k, (n_all, n_match) in want.items():
            assert got[k].value == (1000.0 * n_match) / width
            assert got[k].window_end_ms == k[1] + width
        spans = {(r.session, r.window_start_ms): r["count"] for r in
                 R.activity_span(df.withColumn("frame", F.struct(F.lit(1).cast("long").alias("millis"))),
                                 width, slide, plan=plan).collect()}
        assert spans == {k: v[0] for k, v in want.items()}
