"""A session holding a third of all rows: its windows spread over the reducers."""

import datetime as dt

from pyspark.sql import functions as F

from sessionrate.operators import rates as R

T0 = dt.datetime(2024, 1, 1)


def test_hot_session_spread_over_partitions(spark):
    n = 9000
    rows = [("hot" if i % 3 == 0 else f"s{i % 50}", T0 + dt.timedelta(milliseconds=37 * i),
             "killed" if i % 4 == 0 else "move") for i in range(n)]
    df = spark.createDataFrame(rows, "session string, event_time timestamp, type string")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # see the raw hash partitioning
    try:
        out = R.event_rate(df, "killed", 3000, 500).withColumn("pid", F.spark_partition_id())
        per_pid = {r.pid: r.n for r in out.where(F.col("session") == "hot")
                   .groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    total = sum(per_pid.values())
    assert total > 0
    assert len(per_pid) >= min(n_parts, 4)                  # not one task
    assert max(per_pid.values()) <= 0.5 * total               # no partition holds most of it
    # and the rates are right for the hot session: brute force over its rows
    hot = [(t, ty) for s, t, ty in rows if s == "hot"]
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    want = {}
    for t, ty in hot:
        ms = base + int((t - T0).total_seconds() * 1000)
        for k in range(6):
            start = ms - ms % 500 - 500 * k
            c = want.setdefault(start, [0])
            c[0] += ty == "killed"
    got = {r.window_start_ms: r.value for r in R.event_rate(df, "killed", 3000, 500)
           .where(F.col("session") == "hot").collect()}
    assert got == {k: (1000.0 * v[0]) / 3000 for k, v in want.items()}
