"""Streams keep their state in RocksDB, also in sessions that name no state store."""

from pyspark.sql import functions as F

from sessionrate.session import ensure_state_store
from sessionrate.streaming.runner import run_to_parquet

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def metrics(spark, folder, name):
    src = spark.readStream.schema("t timestamp, n long").parquet(folder).withWatermark("t", "0 seconds")
    counts = src.groupBy(F.window("t", "1 second")).count()
    seen = []

    class Progress(__import__("pyspark").sql.streaming.StreamingQueryListener):
        def onQueryStarted(self, event): pass
        def onQueryIdle(self, event): pass
        def onQueryTerminated(self, event): seen.append(None)
        def onQueryProgress(self, event):
            seen.extend(dict(op.customMetrics) for op in event.progress.stateOperators)

    listener = Progress()
    spark.streams.addListener(listener)
    try:
        path = run_to_parquet(counts.select("window.start", "count"), name)
        for _ in range(100):
            if None in seen:
                break
            __import__("time").sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    return spark.read.parquet(path).count(), [m for m in seen if m]


def test_state_of_a_plain_session(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5000).select(F.timestamp_millis(F.col("id") * 10).alias("t"), F.col("id").alias("n")).write.parquet(folder)
    ours, unset = spark.conf.get(PROVIDER), spark.newSession()
    unset._jsparkSession.sessionState().conf().unsetConf(PROVIDER)      # get_spark had named it for the whole test run
    assert unset.conf.get(PROVIDER, "") == ""
    rows, stats = metrics(unset, folder, "plain")
    assert rows == 49 and stats and all(any("rocksdb" in k.lower() for k in m) for m in stats)
    assert unset.conf.get(PROVIDER) == ours


def test_a_named_store_is_kept(spark):
    other = spark.newSession()
    other.conf.set(PROVIDER, HEAP)
    ensure_state_store(other)
    assert other.conf.get(PROVIDER) == HEAP
