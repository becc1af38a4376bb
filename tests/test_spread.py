"""The events table is dealt by rows: what a task expands does not grow with the table."""

from pyspark.sql import functions as F

from sessionrate.sources.adapter import load_events


def table(spark, folder, n):
    """One file with one split; NULL keys and, in every second row, equal ones."""
    i = F.col("id")
    rows = spark.range(n).select(
        F.when(i % 2 == 0, i).otherwise(F.when(i % 3 == 0, F.lit(7).cast("long"))).alias("event_id"),
        F.timestamp_millis(F.lit(1704067200000) + F.when(i % 2 == 0, i).otherwise(F.lit(0))).cast("timestamp_ntz").alias("ts"),
        F.when(i % 2 == 0, i % 1500).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("props"))
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_rows_of_a_task_are_bounded(spark, tmp_path):
    n = 1_200_000
    path = table(spark, tmp_path, n)
    events = load_events(spark, path)
    sizes = [r.n for r in events.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == n
    assert max(sizes) < 60_000                      # was 150,000 on 8 cores, and grew with the table
    plain = spark.read.parquet(f"{path}/events.parquet")
    assert events.columns == plain.columns and events.exceptAll(plain).isEmpty() and plain.exceptAll(events).isEmpty()


def test_small_tables_take_every_core(spark, tmp_path):
    events = load_events(spark, table(spark, tmp_path, 1000))
    assert events.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
