"""Spark session and shared-folder helpers.

Every operator in this package is a plain ``DataFrame -> DataFrame`` function; the
session is only needed by the runners (streaming, bench, entry).  Two settings are
load-bearing for correct results and are enforced here:

* ``spark.sql.session.timeZone=UTC`` -- window bounds are epoch aligned and reported
  as epoch milliseconds; a non-UTC session would shift nothing in the epoch values
  but would change how ``TIMESTAMP_NTZ`` inputs are read as instants.
* AQE on, with skew-join and partition coalescing, so that the shuffle on
  ``(session, window)`` adapts to the data at run time.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # of a repeated member name the last one counts, in VARIANT as in from_json
    "spark.sql.variant.allowDuplicateKeys": "true",
    # mask SASL credentials (the JAAS line holds the password) wherever Spark prints
    # data-source options: plans, UI, logs
    "spark.sql.redaction.options.regex": "(?i)url|jaas|password|secret|token",
    # Streaming state lives in RocksDB (spills to disk, like the reference's state
    # backend) instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a changelog per micro-batch instead of uploading a snapshot each time
    # (summed state commit time 2.6 s -> 0.8 s for the kill-rate stream at sf0.1)
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # its native memory is shared by all partitions of an executor, not taken by each
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}
_STATE = "spark.sql.streaming.stateStore."


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "sessionrate", extra: dict | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this package relies on.

    ``driver_memory`` only matters in local mode (the driver JVM runs the tasks) and
    only when the JVM is not running yet.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """The session settings that results depend on (for sessions not made by get_spark)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys"):
        spark.conf.set(k, DEFAULT_CONF[k])


def ensure_state_store(spark: SparkSession) -> None:
    """State in RocksDB, for sessions not made by get_spark that name no state store: Spark's own
    default keeps every state row on the executors' heap.  (A restarted query goes on with the
    store that its checkpoint names.)  Without the lookup before each write that only counts the
    rows of the state: ``numRowsTotal`` is not given there."""
    if not spark.conf.get(_STATE + "providerClass", ""):
        spark.conf.set(_STATE + "rocksdb.trackTotalNumberOfRows", "false")
        for k in (k for k in DEFAULT_CONF if k.startswith(_STATE)):
            spark.conf.set(k, DEFAULT_CONF[k])


def sizing(shuffle_bytes: float, cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a run that shuffles about ``shuffle_bytes`` (at its widest) on ``cores``.

    Enough shuffle partitions for ``partition_bytes`` each, at least two per core; AQE then
    coalesces what turns out small.  Streams fix their number at the first start, so give
    the size of their state there.  Pass to :func:`get_spark` as ``extra``.
    """
    n = str(max(2 * cores, -(-int(shuffle_bytes) // partition_bytes), 1))
    return {"spark.sql.shuffle.partitions": n,
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
            "spark.sql.files.maxPartitionBytes": str(partition_bytes)}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever the cluster names in ``spark.checkpoint.dir``
    (a shared file system every executor and the driver can reach).  Only under a
    ``local`` master (tests, one machine) a private folder is made when none is named;
    on a cluster that is an error, as executors do not see the driver's folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sessionrate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"



def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: later jobs start from
    files that every executor reaches.  The folder belongs to the run; whoever set
    ``spark.checkpoint.dir`` clears it after the last job that reads from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
