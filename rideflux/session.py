"""Session helpers: one place for the confs every job relies on."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, app_name: str = "rideflux",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  large_state: bool = False) -> SparkSession:
    """Session with the settings the library assumes.

    * UTC session time zone: producers send naive UTC ISO strings.
    * AQE on (coalesce small shuffles, split skewed ones at runtime).
    * UI off: batch jobs need no web server.
    * Streaming state: Spark's default in-memory store, which suits the gold
      aggregates (state = open windows x keys, bounded by the watermark, not
      by data volume); ``large_state=True`` switches to RocksDB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    confs = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if large_state:
        # Off-heap state with changelog checkpoints: for state far larger than
        # the open windows x keys of the gold aggregates (which stay small).
        confs["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        confs["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for k, v in confs.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Event times are UTC wall-clock; pin the session zone if it differs."""
    if spark.conf.get("spark.sql.session.timeZone", UTC) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared,
    fault-tolerant location there).  Only when nothing is configured, a folder
    under the SQL warehouse, which is shared as well, is registered as the
    checkpoint dir; never a folder of one machine's own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_rideflux"
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """Fresh sub-folder of the shared folder for one job run."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Set ``spark.sql.shuffle.partitions`` for the duration of the block.

    A stateful streaming query records this number in its checkpoint at
    first start (it is the number of state-store partitions for the query's
    lifetime), so streams are started inside this block and the block is left
    only after they have started.  ``None`` leaves the setting alone.
    """
    if n is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)
