"""Restart-safe table sink for streaming queries.

Each micro-batch is written with ``foreachBatch`` into Parquet partitioned by
``batch_id`` (+ the table's own partition columns) with dynamic partition
overwrite.  foreachBatch is at-least-once; re-running a batch after a failure
rewrites exactly that batch's partitions, so a restart adds no duplicates.

While the batch is written, ``observe()`` gathers row count and min/max
window start in the same pass; one audit row per non-empty batch goes to an
audit table (the table history).
"""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from rideflux import schemas as S
from rideflux.operators.layout import REJECT_COL, accepted, conform, rejected


def write_partitioned(df: DataFrame, path: str, partition_cols) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def _written(spark, path: str, metrics) -> dict:
    """The metrics taken from a batch's files; none when it left no files."""
    try:
        return spark.read.parquet(path).agg(*metrics).first().asDict()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise


def read_audit(spark, path: str) -> DataFrame:
    """Audit rows, the latest one of each batch."""
    newest = F.max_by(F.struct("num_rows", "min_window_start", "max_window_start", "written_at"), "written_at")
    return (spark.read.parquet(path).groupBy("table_name", F.col("batch_id").cast("long").alias("batch_id"))
            .agg(newest.alias("r")).select("table_name", "batch_id", "r.*"))


def append_audit(spark, audit_path: str, table_name: str, batch_id: int, m: dict) -> None:
    """One audit row: what batch ``batch_id`` has written to ``table_name``."""
    now = dt.datetime.now(dt.timezone.utc)
    row = (table_name, int(batch_id), int(m["num_rows"]), m.get("min_ws"), m.get("max_ws"), now)
    audit = spark.createDataFrame([row], S.AUDIT_SCHEMA).withColumn("day", F.lit(now.date().isoformat()))
    # Appended to the day's folder; a retried batch's earlier row is passed
    # over by readers.  Each table has one writer and a folder of its own:
    # jobs that append to one folder at once would clear each other's files.
    audit.drop("table_name").write.mode("append").partitionBy("day").parquet(f"{audit_path}/table_name={table_name}")


def batch_writer(path: str, table_name: str, partition_cols=(), audit_path: str | None = None,
                 one_file_per_value: bool = False, schema: T.StructType | None = None, rejects_path: str | None = None):
    """foreachBatch function writing one micro-batch idempotently.

    ``one_file_per_value`` redistributes the batch by the partition columns
    and the hour of the window first, so each partition value gets one file
    per hour of windows instead of one per state partition; a batch that
    carries much history spreads over its hours, not over a few zones.  Meant
    for the gold tables; a raw sink carrying full event volume leaves it off.

    With a ``schema`` only rows that conform to it reach the table; the others
    go to ``rejects_path`` with the reason.
    """
    part = ("batch_id", *partition_cols)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        if schema is None:
            return write_rows(batch_df, batch_id)
        # Aggregated rows: one pass writes what conforms and counts what does not;
        # a second one, over the cached rows, only where there is some.
        shaped = conform(batch_df, schema).persist()
        try:
            write_rows(shaped, batch_id)
        finally:
            shaped.unpersist()

    def write_rejects(shaped: DataFrame, batch_id: int) -> None:
        write_partitioned(rejected(shaped).withColumn("batch_id", F.lit(batch_id).cast("long")),
                           rejects_path, ("batch_id",))

    def write_rows(batch_df: DataFrame, batch_id: int) -> None:
        checked = REJECT_COL in batch_df.columns
        ok = F.col(REJECT_COL) == "" if checked else F.lit(True)
        metrics = [F.count_if(ok).alias("num_rows")]
        if "window_start" in batch_df.columns:
            start = F.when(ok, F.col("window_start"))
            metrics += [F.min(start).alias("min_ws"), F.max(start).alias("max_ws")]
        seen = [*metrics, F.count_if(~ok).alias("num_rejected")] if checked else metrics
        # observation names must be unique in the session, a retried batch included
        obs = Observation(f"audit_{table_name}_{batch_id}_{uuid.uuid4().hex[:8]}")
        out = batch_df.observe(obs, *seen)
        if checked:
            out = accepted(out)
        out = out.withColumn("batch_id", F.lit(batch_id).cast("long"))
        if one_file_per_value and partition_cols:
            hour = [F.date_trunc("hour", "window_start")] if "window_start" in batch_df.columns else []
            out = out.repartition(*partition_cols, *hour)
        write_partitioned(out, path, part)
        spark = batch_df.sparkSession
        try:
            m = obs.get
        except Py4JJavaError:
            # No metrics came, as when an input optimised to an empty relation
            # never runs their node: count what was written instead.
            m = None
        if checked and (m is None and not rejected(batch_df).isEmpty() or m and m["num_rejected"]):
            write_rejects(batch_df, batch_id)
        if audit_path is None:
            return
        if m is None:
            written = [F.count(F.lit(1)).alias("num_rows")]
            if "window_start" in batch_df.columns:
                written += [F.min("window_start").alias("min_ws"), F.max("window_start").alias("max_ws")]
            m = _written(spark, f"{path}/batch_id={batch_id}", written)
        if not m.get("num_rows"):
            return  # empty batches get no audit row
        append_audit(spark, audit_path, table_name, batch_id, m)

    return write


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    table_name: str,
    partition_cols=(),
    audit_path: str | None = None,
    trigger_secs: int = 30,
    available_now: bool = False,
    query_name: str | None = None,
    one_file_per_value: bool = False,
    schema: T.StructType | None = None,
    rejects_path: str | None = None,
) -> StreamingQuery:
    """Start an append-mode query into the batch-partitioned table at ``path``."""
    w = (
        df.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(path, table_name, partition_cols, audit_path, one_file_per_value, schema,
                                   rejects_path))
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_secs} seconds")
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def read_sink(spark, path: str, schema=None) -> DataFrame:
    """Read a sink table back in declared column order, without ``batch_id``.

    With a declared schema an empty table (no batch emitted rows yet) reads as
    zero rows, and partition columns keep their declared place and type.
    """
    if schema is None:
        df = spark.read.parquet(path)
        return df.select(*[c for c in df.columns if c != "batch_id"])
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).select(*schema.fieldNames())
