"""Table history: the newest commits of each sink table, from the audit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rideflux.streaming.jobs import audit_path
from rideflux.streaming.sinks import read_audit


def table_history(spark: SparkSession, base: str, table: str | None = None, limit: int = 5) -> DataFrame:
    """Last ``limit`` batches per table, newest first (DESCRIBE HISTORY analogue)."""
    audit = read_audit(spark, audit_path(base))
    if table is not None:
        audit = audit.where(F.col("table_name") == table)
    newest = Window.partitionBy("table_name").orderBy(F.col("batch_id").desc())
    return (
        audit.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= limit)
        .select("table_name", "batch_id", "num_rows", "min_window_start", "max_window_start", "written_at")
    )


def pipeline_health(spark: SparkSession, base: str) -> DataFrame:
    """Per table: writes per hour and output lag, from the audit rows.

    ``writes_per_hour`` = non-empty batches over the span of write times;
    ``max_lag_sec`` = largest gap between a batch's write time and the newest
    window it emitted (how far behind event time the table is published).
    """
    audit = read_audit(spark, audit_path(base))
    span_h = (F.unix_timestamp(F.max("written_at")) - F.unix_timestamp(F.min("written_at"))) / F.lit(3600.0)
    lag = F.unix_timestamp("written_at") - F.unix_timestamp("max_window_start")
    return audit.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("writes"),
        F.sum("num_rows").alias("rows_written"),
        F.round(F.coalesce(F.try_divide(F.count(F.lit(1)), span_h), F.count(F.lit(1)).cast("double")), 2)
        .alias("writes_per_hour"),
        F.max(lag).alias("max_lag_sec"),
    )
