"""Backfill of stored gold tables from the raw sink.

A stream drops a row that comes after its window was emitted.  The raw sink
has kept it, so the window can be put right: windows that late rows may
belong to are found from the raw table, recomputed, and those that differ
from the stored ones are written to a repair table that readers put in place
of the stream's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from rideflux import schemas as S
from rideflux.operators.gold import GOLD, window_minutes
from rideflux.streaming.jobs import raw_path, read_gold
from rideflux.streaming.sinks import write_partitioned


def repair_path(base: str, table: str) -> str:
    return f"{base}/repaired/{table}"


def _interval(minutes) -> F.Column:
    return F.expr(f"INTERVAL {minutes} MINUTES")


def _raw(spark: SparkSession, base: str, table: str, since) -> DataFrame:
    """Raw rows of the table's stream that can reach its windows from ``since`` on."""
    rows = spark.read.parquet(raw_path(base, GOLD[table][1])).where("event_ts IS NOT NULL")
    return rows if since is None else rows.where(F.col("event_ts") >= F.lit(since).cast("timestamp"))


def late_windows(spark: SparkSession, base: str, table: str, since=None) -> DataFrame:
    """``window_start`` of the closed windows that a late row may belong to.

    A row may be late if its time lies below the watermark that the rows up to
    its own raw batch have set.  The gold query has read no more than those
    when it came to the row, whatever its own batches were, so no late row is
    missed; some listed windows will turn out to be right.  A window is closed
    when the newest event less the table's delay has passed its end.
    """
    spec = S.GOLD_SPECS[table]
    size, slide = window_minutes(table)
    rows = _raw(spark, base, table, since)
    if table == "revenue_analytics":  # its clock and its rows are those of completed rides
        rows = rows.where(F.col("status") == S.STATUS_COMPLETED)
    # One row per batch: small enough for a running maximum in one task.
    marks = rows.groupBy("batch_id").agg(F.max("event_ts").alias("top")).select("batch_id", (
        F.max("top").over(Window.orderBy("batch_id")) - F.expr(f"INTERVAL {spec.watermark}")).alias("mark"))
    newest = marks.agg(F.max("mark").alias("newest"))
    late = rows.select("batch_id", "event_ts").join(F.broadcast(marks), "batch_id").where("event_ts < mark")
    first = F.window("event_ts", f"{slide} minutes")["start"]
    starts = late.select(F.explode(F.array(*[first - _interval(i * slide) for i in range(size // slide)])).alias("window_start"))
    return starts.distinct().join(F.broadcast(newest), F.col("window_start") + _interval(size) <= F.col("newest")).select(
        "window_start")


def backfill(spark: SparkSession, base: str, table: str, since=None) -> None:
    """Repair ``table``'s windows that late rows belong to.

    Only events of the windows in question are aggregated again, and only
    windows whose rows then differ from the stream's are written, partitioned
    by the date they start on.  Dates are replaced as a whole from all raw
    rows (from ``since`` on, a day's start), so the job can be repeated, also
    after a failure, with the same result.
    """
    fn, _ = GOLD[table]
    size, slide = window_minutes(table)
    spec = S.GOLD_SPECS[table]
    windows = late_windows(spark, base, table, since).persist()
    try:
        parts = windows.select(F.explode(F.array(*[
            F.col("window_start") + _interval(i * slide) for i in range(size // slide)])).alias("_part")).distinct()
        events = _raw(spark, base, table, since).withColumn("_part", F.window("event_ts", f"{slide} minutes")["start"])
        fresh = fn(events.join(parts, "_part", "left_semi").drop("_part", "batch_id")).join(windows, "window_start", "left_semi")
        fresh = fresh.select(*S.GOLD_SCHEMAS[table].fieldNames())
        stored = read_gold(spark, base, table)
        changed = fresh.exceptAll(stored).select("window_start").distinct()
        out = fresh.join(changed, "window_start", "left_semi").withColumn("window_date", F.to_date("window_start"))
        write_partitioned(out, repair_path(base, table), ("window_date", *spec.partition_cols))
    finally:
        windows.unpersist()


def read_repaired(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The stream's table with repaired windows in place of its own."""
    schema = S.GOLD_SCHEMAS[table]
    stored = read_gold(spark, base, table)
    full = T.StructType([*schema.fields, T.StructField("window_date", T.DateType())])
    try:
        repaired = spark.read.schema(full).parquet(repair_path(base, table)).select(*schema.fieldNames())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":  # nothing was ever late
            return stored
        raise
    return stored.join(repaired.select("window_start").distinct(), "window_start", "left_anti").select(
        *schema.fieldNames()).unionByName(repaired)
