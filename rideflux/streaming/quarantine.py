"""Bad records set apart: one decoding pass into a clean and a bad table.

A record is bad when it is no JSON object, has a field of the wrong type, or
no readable event time.  Such records never enter a window; here they are
kept as they came, with the reason, and counted in the audit.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rideflux import schemas as S
from rideflux.functions.expressions import parse_event_time
from rideflux.sources.json_events import with_pickup
from rideflux.streaming.jobs import RAW_TRIGGER_SECS, audit_path, checkpoint_path
from rideflux.streaming.sinks import append_audit, write_partitioned

EMPTY, MALFORMED, WRONG_TYPE, NO_TIME, BAD_TIME = (
    "empty record", "malformed json", "wrong type", "no time", "unreadable time")


def decode_checked(raw: DataFrame, stream: str) -> DataFrame:
    """The stream's silver columns, and ``reason`` and ``value`` of bad records
    (both null for good ones).

    The reason is the first that holds: the record is empty, is no JSON
    object, has a field of another type than declared (that field is null,
    the others are kept), has no time, has one that cannot be read.  A
    declared field that is missing is null and no fault.
    """
    declared = S.STREAM_SCHEMAS[stream]
    schema = T.StructType([*declared.fields, T.StructField("_broken", T.StringType())])
    rows = raw.select(F.col("value").cast("string").alias("value")).withColumn("_record", F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    rows = rows.select("value", "_record.*").withColumn("event_ts", parse_event_time("timestamp"))
    if stream == "ride_requests":
        rows = with_pickup(rows)
    any_field = reduce(or_, (F.col(f).isNotNull() for f in declared.fieldNames()))
    reason = (F.when(F.coalesce(F.trim("value"), F.lit("")) == "", EMPTY)
              .when(F.col("_broken").isNotNull() & ~any_field, MALFORMED)
              .when(F.col("_broken").isNotNull(), WRONG_TYPE)
              .when(F.col("timestamp").isNull(), NO_TIME)
              .when(F.col("event_ts").isNull(), BAD_TIME))
    silver = [c for c in rows.columns if c not in ("value", "_broken")]
    return rows.withColumn("reason", reason).select(
        *silver, "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"))


def checked_path(base: str, stream: str) -> str:
    return f"{base}/checked/{stream}"


def start_checked_query(raw: DataFrame, stream: str, base: str, *, available_now: bool = False,
                        trigger_secs: int = RAW_TRIGGER_SECS) -> StreamingQuery:
    """Decode a topic once into a clean and a bad table.

    One write per micro-batch, partitioned by quality and batch (a retried
    batch replaces itself).  Audit rows count the batch's clean records
    (``clean_<stream>``), its bad ones (``quarantine_<stream>``) and among
    those the ones without a readable time (``untimed_<stream>``).
    """
    counts = {
        f"clean_{stream}": F.count_if(F.col("reason").isNull()),
        f"quarantine_{stream}": F.count_if(F.col("reason").isNotNull()),
        f"untimed_{stream}": F.count_if(F.col("reason").isNotNull() & F.col("event_ts").isNull()),
    }

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        seen = Observation()
        out = batch_df.observe(seen, *[c.alias(name) for name, c in counts.items()])
        quality = F.when(F.col("reason").isNull(), "clean").otherwise("bad")
        write_partitioned(out.withColumn("quality", quality).withColumn("batch_id", F.lit(batch_id).cast("long")),
                          checked_path(base, stream), ("quality", "batch_id"))
        try:
            found = seen.get
        except Py4JJavaError:  # an input known to be empty runs no count
            found = {}
        for name, n in found.items():
            if n:
                append_audit(spark, audit_path(base), name, batch_id, {"num_rows": n})

    w = decode_checked(raw, stream).writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint_path(base, f"checked_{stream}")).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_secs} seconds")
    return w.start()


def _checked(spark: SparkSession, base: str, stream: str, quality: str) -> DataFrame:
    empty = decode_checked(spark.createDataFrame([], "value string"), stream)
    full = T.StructType([*empty.schema.fields, T.StructField("quality", T.StringType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(checked_path(base, stream)).where(F.col("quality") == quality)


def read_clean(spark: SparkSession, base: str, stream: str) -> DataFrame:
    """Silver rows of the good records."""
    return _checked(spark, base, stream, "clean").drop("reason", "value", "quality", "batch_id")


def read_quarantine(spark: SparkSession, base: str, stream: str) -> DataFrame:
    """Bad records: ``reason, value, event_ts, batch_id``."""
    return _checked(spark, base, stream, "bad").select("reason", "value", "event_ts", "batch_id")
