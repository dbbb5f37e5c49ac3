"""Registered queries: stateful streams, bad records, backfill, health.

Each runs the real streaming queries over file topics made from the given
events; topics here repeat, delay or break some of the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux.operators import gold as G
from rideflux.plans import oracle as O
from rideflux.plans.catalog import register
from rideflux.plans.queries_gold import dirty_pings, silver
from rideflux.plans.queries_ops import SLICES, file_topic, files_per_slice, ntz, run_gold_stream
from rideflux.session import ensure_utc, run_dir, shuffle_partitions
from rideflux.sources.json_events import PARSERS
from rideflux.sources.readers import read_topic_stream, write_topic_files
from rideflux.streaming import backfill, jobs, quarantine, stateful
from rideflux.streaming.history import pipeline_health
from rideflux.streaming.sinks import read_sink, write_stream


def _number(prefix: str) -> str:
    """SQL: the number of an event id like ``REQ-17``."""
    return f"CAST(substr(event_id, {len(prefix) + 2}) AS BIGINT)"


def _decoded(spark: SparkSession, stream: str, topic: str) -> DataFrame:
    return PARSERS[stream](read_topic_stream(spark, stream, path=topic, max_per_trigger=files_per_slice(spark)))


def _run(spark: SparkSession, df: DataFrame, base: str, name: str) -> DataFrame:
    """Run a stream over its topics to completion and read its table."""
    with shuffle_partitions(spark, spark.sparkContext.defaultParallelism):
        jobs.run_available_now([write_stream(
            df, f"{base}/out/{name}", jobs.checkpoint_path(base, name), table_name=name, available_now=True)])
    return ntz(read_sink(spark, f"{base}/out/{name}", df.schema))


# --- duplicate deliveries ---------------------------------------------------------

def repeated_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of which one in twenty is delivered twice, half of the repeats
    a slice later; ``arrival`` is when."""
    rows = silver(spark, sf_dir, "ride_requests")
    again = rows.where(f"{_number('REQ')} % 20 = 0")
    lo, hi = rows.agg(F.min("event_ts"), F.max("event_ts")).first()
    later = f"{int((hi - lo).total_seconds()) // SLICES if lo else 0} SECONDS"
    return rows.withColumn("arrival", F.col("event_ts")).unionByName(again.withColumn("arrival", F.expr(
        f"least(IF({_number('REQ')} % 40 = 0, event_ts + INTERVAL {later}, event_ts), CAST('{hi}' AS TIMESTAMP_NTZ))")))


@register("stream_demand_dedup", O.stream_gold_select("ride_demand_by_zone"))
def stream_demand_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand over a topic that repeats records: as if each came once."""
    ensure_utc(spark)
    base = run_dir(spark, "stream-dedup")
    topic = file_topic(spark, sf_dir, "ride_requests", base, rows=repeated_requests(spark, sf_dir), arrival="arrival")
    once = stateful.distinct_events(_decoded(spark, "ride_requests", topic), "2 minutes")
    return _run(spark, G.ride_demand_by_zone(once), base, "demand")


# --- stream-stream join, timers, sessions -----------------------------------------

#: Records come up to half an hour out of order; the streams wait an hour.
_SHUFFLED = "event_ts + make_interval(0, 0, 0, 0, 0, 0, pmod(xxhash64(event_id), 1800))"


def shuffled_topic(spark: SparkSession, sf_dir: str, stream: str, base: str) -> DataFrame:
    return _decoded(spark, stream, file_topic(spark, sf_dir, stream, base, arrival=_SHUFFLED))


_MARK = """mark AS (SELECT least((SELECT max(epoch_ms(event_ts)) FROM req), (SELECT max(epoch_ms(event_ts)) FROM cmp))
                  - 3600000 AS ms),
clock AS (SELECT greatest((SELECT max(epoch_ms(event_ts)) FROM req), (SELECT max(epoch_ms(event_ts)) FROM cmp))
                  - 3600000 AS ms)"""


@register("stream_ride_lifecycle", O.with_ctes("req", "cmp", extra=[_MARK]) + f"""
SELECT r.ride_id, r.pickup_zone_id, r.ride_type, r.event_ts AS requested_at, c.event_ts AS finished_at,
       coalesce(c.status, r.status) AS status, r.estimated_fare, c.actual_fare,
       {O.R('c.actual_fare - r.estimated_fare', 2)} AS fare_delta
FROM req r LEFT JOIN cmp c ON c.ride_id = r.ride_id AND c.event_ts BETWEEN r.event_ts AND r.event_ts + INTERVAL '3 hours'
WHERE c.ride_id IS NOT NULL OR epoch_us(r.event_ts) <= ((SELECT ms FROM mark) - 3 * 3600000 - 1) * 1000""")
def stream_ride_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests joined to their outcomes as two streams, records out of order."""
    ensure_utc(spark)
    base = run_dir(spark, "stream-lifecycle")
    rides = stateful.ride_lifecycle_stream(shuffled_topic(spark, sf_dir, "ride_requests", base),
                                           shuffled_topic(spark, sf_dir, "ride_completed", base))
    return _run(spark, rides, base, "lifecycle")


@register("stream_overdue_rides", O.with_ctes("req", "cmp", extra=[_MARK]) + """
SELECT r.ride_id, r.pickup_zone_id, r.ride_type, r.event_ts AS requested_at, r.event_ts + INTERVAL '2 hours' AS overdue_at
FROM req r LEFT JOIN cmp c ON c.ride_id = r.ride_id AND c.event_ts <= r.event_ts + INTERVAL '2 hours'
WHERE c.ride_id IS NULL AND epoch_ms(r.event_ts) + 2 * 3600000 < (SELECT ms FROM clock)""")
def stream_overdue_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides without an outcome two hours after the request, by timers."""
    ensure_utc(spark)
    base = run_dir(spark, "stream-overdue")
    rides = stateful.overdue_rides(shuffled_topic(spark, sf_dir, "ride_requests", base),
                                   shuffled_topic(spark, sf_dir, "ride_completed", base), minutes=120)
    return _run(spark, rides, base, "overdue")


_SHIFTS = """islands AS (
  SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY driver_id ORDER BY event_ts, event_id ROWS UNBOUNDED PRECEDING) AS shift
  FROM (SELECT *, coalesce(event_ts - lag(event_ts) OVER (PARTITION BY driver_id ORDER BY event_ts, event_id)
                           > INTERVAL '30 minutes', true) AS fresh FROM png)),
shifts AS (
  SELECT driver_id, min(event_ts) AS shift_start, max(event_ts) AS last_ping, count(*) AS pings,
         count(*) FILTER (is_available) AS available_pings
  FROM islands GROUP BY driver_id, shift)"""


@register("driver_shifts", O.with_ctes("png", extra=[_SHIFTS]) + "SELECT * FROM shifts")
def driver_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stateful.driver_shifts(silver(spark, sf_dir, "driver_locations"))


@register("stream_driver_shifts", O.with_ctes("png", extra=[_SHIFTS]) + """
SELECT * FROM shifts WHERE epoch_us(last_ping) + 30 * 60000000 <= (SELECT (max(epoch_ms(event_ts)) - 600000) * 1000 FROM png)""")
def stream_driver_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts as a stream: those that no later ping can extend."""
    ensure_utc(spark)
    base = run_dir(spark, "stream-shifts")
    pings = _decoded(spark, "driver_locations", file_topic(spark, sf_dir, "driver_locations", base))
    return _run(spark, stateful.driver_shifts(pings), base, "shifts")


# --- bad records ------------------------------------------------------------------

@register("quarantine_driver_locations", O.with_ctes("png") + f"""
SELECT event_id, CASE n WHEN 0 THEN '{quarantine.MALFORMED}' WHEN 1 THEN '{quarantine.WRONG_TYPE}'
                        ELSE '{quarantine.BAD_TIME}' END AS reason, CASE WHEN n = 1 THEN event_ts END AS event_ts
FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) % 6 AS n FROM png) WHERE n IN (0, 1, 3)""")
def quarantine_driver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken records of a careless producer's topic, with the reason."""
    ensure_utc(spark)
    base = run_dir(spark, "quarantine")
    topic = f"{base}/topics/driver_locations"
    write_topic_files(dirty_pings(spark, sf_dir), topic, partitions=files_per_slice(spark))
    raw = read_topic_stream(spark, "driver_locations", path=topic, max_per_trigger=files_per_slice(spark) // 2 or 1)
    jobs.run_available_now([quarantine.start_checked_query(raw, "driver_locations", base, available_now=True)])
    return ntz(quarantine.read_quarantine(spark, base, "driver_locations")).select(
        F.regexp_extract("value", '"event_id":"([^"]*)"', 1).alias("event_id"), "reason", "event_ts")


# --- backfill -----------------------------------------------------------------------

def late_requests_run(spark: SparkSession, sf_dir: str) -> str:
    """Gold and raw streams over a topic where one request in fifty comes two
    slices of time late, so that its window is closed; returns the base folder."""
    ensure_utc(spark)
    base = run_dir(spark, "backfill")
    rows = silver(spark, sf_dir, "ride_requests")
    lo, hi = rows.agg(F.min("event_ts"), F.max("event_ts")).first()
    wait = 2 * int((hi - lo).total_seconds()) // SLICES if lo else 0
    late = f"IF({_number('REQ')} % 50 = 7, least(event_ts + INTERVAL {wait} SECONDS, CAST('{hi}' AS TIMESTAMP_NTZ)), event_ts)"
    topic = file_topic(spark, sf_dir, "ride_requests", base, arrival=late)
    parsed = _decoded(spark, "ride_requests", topic)
    with shuffle_partitions(spark, spark.sparkContext.defaultParallelism):
        jobs.run_available_now([jobs.start_gold_query(parsed, "ride_demand_by_zone", base, available_now=True),
                                jobs.start_raw_query(parsed, "ride_requests", base, available_now=True)])
    return base


@register("backfill_demand", O.stream_gold_select("ride_demand_by_zone"))
def backfill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand stream's table after late rows were put in by backfill."""
    base = late_requests_run(spark, sf_dir)
    backfill.backfill(spark, base, "ride_demand_by_zone")
    return ntz(backfill.read_repaired(spark, base, "ride_demand_by_zone"))


# --- health -------------------------------------------------------------------------

_HEALTH_SQL = O.stream_gold_select("ride_demand_by_zone")


@register("pipeline_health", f"""
SELECT 'ride_demand_by_zone' AS table_name, count(*) AS rows_written, true AS has_rate, true AS has_lag
FROM ({_HEALTH_SQL}) HAVING count(*) > 0""")
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, writes per hour and lag of the demand stream from its audit; the
    last two depend on the clock, so only that they are there is returned."""
    found = pipeline_health(spark, run_gold_stream(spark, sf_dir, "ride_demand_by_zone"))
    return found.select("table_name", "rows_written", (F.col("writes_per_hour") > 0).alias("has_rate"),
                        (F.col("max_lag_sec") >= 0).alias("has_lag"))
