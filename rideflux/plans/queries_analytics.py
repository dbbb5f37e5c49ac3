"""Registered queries: as-of join, complete axes, sketches, grouping sets, pruned feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators import analytics as A
from rideflux.plans import dashboard as D
from rideflux.plans import oracle as O
from rideflux.plans.catalog import register
from rideflux.plans.queries_gold import gold, gold_days, silver
from rideflux.session import run_dir


@register("surge_at_completion", O.with_ctes("req", "cmp", extra=["""newest AS (
  SELECT pickup_zone_id, event_ts, arg_max(surge_multiplier, event_id) AS surge FROM req GROUP BY 1, 2)"""]) + """
SELECT c.event_id, c.dropoff_zone_id, c.event_ts, n.surge AS zone_surge
FROM cmp c ASOF LEFT JOIN newest n ON n.pickup_zone_id = c.dropoff_zone_id AND c.event_ts >= n.event_ts""")
def surge_at_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surge in force in the zone where a ride ends, when it ends."""
    rides = silver(spark, sf_dir, "ride_completed").select("event_id", "dropoff_zone_id", "event_ts")
    surge = silver(spark, sf_dir, "ride_requests").selectExpr(
        "event_id", "pickup_zone_id AS dropoff_zone_id", "event_ts", "surge_multiplier")
    return A.as_of_join(rides, surge, "dropoff_zone_id", "surge_multiplier", "zone_surge")


def _with_holes(revenue: DataFrame) -> DataFrame:
    """Revenue without the windows whose hour is divisible by three: a day with holes."""
    return revenue.where(F.hour("window_start") % 3 != 0)


@register("revenue_by_hour_complete", O.with_ctes("revenue") + f"""
SELECT CAST(h AS INTEGER) AS hour, coalesce(revenue, 0.0e0) AS revenue, coalesce(rides, 0) AS rides
FROM range(24) t(h) LEFT JOIN (
  SELECT hour(window_start) AS hour, {O.MONEY('total_revenue')} AS revenue, CAST(sum(completed_rides) AS BIGINT) AS rides FROM revenue
  WHERE CAST(window_start AS DATE) = DATE '{O.AS_OF}' AND hour(window_start) % 3 <> 0 GROUP BY 1) r ON r.hour = h""")
def revenue_by_hour_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 24 hours of a day with holes, empty ones with zero."""
    revenue = _with_holes(gold_days(spark, sf_dir, "revenue_analytics", O.AS_OF, 1))
    return A.complete_hours(D.revenue_by_hour(revenue, O.AS_OF), zero=("revenue", "rides"))


_ZONE_IDS = ", ".join(f"'{z.zone_id}'" for z in S.ZONES)


@register("demand_by_zone_hour_complete", O.with_ctes("demand") + f"""
SELECT CAST(h AS INTEGER) AS hour, z AS zone_id, coalesce(requests, 0) AS requests
FROM range(24) t(h) CROSS JOIN (SELECT unnest([{_ZONE_IDS}]) AS z) LEFT JOIN (
  SELECT hour(window_start) AS hour, zone_id, CAST(sum(total_requests) AS BIGINT) AS requests FROM demand
  WHERE CAST(window_start AS DATE) = DATE '{O.AS_OF}' GROUP BY 1, 2) d ON d.hour = h AND d.zone_id = z""")
def demand_by_zone_hour_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand = gold_days(spark, sf_dir, "ride_demand_by_zone", O.AS_OF, 1)
    hours = demand.where(F.to_date("window_start") == F.lit(dt.date.fromisoformat(O.AS_OF))).groupBy(
        F.hour("window_start").alias("hour"), "zone_id").agg(F.sum("total_requests").alias("requests"))
    return A.complete_hours(hours, zero=("requests",), by={"zone_id": [z.zone_id for z in S.ZONES]})


@register("drivers_by_day_sketch", O.with_ctes("png") + """
SELECT CAST(event_ts AS DATE) AS day, count(DISTINCT driver_id) AS exact, true AS within FROM png GROUP BY 1""")
def drivers_by_day_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drivers per day from 5-minute sketches, held to the exact count."""
    pings = silver(spark, sf_dir, "driver_locations")
    merged = A.drivers_by(A.driver_sketches(pings), F.to_date("window_start").alias("day"))
    exact = pings.groupBy(F.to_date("event_ts").alias("day")).agg(F.count_distinct("driver_id").alias("exact"))
    return exact.join(merged, "day", "left").select(
        "day", "exact", (F.abs(F.col("drivers") - F.col("exact")) <= A.COUNT_ERROR * F.col("exact")).alias("within"))


@register("wait_quantiles_sketch", O.with_ctes("cmp") + """
SELECT pickup_zone_id AS zone_id, CAST(event_ts AS DATE) AS day, count(*) AS rides, true AS p50_within, true AS p95_within
FROM cmp WHERE status = 'COMPLETED' GROUP BY 1, 2""")
def wait_quantiles_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 95th percentile of the waiting time per zone and day from
    hourly sketches; their true ranks are held to the sketch's error."""
    completed = silver(spark, sf_dir, "ride_completed")
    day = F.to_date("window_start").alias("day")
    q = A.wait_quantiles(A.wait_sketches(completed), "zone_id", day)
    rides = completed.where(F.col("status") == S.STATUS_COMPLETED).select(
        F.col("pickup_zone_id").alias("zone_id"), F.to_date("event_ts").alias("day"), F.col("wait_time_minutes").alias("w"))
    ranks = rides.join(q.drop("rides"), ["zone_id", "day"]).groupBy("zone_id", "day").agg(
        F.count(F.lit(1)).alias("rides"),
        *[F.count_if(F.col("w") < F.col(p)).alias(f"{p}_lo") for p in ("p50", "p95")],
        *[F.count_if(F.col("w") <= F.col(p)).alias(f"{p}_hi") for p in ("p50", "p95")])

    def within(p: str, share: float):
        # The share lies between the ranks of values below and up to the quantile.
        return ((F.col(f"{p}_lo") <= (share + A.RANK_ERROR) * F.col("rides") + 1)
                & (F.col(f"{p}_hi") >= (share - A.RANK_ERROR) * F.col("rides") - 1)).alias(f"{p}_within")

    return ranks.select("zone_id", "day", "rides", within("p50", 0.5), within("p95", 0.95))


@register("revenue_rollup", O.with_ctes("revenue") + f"""
SELECT CAST(window_start AS DATE) AS day, zone_id, ride_type, CAST(grouping(CAST(window_start AS DATE), zone_id, ride_type) AS BIGINT) AS level,
       CAST(sum(completed_rides) AS BIGINT) AS rides, {O.MONEY('total_revenue')} AS revenue
FROM revenue GROUP BY ROLLUP (CAST(window_start AS DATE), zone_id, ride_type)""")
def revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.revenue_rollup(gold(spark, sf_dir, "revenue_analytics"))


@register("event_feed_pruned", O.with_ctes("req", "cmp", "png") + """
SELECT * FROM (
  SELECT event_ts, event_id, 'request' AS kind, pickup_zone_id AS zone_id, ride_id AS subject FROM req
  UNION ALL SELECT event_ts, event_id, CASE WHEN status = 'CANCELLED' THEN 'cancel' ELSE 'done' END, pickup_zone_id, ride_id FROM cmp
  UNION ALL SELECT event_ts, event_id, 'ping', zone_id, driver_id FROM png)
ORDER BY event_ts DESC NULLS LAST, event_id LIMIT 8""")
def event_feed_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events from silver tables stored by date, older dates unread."""
    base = run_dir(spark, "silver-by-date")
    tables = {}
    for s in ("ride_requests", "ride_completed", "driver_locations"):
        A.write_by_date(silver(spark, sf_dir, s), f"{base}/{s}")
        tables[s] = spark.read.parquet(f"{base}/{s}")
    return A.pruned_feed(tables)
