"""Dashboard panel queries over gold (and, where marked, silver) tables.

Every function returns the rows one panel draws.  ``as_of`` is "today";
panels that cover a single day filter on it, the others take whatever slice
of the table the caller passes in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.functions.expressions import (
    as_date, availability_band, day_end, exact_avg, heatmap_band, in_trailing_days, money_sum, on_day, pct, ratio_or_zero,
    surge_tier,
)
from rideflux.operators.gold import EXACT_AVG
from rideflux.operators.joins import ride_lifecycle
from rideflux.plans.measures import demand_heatmap_score


def _day_shift(day, n: int):
    return F.date_sub(as_date(day), n)


def rides_vs_yesterday(demand: DataFrame, as_of) -> DataFrame:
    today, yday = on_day("window_start", as_of), F.to_date("window_start") == _day_shift(as_of, 1)
    zero = F.lit(0).cast("long")
    return (
        demand.where(today | yday)
        .agg(
            F.coalesce(F.sum(F.when(today, F.col("total_requests"))), zero).alias("rides_today"),
            F.coalesce(F.sum(F.when(yday, F.col("total_requests"))), zero).alias("rides_yesterday"),
        )
        .withColumn("change_pct",
                    F.round(pct(F.col("rides_today") - F.col("rides_yesterday"), F.col("rides_yesterday")), 4))
    )


def active_drivers(pings: DataFrame, as_of) -> DataFrame:
    """Distinct drivers pinging on the day, and how many were ever available.

    Two-step aggregate (per driver, then global) instead of two DISTINCT
    aggregates: the first step combines map-side, so a chatty driver costs
    one row per partition.
    """
    per_driver = (
        pings.where(on_day("event_ts", as_of) & F.col("driver_id").isNotNull())
        .groupBy("driver_id").agg(F.max("is_available").alias("available"))
    )
    return per_driver.agg(
        F.count(F.lit(1)).alias("active_drivers"),
        F.count_if(F.col("available")).alias("available_drivers"),
    ).withColumn("available_pct", F.round(pct("available_drivers", "active_drivers"), 2))


def cancel_rate_vs_last_week(cancels: DataFrame, as_of) -> DataFrame:
    this_w = in_trailing_days("window_start", as_of, 7, 0)
    last_w = in_trailing_days("window_start", as_of, 7, 7)

    def rate(cond):
        return pct(F.sum(F.when(cond, F.col("cancelled"))), F.sum(F.when(cond, F.col("total"))))

    return (
        cancels.where(this_w | last_w)
        .agg(rate(this_w).alias("_this"), rate(last_w).alias("_last"))
        .select(
            F.round("_this", 4).alias("rate_this_week"),
            F.round("_last", 4).alias("rate_last_week"),
            F.round(F.col("_this") - F.col("_last"), 4).alias("change_points"),
        )
    )


def hourly_volume_surge(demand: DataFrame) -> DataFrame:
    """Rides and request-weighted surge per hour of day."""
    return demand.groupBy(F.hour("window_start").alias("hour")).agg(
        F.sum("total_requests").alias("rides"),
        money_sum(F.col("avg_surge") * F.col("total_requests")).alias("_w"),
        F.sum(F.when(F.col("avg_surge").isNotNull(), F.col("total_requests"))).alias("_n"),
    ).select("hour", "rides", F.round(F.try_divide("_w", "_n"), 3).alias("avg_surge"))


def surge_by_ride_type(surge: DataFrame) -> DataFrame:
    return surge.groupBy("ride_type").agg(exact_avg("avg_surge").alias("_a")).select(
        "ride_type", F.round("_a", 4).alias("avg_surge_multiplier"), surge_tier("_a").alias("surge_tier"))


def revenue_by_hour(revenue: DataFrame, as_of) -> DataFrame:
    return (
        revenue.where(on_day("window_start", as_of))
        .groupBy(F.hour("window_start").alias("hour"))
        .agg(money_sum("total_revenue").alias("revenue"), F.sum("completed_rides").alias("rides"))
    )


def event_feed(requests: DataFrame, completed: DataFrame, pings: DataFrame, n: int = 8) -> DataFrame:
    """Newest ``n`` events of the three streams (top-k: each partition keeps
    its own best n, only those reach the final merge)."""
    k_request, k_done, k_cancel, k_ping = S.FEED_KINDS
    feed = (
        requests.selectExpr("event_ts", "event_id", f"'{k_request}' AS kind", "pickup_zone_id AS zone_id",
                            "ride_id AS subject")
        .unionByName(completed.selectExpr(
            "event_ts", "event_id",
            f"CASE WHEN status = '{S.STATUS_CANCELLED}' THEN '{k_cancel}' ELSE '{k_done}' END AS kind",
            "pickup_zone_id AS zone_id", "ride_id AS subject"))
        .unionByName(pings.selectExpr("event_ts", "event_id", f"'{k_ping}' AS kind", "zone_id",
                                      "driver_id AS subject"))
    )
    return feed.orderBy(F.col("event_ts").desc_nulls_last(), F.col("event_id")).limit(n)


def heatmap_band_by_zone(demand: DataFrame) -> DataFrame:
    return demand_heatmap_score(demand).withColumn("band", heatmap_band("heatmap_score"))


def availability_by_zone(density: DataFrame) -> DataFrame:
    return (
        density.groupBy("zone_id")
        .agg(F.sum("driver_pings").alias("pings"), F.sum("available_drivers").alias("available"))
        .withColumn("availability_pct", F.round(pct("available", "pings"), 2))
        .withColumn("band", availability_band("availability_pct"))
    )


def avg_fare_per_ride(revenue: DataFrame) -> DataFrame:
    return revenue.agg(
        F.round(ratio_or_zero(money_sum("total_revenue"), F.sum("completed_rides")), 2).alias("avg_fare_per_ride"))


def peak_revenue_hour(revenue: DataFrame, as_of) -> DataFrame:
    return (
        revenue_by_hour(revenue, as_of)
        .orderBy(F.col("revenue").desc(), F.col("hour"))
        .limit(1)
        .select(F.col("hour").alias("peak_hour"), F.col("revenue").alias("peak_revenue"))
    )


def surge_revenue_share(completed: DataFrame) -> DataFrame:
    """Share of completed-ride revenue earned on high-surge rides (silver)."""
    done = completed.where(F.col("status") == S.STATUS_COMPLETED)
    high = F.col("surge_multiplier") > F.lit(S.HIGH_SURGE_THRESHOLD)
    return done.agg(
        F.coalesce(money_sum(F.when(high, F.col("actual_fare"))), F.lit(0.0)).alias("surge_revenue"),
        F.coalesce(money_sum("actual_fare"), F.lit(0.0)).alias("total_revenue"),
    ).withColumn("surge_share_pct", F.round(pct("surge_revenue", "total_revenue"), 4))


def revenue_by_ride_type(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("ride_type").agg(
        money_sum("total_revenue").alias("revenue"), F.sum("completed_rides").alias("rides"))


def payment_mode_share(revenue: DataFrame) -> DataFrame:
    """Share of completed rides per payment mode (window over the few per-mode rows)."""
    per_mode = revenue.groupBy("payment_mode").agg(F.sum("completed_rides").alias("rides"))
    return per_mode.withColumn(
        "share_pct", F.round(pct(F.col("rides"), F.sum("rides").over(Window.partitionBy())), 2))


def revenue_hour_by_type(revenue: DataFrame) -> DataFrame:
    """Hourly revenue with one column per ride type, and ``Other`` for the rest
    (unknown and null types).

    A pivot over the known types written as conditional sums: one aggregate
    (partial → exchange → final) instead of the two levels ``pivot`` plans.
    """
    return revenue.groupBy(F.hour("window_start").alias("hour")).agg(*[
        F.coalesce(money_sum(F.when(F.col("ride_type") == t, F.col("total_revenue"))), F.lit(0.0)).alias(t)
        for t in S.RIDE_TYPES
    ], F.coalesce(money_sum(F.when(~F.coalesce(F.col("ride_type").isin(*S.RIDE_TYPES), F.lit(False)),
                                   F.col("total_revenue"))), F.lit(0.0)).alias("Other"))


def revenue_by_zone(revenue: DataFrame) -> DataFrame:
    return (
        revenue.groupBy("zone_id")
        .agg(money_sum("total_revenue").alias("revenue"), F.sum("completed_rides").alias("rides"))
        .orderBy(F.col("revenue").desc(), F.col("zone_id"))
    )


def cancel_rate_by_zone(cancels: DataFrame) -> DataFrame:
    return cancels.groupBy("zone_id").agg(
        F.sum("total").alias("total"), F.sum("cancelled").alias("cancelled"),
    ).withColumn("cancellation_rate", F.round(F.try_divide("cancelled", "total"), 4))


def wait_last_12h(revenue: DataFrame, as_of) -> DataFrame:
    """Mean of hourly average waits in the 12 hours up to ``as_of``: a point in
    time (datetime), or a date for the end of that day."""
    at = isinstance(as_of, dt.datetime)
    end = F.lit(as_of).cast("timestamp_ntz") if at else day_end(as_of)
    start = end - F.expr("INTERVAL 12 HOURS")
    return (
        revenue.where((F.col("window_start") >= start) & (F.col("window_start") < end))
        .groupBy("window_start")
        .agg(F.round(exact_avg("avg_wait_time"), 2).alias("avg_wait_time"))
    )


def rating_histogram(completed: DataFrame) -> DataFrame:
    """Completed rides per whole-star driver rating 1..5, empty bins kept.

    One global aggregate with a conditional count per bin, then the five
    counts are unpivoted: no join against a bin table.
    """
    stars = F.floor("driver_rating")
    done = completed.where(F.col("status") == S.STATUS_COMPLETED)
    counts = done.agg(*[F.count_if(stars == s).alias(f"s{s}") for s in range(1, 6)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(s).cast("long").alias("stars"), F.col(f"s{s}").alias("rides")) for s in range(1, 6)
    ])))


def ride_status_breakdown(requests: DataFrame, completed: DataFrame) -> DataFrame:
    return ride_lifecycle(requests, completed).groupBy("status").agg(F.count(F.lit(1)).alias("rides"))


def ops_stats(requests: DataFrame, completed: DataFrame, pings: DataFrame) -> DataFrame:
    """One row of pipeline health figures from the three silver streams.

    The streams are projected to a common shape and unioned so that a single
    aggregate computes every figure.
    """
    done = f"status = '{S.STATUS_COMPLETED}'"
    events = (
        requests.selectExpr("event_ts", "distance_km", "CAST(NULL AS DOUBLE) AS duration",
                            "CAST(NULL AS DOUBLE) AS rating")
        .unionByName(completed.selectExpr(
            "event_ts", "CAST(NULL AS DOUBLE) AS distance_km",
            f"CASE WHEN {done} THEN duration_minutes END AS duration",
            f"CASE WHEN {done} THEN driver_rating END AS rating"))
        .unionByName(pings.selectExpr("event_ts", "CAST(NULL AS DOUBLE) AS distance_km",
                                      "CAST(NULL AS DOUBLE) AS duration", "CAST(NULL AS DOUBLE) AS rating"))
    )
    micros = "unix_micros(CAST(event_ts AS TIMESTAMP))"

    def avg2(c: str) -> str:
        return f"round({EXACT_AVG.format(x=c)}, 2)"

    return events.agg(
        F.expr(f"{avg2('duration')} AS avg_trip_duration"),
        F.expr(f"{avg2('distance_km')} AS avg_distance_km"),
        F.expr(f"{avg2('rating')} AS avg_driver_rating"),
        F.expr("count(1) AS events"),
        F.expr(f"round(coalesce(try_divide(count(event_ts), (max({micros}) - min({micros})) / 1e6), 0.0D), 4)"
               " AS events_per_sec"),
    )
