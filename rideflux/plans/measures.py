"""BI measures over the gold tables.

A measure is a function of gold DataFrames (already filtered to the report's
context by the caller: a zone, a ride type, a date range) and returns a
one-row DataFrame, or one row per group for the measures a visual slices.
``as_of`` stands for "today" and is always a parameter.

Conventions: ``DIVIDE(a, b, 0)`` → :func:`ratio_or_zero`; percentages are
rounded to 4 decimals, money is summed exactly (:func:`money_sum`).
Measures that average per-window averages do so unweighted, as defined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rideflux.functions.expressions import (
    exact_avg, in_trailing_days, money_sum, on_day, pct, surge_tier as tier_of,
)


def total_rides_today(demand: DataFrame, as_of) -> DataFrame:
    return demand.where(on_day("window_start", as_of)).agg(
        F.coalesce(F.sum("total_requests"), F.lit(0).cast("long")).alias("total_rides_today"))


def total_revenue_today(revenue: DataFrame, as_of) -> DataFrame:
    return revenue.where(on_day("window_start", as_of)).agg(
        F.coalesce(money_sum("total_revenue"), F.lit(0.0)).alias("total_revenue_today"))


def avg_surge_multiplier(surge: DataFrame) -> DataFrame:
    return surge.agg(F.round(exact_avg("avg_surge"), 4).alias("avg_surge_multiplier"))


def avg_driver_rating(revenue: DataFrame) -> DataFrame:
    return revenue.agg(F.round(exact_avg("avg_driver_rating"), 4).alias("avg_driver_rating"))


def cancellation_rate_pct(cancels: DataFrame) -> DataFrame:
    return cancels.agg(F.round(pct(F.sum("cancelled"), F.sum("total")), 4).alias("cancellation_rate_pct"))


def avg_wait_time(revenue: DataFrame) -> DataFrame:
    return revenue.agg(F.round(exact_avg("avg_wait_time"), 4).alias("avg_wait_time"))


def revenue_wow_change(revenue: DataFrame, as_of) -> DataFrame:
    """Revenue of the 7 whole days ending ``as_of`` vs the 7 days before."""
    this_w = in_trailing_days("window_start", as_of, 7, 0)
    last_w = in_trailing_days("window_start", as_of, 7, 7)
    return (
        revenue.where(this_w | last_w)
        .agg(
            F.coalesce(money_sum(F.when(this_w, F.col("total_revenue"))), F.lit(0.0)).alias("this_week_revenue"),
            F.coalesce(money_sum(F.when(last_w, F.col("total_revenue"))), F.lit(0.0)).alias("last_week_revenue"),
        )
        .withColumn(
            "wow_change_pct",
            F.round(pct(F.col("this_week_revenue") - F.col("last_week_revenue"), F.col("last_week_revenue")), 4),
        )
    )


def demand_by_hour(demand: DataFrame) -> DataFrame:
    return demand.groupBy(F.hour("window_start").alias("hour")).agg(F.sum("total_requests").alias("demand"))


def peak_hour_demand(demand: DataFrame) -> DataFrame:
    """Largest hour-of-day demand, all days pooled (aggregate over an aggregate)."""
    return demand_by_hour(demand).agg(F.max("demand").alias("peak_hour_demand"))


def zone_revenue(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("zone_id").agg(money_sum("total_revenue").alias("zone_revenue"))


def top_zone_by_revenue(revenue: DataFrame) -> DataFrame:
    """Zone with the most revenue; a tie goes to the smaller zone id."""
    return zone_revenue(revenue).orderBy(F.col("zone_revenue").desc(), F.col("zone_id")).limit(1)


def demand_heatmap_score(demand: DataFrame) -> DataFrame:
    """Zone demand as a percentage of the busiest zone's demand.

    The max over *all* zones is a window over the per-zone totals (one row
    per zone), so the un-partitioned window only ever sees those few rows.
    """
    per_zone = demand.groupBy("zone_id").agg(F.sum("total_requests").alias("demand"))
    return per_zone.withColumn(
        "heatmap_score", F.round(pct(F.col("demand"), F.max("demand").over(Window.partitionBy())), 2))


def high_surge_pct(surge: DataFrame) -> DataFrame:
    return surge.agg(F.round(pct(F.sum("high_surge_count"), F.sum("total_rides")), 4).alias("high_surge_pct"))


def surge_tier(surge: DataFrame, *group_cols: str) -> DataFrame:
    """Average surge and its tier, overall or per ``group_cols``."""
    g = surge.groupBy(*group_cols) if group_cols else surge
    return g.agg(exact_avg("avg_surge").alias("_avg")).select(
        *group_cols,
        F.round("_avg", 4).alias("avg_surge_multiplier"),
        tier_of(F.col("_avg")).alias("surge_tier"),
    )


def driver_availability_pct(density: DataFrame) -> DataFrame:
    return density.agg(
        F.round(pct(F.sum("available_drivers"), F.sum("driver_pings")), 4).alias("driver_availability_pct"))


def avg_driver_speed(density: DataFrame) -> DataFrame:
    return density.agg(F.round(exact_avg("avg_speed_kmh"), 4).alias("avg_driver_speed"))
