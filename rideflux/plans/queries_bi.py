"""Registered queries: BI measures over gold tables computed from the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rideflux.plans import measures as M
from rideflux.plans.catalog import register
from rideflux.plans.oracle import AS_OF, AVGX, MONEY, PCT, R, with_ctes
from rideflux.plans.queries_gold import gold, gold_days

D = f"DATE '{AS_OF}'"
DAY = "CAST(window_start AS DATE)"


def _g(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return gold(spark, sf_dir, table)


@register("kpi_total_rides_today", with_ctes("demand") + (
    f"SELECT CAST(coalesce(sum(total_requests), 0) AS BIGINT) AS total_rides_today FROM demand WHERE {DAY} = {D}"))
def kpi_total_rides_today(spark, sf_dir):
    return M.total_rides_today(gold_days(spark, sf_dir, "ride_demand_by_zone", AS_OF, 1), AS_OF)


@register("kpi_total_revenue_today", with_ctes("revenue") + (
    f"SELECT coalesce({MONEY('total_revenue')}, 0.0e0) AS total_revenue_today FROM revenue WHERE {DAY} = {D}"))
def kpi_total_revenue_today(spark, sf_dir):
    return M.total_revenue_today(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 1), AS_OF)


@register("kpi_avg_surge", with_ctes("surge") + f"SELECT {R(AVGX('avg_surge'), 4)} AS avg_surge_multiplier FROM surge")
def kpi_avg_surge(spark, sf_dir):
    return M.avg_surge_multiplier(_g(spark, sf_dir, "surge_pricing_metrics"))


@register("kpi_avg_driver_rating", with_ctes("revenue") + (
    f"SELECT {R(AVGX('avg_driver_rating'), 4)} AS avg_driver_rating FROM revenue"))
def kpi_avg_driver_rating(spark, sf_dir):
    return M.avg_driver_rating(_g(spark, sf_dir, "revenue_analytics"))


@register("kpi_cancellation_rate", with_ctes("cancels") + (
    f"SELECT {R(PCT('sum(cancelled)', 'sum(total)'), 4)} AS cancellation_rate_pct FROM cancels"))
def kpi_cancellation_rate(spark, sf_dir):
    return M.cancellation_rate_pct(_g(spark, sf_dir, "cancellation_analytics"))


@register("kpi_avg_wait_time", with_ctes("revenue") + f"SELECT {R(AVGX('avg_wait_time'), 4)} AS avg_wait_time FROM revenue")
def kpi_avg_wait_time(spark, sf_dir):
    return M.avg_wait_time(_g(spark, sf_dir, "revenue_analytics"))


_THIS_W = f"{DAY} > {D} - 7 AND {DAY} <= {D}"
_LAST_W = f"{DAY} > {D} - 14 AND {DAY} <= {D} - 7"


@register("revenue_wow_change", with_ctes("revenue") + f"""
SELECT this_week_revenue, last_week_revenue,
       {R(PCT('this_week_revenue - last_week_revenue', 'last_week_revenue'), 4)} AS wow_change_pct
FROM (SELECT coalesce({MONEY(f'CASE WHEN {_THIS_W} THEN total_revenue END')}, 0.0e0) AS this_week_revenue,
             coalesce({MONEY(f'CASE WHEN {_LAST_W} THEN total_revenue END')}, 0.0e0) AS last_week_revenue
      FROM revenue WHERE ({_THIS_W}) OR ({_LAST_W}))""")
def revenue_wow_change(spark, sf_dir):
    return M.revenue_wow_change(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 14), AS_OF)


@register("peak_hour_demand", with_ctes("demand") + """
SELECT CAST(max(demand) AS BIGINT) AS peak_hour_demand
FROM (SELECT hour(window_start) AS h, sum(total_requests) AS demand FROM demand GROUP BY 1)""")
def peak_hour_demand(spark, sf_dir):
    return M.peak_hour_demand(_g(spark, sf_dir, "ride_demand_by_zone"))


@register("top_zone_by_revenue", with_ctes("revenue") + f"""
SELECT zone_id, {MONEY('total_revenue')} AS zone_revenue FROM revenue
GROUP BY zone_id ORDER BY zone_revenue DESC, zone_id LIMIT 1""")
def top_zone_by_revenue(spark, sf_dir):
    return M.top_zone_by_revenue(_g(spark, sf_dir, "revenue_analytics"))


HEATMAP_SQL = f"""SELECT zone_id, demand, {R(PCT('demand', 'max(demand) OVER ()'), 2)} AS heatmap_score
FROM (SELECT zone_id, CAST(sum(total_requests) AS BIGINT) AS demand FROM demand GROUP BY zone_id)"""


@register("demand_heatmap_score", with_ctes("demand") + HEATMAP_SQL)
def demand_heatmap_score(spark, sf_dir):
    return M.demand_heatmap_score(_g(spark, sf_dir, "ride_demand_by_zone"))


@register("high_surge_pct", with_ctes("surge") + (
    f"SELECT {R(PCT('sum(high_surge_count)', 'sum(total_rides)'), 4)} AS high_surge_pct FROM surge"))
def high_surge_pct(spark, sf_dir):
    return M.high_surge_pct(_g(spark, sf_dir, "surge_pricing_metrics"))


def tier_sql(x: str) -> str:
    return (f"CASE WHEN {x} >= 2.0e0 THEN 'Critical' WHEN {x} >= 1.5e0 THEN 'High' "
            f"WHEN {x} >= 1.2e0 THEN 'Moderate' ELSE 'Normal' END")


@register("surge_tier", with_ctes("surge") + f"""
SELECT {R('a', 4)} AS avg_surge_multiplier, {tier_sql('a')} AS surge_tier
FROM (SELECT {AVGX('avg_surge')} AS a FROM surge)""")
def surge_tier(spark, sf_dir):
    return M.surge_tier(_g(spark, sf_dir, "surge_pricing_metrics"))


@register("driver_availability_pct", with_ctes("density") + (
    f"SELECT {R(PCT('sum(available_drivers)', 'sum(driver_pings)'), 4)} AS driver_availability_pct FROM density"))
def driver_availability_pct(spark, sf_dir):
    return M.driver_availability_pct(_g(spark, sf_dir, "location_density"))


@register("avg_driver_speed", with_ctes("density") + f"SELECT {R(AVGX('avg_speed_kmh'), 4)} AS avg_driver_speed FROM density")
def avg_driver_speed(spark, sf_dir):
    return M.avg_driver_speed(_g(spark, sf_dir, "location_density"))
