"""Registered queries: dashboard panels, joins, pricing rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.functions.expressions import expected_fare, rule_surge
from rideflux.operators import joins as J
from rideflux.plans import dashboard as DB
from rideflux.plans.catalog import register
from rideflux.plans.oracle import AS_OF, AVGX, MONEY, PCT, R, RATIO, with_ctes
from rideflux.plans.queries_bi import HEATMAP_SQL, tier_sql
from rideflux.plans.queries_gold import gold, gold_days, silver

D = f"DATE '{AS_OF}'"
DAY = "CAST(window_start AS DATE)"
HOUR = "CAST(hour(window_start) AS INTEGER)"


def _req(spark, sf_dir):
    return silver(spark, sf_dir, "ride_requests")


def _cmp(spark, sf_dir):
    return silver(spark, sf_dir, "ride_completed")


def _png(spark, sf_dir):
    return silver(spark, sf_dir, "driver_locations")


@register("rides_vs_yesterday", with_ctes("demand") + f"""
SELECT rides_today, rides_yesterday, {R(PCT('rides_today - rides_yesterday', 'rides_yesterday'), 4)} AS change_pct
FROM (SELECT CAST(coalesce(sum(CASE WHEN {DAY} = {D} THEN total_requests END), 0) AS BIGINT) AS rides_today,
             CAST(coalesce(sum(CASE WHEN {DAY} = {D} - 1 THEN total_requests END), 0) AS BIGINT) AS rides_yesterday
      FROM demand WHERE {DAY} = {D} OR {DAY} = {D} - 1)""")
def rides_vs_yesterday(spark, sf_dir):
    return DB.rides_vs_yesterday(gold_days(spark, sf_dir, "ride_demand_by_zone", AS_OF, 2), AS_OF)


@register("active_drivers", with_ctes("png") + f"""
SELECT count(*) AS active_drivers, count(*) FILTER (WHERE available) AS available_drivers,
       {R(PCT('count(*) FILTER (WHERE available)', 'count(*)'), 2)} AS available_pct
FROM (SELECT driver_id, bool_or(is_available) AS available FROM png
      WHERE CAST(event_ts AS DATE) = {D} AND driver_id IS NOT NULL GROUP BY driver_id)""")
def active_drivers(spark, sf_dir):
    return DB.active_drivers(_png(spark, sf_dir), AS_OF)


_THIS_W = f"{DAY} > {D} - 7 AND {DAY} <= {D}"
_LAST_W = f"{DAY} > {D} - 14 AND {DAY} <= {D} - 7"


def _rate_sql(cond: str) -> str:
    return PCT(f"sum(CASE WHEN {cond} THEN cancelled END)", f"sum(CASE WHEN {cond} THEN total END)")


@register("cancel_rate_vs_last_week", with_ctes("cancels") + f"""
SELECT {R('t', 4)} AS rate_this_week, {R('l', 4)} AS rate_last_week, {R('t - l', 4)} AS change_points
FROM (SELECT {_rate_sql(_THIS_W)} AS t, {_rate_sql(_LAST_W)} AS l FROM cancels
      WHERE ({_THIS_W}) OR ({_LAST_W}))""")
def cancel_rate_vs_last_week(spark, sf_dir):
    return DB.cancel_rate_vs_last_week(gold_days(spark, sf_dir, "cancellation_analytics", AS_OF, 14), AS_OF)


@register("hourly_volume_surge", with_ctes("demand") + f"""
SELECT hour, rides, {R('w / nullif(n, 0)', 3)} AS avg_surge
FROM (SELECT {HOUR} AS hour, CAST(sum(total_requests) AS BIGINT) AS rides,
             CAST(sum(CAST(avg_surge AS DECIMAL(18,3)) * total_requests) AS DOUBLE) AS w,
             sum(total_requests) FILTER (avg_surge IS NOT NULL) AS n
      FROM demand GROUP BY 1)""")
def hourly_volume_surge(spark, sf_dir):
    return DB.hourly_volume_surge(gold(spark, sf_dir, "ride_demand_by_zone"))


@register("surge_by_ride_type", with_ctes("surge") + f"""
SELECT ride_type, {R('a', 4)} AS avg_surge_multiplier, {tier_sql('a')} AS surge_tier
FROM (SELECT ride_type, {AVGX('avg_surge')} AS a FROM surge GROUP BY ride_type)""")
def surge_by_ride_type(spark, sf_dir):
    return DB.surge_by_ride_type(gold(spark, sf_dir, "surge_pricing_metrics"))


_REV_BY_HOUR = f"""SELECT {HOUR} AS hour, {MONEY('total_revenue')} AS revenue,
       CAST(sum(completed_rides) AS BIGINT) AS rides
FROM revenue WHERE {DAY} = {D} GROUP BY 1"""


@register("revenue_by_hour", with_ctes("revenue") + _REV_BY_HOUR)
def revenue_by_hour(spark, sf_dir):
    return DB.revenue_by_hour(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 1), AS_OF)


@register("event_feed", with_ctes("req", "cmp", "png") + """
SELECT * FROM (
  SELECT event_ts, event_id, 'request' AS kind, pickup_zone_id AS zone_id, ride_id AS subject FROM req
  UNION ALL
  SELECT event_ts, event_id, CASE WHEN status = 'CANCELLED' THEN 'cancel' ELSE 'done' END,
         pickup_zone_id, ride_id FROM cmp
  UNION ALL
  SELECT event_ts, event_id, 'ping', zone_id, driver_id FROM png)
ORDER BY event_ts DESC NULLS LAST, event_id LIMIT 8""")
def event_feed(spark, sf_dir):
    return DB.event_feed(_req(spark, sf_dir), _cmp(spark, sf_dir), _png(spark, sf_dir), 8)


def _band_sql(x: str) -> str:
    cases = " ".join(f"WHEN {x} / 100.0e0 < {c!r}e0 THEN {i}" for i, c in enumerate(S.HEATMAP_CUTS))
    return f"CASE {cases} ELSE {len(S.HEATMAP_CUTS)} END"


@register("heatmap_band", with_ctes("demand") + f"""
SELECT zone_id, demand, heatmap_score, {_band_sql('heatmap_score')} AS band FROM ({HEATMAP_SQL})""")
def heatmap_band(spark, sf_dir):
    return DB.heatmap_band_by_zone(gold(spark, sf_dir, "ride_demand_by_zone"))


@register("availability_by_zone", with_ctes("density") + f"""
SELECT zone_id, pings, available, availability_pct,
       CASE WHEN availability_pct > 70.0e0 THEN 'high' WHEN availability_pct > 50.0e0 THEN 'medium' ELSE 'low' END
         AS band
FROM (SELECT zone_id, CAST(sum(driver_pings) AS BIGINT) AS pings, CAST(sum(available_drivers) AS BIGINT) AS available,
             {R(PCT('sum(available_drivers)', 'sum(driver_pings)'), 2)} AS availability_pct
      FROM density GROUP BY zone_id)""")
def availability_by_zone(spark, sf_dir):
    return DB.availability_by_zone(gold(spark, sf_dir, "location_density"))


@register("avg_fare_per_ride", with_ctes("revenue") + (
    f"SELECT {R(RATIO(MONEY('total_revenue'), 'sum(completed_rides)'), 2)} AS avg_fare_per_ride FROM revenue"))
def avg_fare_per_ride(spark, sf_dir):
    return DB.avg_fare_per_ride(gold(spark, sf_dir, "revenue_analytics"))


@register("peak_revenue_hour", with_ctes("revenue") + f"""
SELECT hour AS peak_hour, revenue AS peak_revenue FROM ({_REV_BY_HOUR}) ORDER BY revenue DESC, hour LIMIT 1""")
def peak_revenue_hour(spark, sf_dir):
    return DB.peak_revenue_hour(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 1), AS_OF)


@register("surge_revenue_share", with_ctes("cmp") + f"""
SELECT surge_revenue, total_revenue, {R(PCT('surge_revenue', 'total_revenue'), 4)} AS surge_share_pct
FROM (SELECT coalesce({MONEY('CASE WHEN surge_multiplier > 1.5e0 THEN actual_fare END')}, 0.0e0) AS surge_revenue,
             coalesce({MONEY('actual_fare')}, 0.0e0) AS total_revenue
      FROM cmp WHERE status = 'COMPLETED')""")
def surge_revenue_share(spark, sf_dir):
    return DB.surge_revenue_share(_cmp(spark, sf_dir))


@register("revenue_by_ride_type", with_ctes("revenue") + f"""
SELECT ride_type, {MONEY('total_revenue')} AS revenue, CAST(sum(completed_rides) AS BIGINT) AS rides
FROM revenue GROUP BY ride_type""")
def revenue_by_ride_type(spark, sf_dir):
    return DB.revenue_by_ride_type(gold(spark, sf_dir, "revenue_analytics"))


@register("payment_mode_share", with_ctes("revenue") + f"""
SELECT payment_mode, rides, {R(PCT('rides', 'sum(rides) OVER ()'), 2)} AS share_pct
FROM (SELECT payment_mode, CAST(sum(completed_rides) AS BIGINT) AS rides FROM revenue GROUP BY payment_mode)""")
def payment_mode_share(spark, sf_dir):
    return DB.payment_mode_share(gold(spark, sf_dir, "revenue_analytics"))


_PIVOT_COLS = ", ".join(
    f"coalesce({MONEY(f'CASE WHEN ride_type = {chr(39)}{t}{chr(39)} THEN total_revenue END')}, 0.0e0) AS \"{t}\""
    for t in S.RIDE_TYPES) + f""", coalesce({MONEY(
    "CASE WHEN coalesce(ride_type, '') NOT IN (" + ", ".join(f"'{t}'" for t in S.RIDE_TYPES) + ") THEN total_revenue END")}, 0.0e0) AS "Other\""""


@register("revenue_hour_by_type", with_ctes("revenue") + f"SELECT {HOUR} AS hour, {_PIVOT_COLS} FROM revenue GROUP BY 1")
def revenue_hour_by_type(spark, sf_dir):
    return DB.revenue_hour_by_type(gold(spark, sf_dir, "revenue_analytics"))


@register("revenue_by_zone", with_ctes("revenue") + f"""
SELECT zone_id, {MONEY('total_revenue')} AS revenue, CAST(sum(completed_rides) AS BIGINT) AS rides
FROM revenue GROUP BY zone_id""")
def revenue_by_zone(spark, sf_dir):
    return DB.revenue_by_zone(gold(spark, sf_dir, "revenue_analytics"))


@register("cancel_rate_by_zone", with_ctes("cancels") + f"""
SELECT zone_id, CAST(sum(total) AS BIGINT) AS total, CAST(sum(cancelled) AS BIGINT) AS cancelled,
       {R('CAST(sum(cancelled) AS DOUBLE) / sum(total)', 4)} AS cancellation_rate
FROM cancels GROUP BY zone_id""")
def cancel_rate_by_zone(spark, sf_dir):
    return DB.cancel_rate_by_zone(gold(spark, sf_dir, "cancellation_analytics"))


@register("wait_last_12h", with_ctes("revenue") + f"""
SELECT window_start, {R(AVGX('avg_wait_time'), 2)} AS avg_wait_time FROM revenue
WHERE window_start >= CAST({D} + 1 AS TIMESTAMP) - INTERVAL '12 hours' AND window_start < CAST({D} + 1 AS TIMESTAMP)
GROUP BY window_start""")
def wait_last_12h(spark, sf_dir):
    return DB.wait_last_12h(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 1), AS_OF)


@register("wait_last_12h_at", with_ctes("revenue") + f"""
SELECT window_start, {R(AVGX('avg_wait_time'), 2)} AS avg_wait_time FROM revenue
WHERE window_start >= CAST({D} AS TIMESTAMP) - INTERVAL '4 hours' AND window_start < CAST({D} AS TIMESTAMP) + INTERVAL '8 hours'
GROUP BY window_start""")
def wait_last_12h_at(spark, sf_dir):
    """Up to 08:00 of the day."""
    at = dt.datetime.combine(dt.date.fromisoformat(AS_OF), dt.time(8))
    return DB.wait_last_12h(gold_days(spark, sf_dir, "revenue_analytics", AS_OF, 2), at)


@register("rating_histogram", with_ctes("cmp") + """
SELECT b.stars, coalesce(c.rides, 0) AS rides
FROM (SELECT CAST(i AS BIGINT) AS stars FROM range(1, 6) t(i)) b
LEFT JOIN (SELECT CAST(floor(driver_rating) AS BIGINT) AS stars, count(*) AS rides FROM cmp
           WHERE status = 'COMPLETED' GROUP BY 1) c ON b.stars = c.stars""")
def rating_histogram(spark, sf_dir):
    return DB.rating_histogram(_cmp(spark, sf_dir))


_LIFECYCLE_SQL = """lifecycle AS (
  SELECT r.ride_id, r.pickup_zone_id, r.ride_type, r.event_ts AS requested_at, c.event_ts AS finished_at,
         coalesce(c.status, r.status) AS status, r.estimated_fare, c.actual_fare,
         {fare_delta} AS fare_delta
  FROM (SELECT * FROM req QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY event_ts NULLS FIRST,
                                                     event_id NULLS FIRST) = 1) r
  LEFT JOIN (SELECT * FROM cmp QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY event_ts DESC NULLS LAST,
                                                          event_id DESC NULLS LAST) = 1) c
  ON r.ride_id = c.ride_id
)""".format(fare_delta=R("c.actual_fare - r.estimated_fare", 2))


@register("ride_status_breakdown", with_ctes("req", "cmp", extra=[_LIFECYCLE_SQL]) + (
    "SELECT status, count(*) AS rides FROM lifecycle GROUP BY status"))
def ride_status_breakdown(spark, sf_dir):
    return DB.ride_status_breakdown(_req(spark, sf_dir), _cmp(spark, sf_dir))


@register("ops_stats", with_ctes("req", "cmp", "png") + f"""
SELECT {R(AVGX('duration'), 2)} AS avg_trip_duration, {R(AVGX('distance_km'), 2)} AS avg_distance_km,
       {R(AVGX('rating'), 2)} AS avg_driver_rating, count(*) AS events,
       {R(RATIO('count(event_ts)', '(epoch_us(max(event_ts)) - epoch_us(min(event_ts))) / 1e6'), 4)} AS events_per_sec
FROM (SELECT event_ts, distance_km, NULL::DOUBLE AS duration, NULL::DOUBLE AS rating FROM req
      UNION ALL
      SELECT event_ts, NULL, CASE WHEN status = 'COMPLETED' THEN duration_minutes END,
             CASE WHEN status = 'COMPLETED' THEN driver_rating END FROM cmp
      UNION ALL
      SELECT event_ts, NULL, NULL, NULL FROM png)""")
def ops_stats(spark, sf_dir):
    return DB.ops_stats(_req(spark, sf_dir), _cmp(spark, sf_dir), _png(spark, sf_dir))


# --- joins -------------------------------------------------------------------

_ZONE_SQL = f"""
SELECT coalesce(d.zone_id, r.zone_id, c.zone_id) AS zone_id, d.requests, d.avg_fare, d.avg_surge, r.revenue,
       c.cancel_rate,
       CASE WHEN c.cancel_rate > 0.18e0 THEN 'high' WHEN c.cancel_rate > 0.13e0 THEN 'elevated' ELSE 'normal' END
         AS cancel_flag,
       d.avg_surge >= 1.5e0 AS high_surge
FROM (SELECT zone_id, CAST(sum(total_requests) AS BIGINT) AS requests,
             {R('CAST(sum(CAST(avg_estimated_fare AS DECIMAL(18,2)) * total_requests) AS DOUBLE) / nullif(sum(total_requests) FILTER (avg_estimated_fare IS NOT NULL), 0)', 2)}
               AS avg_fare,
             {R('CAST(sum(CAST(avg_surge AS DECIMAL(18,3)) * total_requests) AS DOUBLE) / nullif(sum(total_requests) FILTER (avg_surge IS NOT NULL), 0)', 3)}
               AS avg_surge
      FROM demand GROUP BY zone_id) d
FULL OUTER JOIN (SELECT zone_id, {MONEY('total_revenue')} AS revenue FROM revenue GROUP BY zone_id) r
  ON d.zone_id = r.zone_id
FULL OUTER JOIN (SELECT zone_id, {R('CAST(sum(cancelled) AS DOUBLE) / sum(total)', 4)} AS cancel_rate
                 FROM cancels GROUP BY zone_id) c
  ON coalesce(d.zone_id, r.zone_id) = c.zone_id"""


@register("zone_performance", with_ctes("demand", "revenue", "cancels") + _ZONE_SQL)
def zone_performance(spark, sf_dir):
    return J.zone_performance(gold(spark, sf_dir, "ride_demand_by_zone"), gold(spark, sf_dir, "revenue_analytics"),
                              gold(spark, sf_dir, "cancellation_analytics"))


@register("ride_lifecycle", with_ctes("req", "cmp", extra=[_LIFECYCLE_SQL]) + "SELECT * FROM lifecycle")
def ride_lifecycle(spark, sf_dir):
    return J.ride_lifecycle(_req(spark, sf_dir), _cmp(spark, sf_dir))


@register("assign_zone", with_ctes("png") + """
SELECT p.event_id, p.latitude, p.longitude, p.zone_id, min(z.zone_id) AS assigned_zone_id
FROM png p LEFT JOIN zones z
  ON p.latitude BETWEEN z.lat_lo AND z.lat_hi AND p.longitude BETWEEN z.lng_lo AND z.lng_hi
GROUP BY p.event_id, p.latitude, p.longitude, p.zone_id""")
def assign_zone(spark, sf_dir):
    pings = _png(spark, sf_dir).select("event_id", "latitude", "longitude", "zone_id")
    return J.assign_zone(pings)


# The same joins on inputs with duplicate, missing and one-sided keys.

_DIRTY_REQ_SQL = """dreq0 AS (SELECT * REPLACE (CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 7 <> 0 THEN ride_id END AS ride_id)
           FROM req),
dreq AS (SELECT * FROM dreq0 UNION ALL SELECT * FROM dreq0 WHERE CAST(substr(event_id, 5) AS BIGINT) % 5 = 0)"""


def _dirty_req(spark, sf_dir):
    r = _req(spark, sf_dir).withColumn("ride_id", F.expr("IF(CAST(substr(event_id, 5) AS BIGINT) % 7 <> 0, ride_id, NULL)"))
    return r.unionByName(r.where("CAST(substr(event_id, 5) AS BIGINT) % 5 = 0"))


@register("ride_lifecycle_dirty", with_ctes("req", "cmp", extra=[_DIRTY_REQ_SQL, _LIFECYCLE_SQL.replace(
    "FROM (SELECT * FROM req QUALIFY", "FROM (SELECT * FROM dreq WHERE ride_id IS NOT NULL QUALIFY")]) + """
SELECT * FROM lifecycle
UNION ALL
SELECT ride_id, pickup_zone_id, ride_type, event_ts, NULL, status, estimated_fare, NULL, NULL FROM dreq WHERE ride_id IS NULL""")
def ride_lifecycle_dirty(spark, sf_dir):
    return J.ride_lifecycle(_dirty_req(spark, sf_dir), _cmp(spark, sf_dir))


@register("assign_zone_by_table", with_ctes("png") + """
SELECT event_id, latitude, longitude, zone_id,
       (SELECT min(z.zone_id) FROM zones z WHERE p.latitude BETWEEN z.lat_lo AND z.lat_hi
                                             AND p.longitude BETWEEN z.lng_lo AND z.lng_hi) AS assigned_zone_id
FROM (SELECT CASE WHEN n % 4 <> 0 THEN event_id END AS event_id, CASE WHEN n % 9 <> 0 THEN latitude END AS latitude,
             longitude + CASE WHEN n % 3 = 0 THEN 5.0e0 ELSE 0.0e0 END AS longitude, zone_id
      FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) AS n FROM png)) p""")
def assign_zone_by_table(spark, sf_dir):
    """Points with missing ids and coordinates, some outside all boxes, and a zone table."""
    pings = _png(spark, sf_dir).withColumn("n", F.expr("CAST(substr(event_id, 5) AS BIGINT)")).selectExpr(
        "IF(n % 4 <> 0, event_id, NULL) AS event_id", "IF(n % 9 <> 0, latitude, NULL) AS latitude",
        "longitude + IF(n % 3 = 0, 5.0D, 0.0D) AS longitude", "zone_id")
    zones = spark.createDataFrame([(z.zone_id, z.lat_lo, z.lat_hi, z.lng_lo, z.lng_hi) for z in S.ZONES],
                                  "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    return J.assign_zone_join(pings, zones)


@register("zone_performance_dirty", with_ctes("demand", "revenue", "cancels", extra=[
    """ddemand AS (SELECT * REPLACE (CASE WHEN minute(window_start) <> 0 THEN avg_estimated_fare END AS avg_estimated_fare,
                         CASE WHEN minute(window_start) <> 5 THEN avg_surge END AS avg_surge)
             FROM demand WHERE zone_id <> 'Z001')""",
    "dcancels AS (SELECT * FROM cancels WHERE zone_id <> 'Z002')"]) + _ZONE_SQL.replace(
        "FROM demand", "FROM ddemand").replace("FROM cancels", "FROM dcancels"))
def zone_performance_dirty(spark, sf_dir):
    """Windows without averages, zones that only some of the inputs have."""
    demand = gold(spark, sf_dir, "ride_demand_by_zone").where("zone_id <> 'Z001'").withColumns({
        "avg_estimated_fare": F.expr("IF(minute(window_start) <> 0, avg_estimated_fare, NULL)"),
        "avg_surge": F.expr("IF(minute(window_start) <> 5, avg_surge, NULL)")})
    return J.zone_performance(demand, gold(spark, sf_dir, "revenue_analytics"),
                              gold(spark, sf_dir, "cancellation_analytics").where("zone_id <> 'Z002'"))


# --- pricing rules -----------------------------------------------------------

_RULE_SQL = (
    "least(1.0e0 + CASE WHEN h BETWEEN 7 AND 9 THEN 0.5e0 WHEN h BETWEEN 17 AND 20 THEN 0.7e0 "
    "WHEN h >= 23 OR h <= 4 THEN 0.3e0 ELSE 0.0e0 END "
    "+ CASE WHEN pickup_zone_id = 'Z002' THEN 0.2e0 ELSE 0.0e0 END, 3.0e0)"
)


@register("surge_rule", with_ctes("req") + f"""
SELECT ride_id, pickup_zone_id, h AS hour, surge_multiplier, {R(_RULE_SQL, 2)} AS rule_surge,
       {R(f'surge_multiplier - {R(_RULE_SQL, 2)}', 2)} AS surge_gap
FROM (SELECT *, CAST(hour(event_ts) AS INTEGER) AS h FROM req)""")
def surge_rule(spark, sf_dir):
    r = _req(spark, sf_dir).withColumn("hour", F.hour("event_ts"))
    rule = rule_surge("hour", "pickup_zone_id")
    return r.select(
        "ride_id", "pickup_zone_id", "hour", "surge_multiplier", rule.alias("rule_surge"),
        F.round(F.col("surge_multiplier") - rule, 2).alias("surge_gap"),
    )


_BASE_SQL = "CASE ride_type " + " ".join(
    f"WHEN '{k}' THEN {v!r}e0" for k, v in S.BASE_FARE.items()) + " END"
_EXPECTED_SQL = R(f"{_BASE_SQL} + distance_km * 12.0e0 * surge_multiplier", 2)


@register("fare_audit", with_ctes("req") + f"""
SELECT ride_id, ride_type, distance_km, surge_multiplier, estimated_fare, {_EXPECTED_SQL} AS expected_fare,
       {R(f'estimated_fare - {_EXPECTED_SQL}', 2)} AS fare_gap
FROM req""")
def fare_audit(spark, sf_dir):
    r = _req(spark, sf_dir)
    exp = expected_fare("ride_type", "distance_km", "surge_multiplier")
    return r.select(
        "ride_id", "ride_type", "distance_km", "surge_multiplier", "estimated_fare", exp.alias("expected_fare"),
        F.round(F.col("estimated_fare") - exp, 2).alias("fare_gap"),
    )
