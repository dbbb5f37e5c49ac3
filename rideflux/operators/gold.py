"""The five event-time window aggregates (gold tables).

Each function takes a silver DataFrame and returns the gold DataFrame; the
same function serves a batch DataFrame and a streaming one.  On a stream the
watermark is applied (append output emits a window once the watermark has
passed its end); on a batch it would be a no-op and is skipped, which also
lets batch input keep ``timestamp_ntz`` event times.

Physical plan (batch and per micro-batch): partial HashAggregate →
Exchange(hash on window, keys) → final HashAggregate.  Partial aggregation
collapses a hot key (one zone with a third of all rows) on the map side, so
the shuffle carries at most one row per group and input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflux import schemas as S

# Aggregates and projections are SQL expression text: the JVM parses each in
# one call, where the equivalent nest of Column functions costs a driver
# round-trip per function (plan-building time, not execution time).

# Sums and averages are taken from decimal(28,10) values: ten decimals hold
# what the sources send, so nothing is rounded first, and an exact sum does not
# depend on the order of rows (partitioning, micro-batching); a double sum
# could round 101.105 either way.  Where a value of the group does not fit
# (NaN, 1e18 or more), the group's plain double sum or average is taken: no
# value is left out.
_D = "TRY_CAST({x} AS DECIMAL(28,10))"
_FITS = f"count({_D}) = count({{x}})"
EXACT_SUM = f"coalesce(IF({_FITS}, CAST(try_sum({_D}) AS DOUBLE), NULL), sum({{x}}))"
EXACT_AVG = f"coalesce(IF({_FITS}, try_divide(CAST(try_sum({_D}) AS DOUBLE), count({{x}})), NULL), avg({{x}}))"


def _avg(x: str) -> str:
    return EXACT_AVG.format(x=x)


def _windowed(df: DataFrame, spec: S.GoldSpec, watermark: str | None) -> tuple[DataFrame, Column]:
    # An input that an earlier operator has given a watermark keeps that one.
    if df.isStreaming and "spark.watermarkDelayMs" not in df.schema["event_ts"].metadata:
        df = df.withWatermark("event_ts", watermark or spec.watermark)
    slide = f", '{spec.slide}'" if spec.slide else ""
    return df, F.expr(f"window(event_ts, '{spec.window}'{slide}) AS window")


def _agg(df: DataFrame, w: Column, keys: list[str], measures: list[str], out: list[str]) -> DataFrame:
    return df.groupBy(w, *keys).agg(*[F.expr(m) for m in measures]).selectExpr(*out)


def ride_demand_by_zone(requests: DataFrame, watermark: str | None = None) -> DataFrame:
    """Requests per pickup zone per 5-minute tumbling window."""
    df, w = _windowed(requests, S.GOLD_SPECS["ride_demand_by_zone"], watermark)
    return _agg(
        df, w, ["pickup_zone_id", "pickup_zone_name"],
        [
            "count(1) AS total_requests",
            f"{_avg('estimated_fare')} AS _fare",
            f"{_avg('surge_multiplier')} AS _surge",
            f"{EXACT_SUM.format(x='distance_km')} AS _distance",
        ],
        [
            "window.start AS window_start", "window.end AS window_end",
            "pickup_zone_id AS zone_id", "pickup_zone_name AS zone_name",
            "total_requests",
            "round(_fare, 2) AS avg_estimated_fare",
            "round(_surge, 3) AS avg_surge",
            "round(_distance, 2) AS total_distance_km",
        ],
    )


def surge_pricing_metrics(requests: DataFrame, watermark: str | None = None) -> DataFrame:
    """Surge per ride type per 10-minute window sliding by 5 minutes.

    Every request lands in two windows, so ``total_rides`` summed over the
    table is twice the ride count; ratios of two sums are unaffected.
    """
    df, w = _windowed(requests, S.GOLD_SPECS["surge_pricing_metrics"], watermark)
    return _agg(
        df, w, ["ride_type"],
        [
            f"{_avg('surge_multiplier')} AS _surge",
            "max(surge_multiplier) AS _max",
            f"count_if(surge_multiplier > {S.HIGH_SURGE_THRESHOLD}D) AS high_surge_count",
            "count(1) AS total_rides",
            f"{_avg('estimated_fare')} AS _fare",
        ],
        [
            "window.start AS window_start", "window.end AS window_end", "ride_type",
            "round(_surge, 3) AS avg_surge",
            "round(_max, 3) AS max_surge",
            "high_surge_count", "total_rides",
            "round(_fare, 2) AS avg_fare",
        ],
    )


def location_density(pings: DataFrame, watermark: str | None = None) -> DataFrame:
    """Driver pings per zone per 5-minute window (heatmap input).

    ``driver_pings`` counts pings with a driver id; ``available_drivers``
    counts pings flagged available (pings, not distinct drivers).
    """
    df, w = _windowed(pings, S.GOLD_SPECS["location_density"], watermark)
    return _agg(
        df, w, ["zone_id", "zone_name"],
        [
            "count(driver_id) AS driver_pings",
            "count_if(is_available) AS available_drivers",
            f"{_avg('current_speed_kmh')} AS _speed",
            "avg(latitude) AS _lat",
            "avg(longitude) AS _lng",
        ],
        [
            "window.start AS window_start", "zone_id", "zone_name", "driver_pings", "available_drivers",
            "round(_speed, 1) AS avg_speed_kmh",
            "round(_lat, 6) AS centroid_lat",
            "round(_lng, 6) AS centroid_lng",
        ],
    )


def revenue_analytics(completed: DataFrame, watermark: str | None = None) -> DataFrame:
    """Hourly revenue per pickup zone, ride type and payment mode.

    The COMPLETED filter runs before the watermark, so cancelled rides do not
    advance this table's event-time clock.
    """
    only_done = completed.where(f"status = '{S.STATUS_COMPLETED}'")
    df, w = _windowed(only_done, S.GOLD_SPECS["revenue_analytics"], watermark)
    return _agg(
        df, w, ["pickup_zone_id", "ride_type", "payment_mode"],
        [
            "count(1) AS completed_rides",
            f"{EXACT_SUM.format(x='actual_fare')} AS _revenue",
            f"{_avg('actual_fare')} AS _fare",
            f"{_avg('driver_rating')} AS _rating",
            f"{_avg('wait_time_minutes')} AS _wait",
            f"{_avg('duration_minutes')} AS _duration",
        ],
        [
            "window.start AS window_start", "window.end AS window_end",
            "pickup_zone_id AS zone_id", "ride_type", "payment_mode", "completed_rides",
            "round(_revenue, 2) AS total_revenue",
            "round(_fare, 2) AS avg_fare",
            "round(_rating, 2) AS avg_driver_rating",
            "round(_wait, 2) AS avg_wait_time",
            "round(_duration, 2) AS avg_trip_duration",
        ],
    )


def cancellation_analytics(completed: DataFrame, watermark: str | None = None) -> DataFrame:
    """Cancelled share of finished rides per pickup zone per 15 minutes."""
    df, w = _windowed(completed, S.GOLD_SPECS["cancellation_analytics"], watermark)
    return _agg(
        df, w, ["pickup_zone_id"],
        [
            "count(1) AS total",
            f"count_if(status = '{S.STATUS_CANCELLED}') AS cancelled",
            f"count_if(status = '{S.STATUS_COMPLETED}') AS completed",
        ],
        [
            "window.start AS window_start", "pickup_zone_id AS zone_id",
            "total", "cancelled", "completed",
            "round(cancelled / total, 4) AS cancellation_rate",
        ],
    )


def _minutes(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"minute": 1, "minutes": 1, "hour": 60, "hours": 60}[unit]


def window_minutes(table: str) -> tuple[int, int]:
    """Size and slide of a table's windows."""
    spec = S.GOLD_SPECS[table]
    size = _minutes(spec.window)
    return size, _minutes(spec.slide) if spec.slide else size


def events_for_windows(silver: DataFrame, table: str, start, end) -> DataFrame:
    """Only the events that can reach ``table``'s windows starting in [start, end).

    A window starting at w covers [w, w + size); with starts from ``start`` up
    to ``end - slide`` that is event time in [start, end - slide + size).  The
    predicate is on the input's own event time, so it reaches the scan
    (Parquet row-group skipping) instead of being applied after aggregating
    all history.  Windows at the edge built from a partial slice of events
    (sliding windows that start before ``start``) must still be removed by a
    window-start filter on the result, as the day-based measures do.
    """
    size, slide = window_minutes(table)
    ts_type = dict(silver.dtypes).get("event_ts", "timestamp")
    lo = F.lit(start).cast(ts_type)
    hi = F.lit(end).cast(ts_type) + F.expr(f"INTERVAL {size - slide} MINUTES")
    return silver.where((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))


# gold table name → (function, silver stream it reads)
GOLD = {
    "ride_demand_by_zone": (ride_demand_by_zone, "ride_requests"),
    "surge_pricing_metrics": (surge_pricing_metrics, "ride_requests"),
    "location_density": (location_density, "driver_locations"),
    "revenue_analytics": (revenue_analytics, "ride_completed"),
    "cancellation_analytics": (cancellation_analytics, "ride_completed"),
}
