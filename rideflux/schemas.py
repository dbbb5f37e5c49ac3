"""Declared schemas, table layouts and the fixed domain values.

Silver schemas are what the JSON event streams are decoded with (never
inferred); gold schemas are the declared output tables.  All input
fields are nullable; gold window starts and group keys are declared
not-null and enforced by :func:`rideflux.operators.layout.conform`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source system's domain for results to
# line up (zone boxes, enumerations, fare table, thresholds); they are stated
# here once, in their natural order.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Zone:
    zone_id: str
    zone_name: str
    lat_lo: float
    lat_hi: float
    lng_lo: float
    lng_hi: float


ZONES: tuple[Zone, ...] = (
    Zone("Z001", "City Center", 26.88, 26.93, 75.78, 75.83),
    Zone("Z002", "Airport", 26.82, 26.84, 75.80, 75.82),
    Zone("Z003", "Tech Park", 26.85, 26.90, 75.75, 75.80),
    Zone("Z004", "Old City", 26.92, 26.96, 75.82, 75.88),
    Zone("Z005", "Residential North", 26.95, 27.00, 75.76, 75.82),
    Zone("Z006", "Mall District", 26.87, 26.91, 75.84, 75.90),
)

RIDE_TYPES: tuple[str, ...] = ("Economy", "Premium", "Shared", "Auto", "Bike")
PAYMENT_MODES: tuple[str, ...] = ("Cash", "Card", "Wallet", "UPI")
CANCELLATION_REASONS: tuple[str, ...] = (
    "Driver too far",
    "Changed plans",
    "Found alternative",
    "Price too high",
    "Long wait time",
)

# Base fare per ride type; expected fare = base + distance_km * 12 * surge.
BASE_FARE: dict[str, float] = {
    "Economy": 50.0,
    "Premium": 120.0,
    "Shared": 30.0,
    "Auto": 40.0,
    "Bike": 25.0,
}
FARE_PER_KM = 12.0

# Rush-hour surge rule: start at 1.0, add one time-of-day premium (first match),
# add the airport premium, cap at 3.0.
SURGE_BASE = 1.0
SURGE_MORNING = (7, 9, 0.5)  # hours 7..9 inclusive
SURGE_EVENING = (17, 20, 0.7)  # hours 17..20 inclusive
SURGE_NIGHT = (23, 4, 0.3)  # hour >= 23 or hour <= 4
SURGE_AIRPORT_ZONE = "Z002"
SURGE_AIRPORT_PREMIUM = 0.2
SURGE_CAP = 3.0

HIGH_SURGE_THRESHOLD = 1.5  # "high surge" ride: surge_multiplier > 1.5

# Surge tier: first match wins; null falls through to Normal.
SURGE_TIERS: tuple[tuple[float, str], ...] = (
    (2.0, "Critical"),
    (1.5, "High"),
    (1.2, "Moderate"),
)
SURGE_TIER_DEFAULT = "Normal"

# Heatmap colour band: score/100 below the i-th cut point gives band i, else 6.
HEATMAP_CUTS: tuple[float, ...] = (0.2, 0.4, 0.55, 0.7, 0.82, 0.9)

# Driver availability band (percent): > 70 high, > 50 medium, else low.
AVAILABILITY_BANDS: tuple[tuple[float, str], ...] = ((70.0, "high"), (50.0, "medium"))
AVAILABILITY_DEFAULT = "low"

# Zone table cancel-rate flag: > 0.18 high, > 0.13 elevated, else normal;
# surge flag: avg surge >= 1.5.
CANCEL_FLAGS: tuple[tuple[float, str], ...] = ((0.18, "high"), (0.13, "elevated"))
CANCEL_FLAG_DEFAULT = "normal"
SURGE_FLAG_THRESHOLD = 1.5

# Event kinds in the live feed.
FEED_KINDS: tuple[str, ...] = ("request", "done", "cancel", "ping")

# Stream statuses.
STATUS_REQUESTED = "REQUESTED"
STATUS_COMPLETED = "COMPLETED"
STATUS_CANCELLED = "CANCELLED"


@dataclass(frozen=True)
class GoldSpec:
    """Window, watermark and layout of one gold table."""

    name: str
    window: str
    slide: str | None
    watermark: str
    partition_cols: tuple[str, ...]
    cluster_cols: tuple[str, ...]


GOLD_SPECS: dict[str, GoldSpec] = {
    s.name: s
    for s in (
        GoldSpec("ride_demand_by_zone", "5 minutes", None, "2 minutes", ("zone_id",), ("window_start",)),
        GoldSpec(
            "surge_pricing_metrics", "10 minutes", "5 minutes", "5 minutes", ("ride_type",),
            ("window_start", "avg_surge"),
        ),
        GoldSpec("location_density", "5 minutes", None, "2 minutes", ("zone_id",), ("window_start",)),
        GoldSpec(
            "revenue_analytics", "1 hour", None, "10 minutes", ("zone_id", "ride_type"),
            ("window_start", "total_revenue"),
        ),
        GoldSpec(
            "cancellation_analytics", "15 minutes", None, "5 minutes", ("zone_id",),
            ("window_start", "cancellation_rate"),
        ),
    )
}

# ---------------------------------------------------------------------------
# Silver (decoded event) schemas.  Fixed values as well: field names, types
# and order are those of the JSON the producers send.
# ---------------------------------------------------------------------------

S, D, B, L, TS = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.TimestampType()


def _fields(*pairs, nullable: bool = True) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t in pairs])


LOCATION_SCHEMA = _fields(("zone_id", S), ("zone_name", S), ("latitude", D), ("longitude", D))

RIDE_REQUEST_SCHEMA = _fields(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("ride_id", S), ("user_id", S),
    ("ride_type", S), ("status", S), ("pickup", LOCATION_SCHEMA), ("dropoff", LOCATION_SCHEMA),
    ("distance_km", D), ("estimated_fare", D), ("surge_multiplier", D), ("payment_mode", S),
    ("hour_of_day", D), ("day_of_week", S),
)

RIDE_COMPLETED_SCHEMA = _fields(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("ride_id", S), ("user_id", S),
    ("driver_id", S), ("ride_type", S), ("status", S), ("pickup_zone_id", S), ("dropoff_zone_id", S),
    ("distance_km", D), ("duration_minutes", D), ("wait_time_minutes", D), ("estimated_fare", D),
    ("actual_fare", D), ("surge_multiplier", D), ("payment_mode", S), ("driver_rating", D),
    ("user_rating", D), ("cancellation_reason", S),
)

DRIVER_LOCATION_SCHEMA = _fields(
    ("event_id", S), ("event_type", S), ("timestamp", S), ("driver_id", S), ("latitude", D),
    ("longitude", D), ("zone_id", S), ("zone_name", S), ("is_available", B), ("current_speed_kmh", D),
)

STREAM_SCHEMAS: dict[str, T.StructType] = {
    "ride_requests": RIDE_REQUEST_SCHEMA,
    "ride_completed": RIDE_COMPLETED_SCHEMA,
    "driver_locations": DRIVER_LOCATION_SCHEMA,
}

# ---------------------------------------------------------------------------
# Gold schemas (declared not-null = window start and group keys).  Fixed
# values: the output tables' column names, types and order.
# ---------------------------------------------------------------------------


def _gold(*specs) -> T.StructType:
    return T.StructType([T.StructField(n, t, not req) for n, t, req in specs])


_REQ = True
_OPT = False

GOLD_SCHEMAS: dict[str, T.StructType] = {
    "ride_demand_by_zone": _gold(
        ("window_start", TS, _REQ), ("window_end", TS, _OPT), ("zone_id", S, _REQ), ("zone_name", S, _OPT),
        ("total_requests", L, _OPT), ("avg_estimated_fare", D, _OPT), ("avg_surge", D, _OPT),
        ("total_distance_km", D, _OPT),
    ),
    "surge_pricing_metrics": _gold(
        ("window_start", TS, _REQ), ("window_end", TS, _OPT), ("ride_type", S, _REQ), ("avg_surge", D, _OPT),
        ("max_surge", D, _OPT), ("high_surge_count", L, _OPT), ("total_rides", L, _OPT), ("avg_fare", D, _OPT),
    ),
    "location_density": _gold(
        ("window_start", TS, _REQ), ("zone_id", S, _REQ), ("zone_name", S, _OPT), ("driver_pings", L, _OPT),
        ("available_drivers", L, _OPT), ("avg_speed_kmh", D, _OPT), ("centroid_lat", D, _OPT),
        ("centroid_lng", D, _OPT),
    ),
    "revenue_analytics": _gold(
        ("window_start", TS, _REQ), ("window_end", TS, _OPT), ("zone_id", S, _REQ), ("ride_type", S, _REQ),
        ("payment_mode", S, _OPT), ("completed_rides", L, _OPT), ("total_revenue", D, _OPT),
        ("avg_fare", D, _OPT), ("avg_driver_rating", D, _OPT), ("avg_wait_time", D, _OPT),
        ("avg_trip_duration", D, _OPT),
    ),
    "cancellation_analytics": _gold(
        ("window_start", TS, _REQ), ("zone_id", S, _REQ), ("total", L, _OPT), ("cancelled", L, _OPT),
        ("completed", L, _OPT), ("cancellation_rate", D, _OPT),
    ),
}

GOLD_COLUMNS: dict[str, list[str]] = {k: v.fieldNames() for k, v in GOLD_SCHEMAS.items()}

# Audit rows written by the streaming sink, one per non-empty micro-batch.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", S, False),
        T.StructField("batch_id", L, False),
        T.StructField("num_rows", L, True),
        T.StructField("min_window_start", TS, True),
        T.StructField("max_window_start", TS, True),
        T.StructField("written_at", TS, True),
    ]
)
