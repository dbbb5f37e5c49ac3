"""Test-table adapter: the driver's ``events`` table → the three silver streams.

The test data has no ride feed, so each ``events`` row is read as one ride:
a request, a completion (unless the event is a ``view``: that ride stays
REQUESTED) and one driver ping.  Every column is a deterministic function of
the event row, so the same derivation is written as SQL for the DuckDB
oracle (``rideflux.plans.oracle``).  It is glue for tests and benchmarks; a
production job reads the JSON topics through ``rideflux.sources.json_events``.

Rules (K = the integer ``k`` in ``props``; zones indexed 0..5 in id order):

* pickup zone ``user_id % 6``, dropoff zone ``(user_id + 1) % 6``;
  coordinates ``lo + (hi - lo) * K / 99.0`` inside the zone box
* ride type ``event_id % 5``, payment mode ``event_id % 4`` (list order)
* surge ``1.0 + K / 50.0``, distance ``2.0 + K * 0.23``, fares = ``value``
* status CANCELLED for ``error`` events, else COMPLETED; no completion for ``view``
* wait ``2.0 + K % 14``, duration ``distance * 4.0``
* driver rating ``3.0 + (event_id % 21) / 10.0``, user rating ``3.0 + (user_id % 21) / 10.0``
* cancellation reason ``reasons[event_id % 5]`` on every 7th event id (independent of status)
* ping: driver ``DRV-(1000 + user_id)``, available on even event ids, speed ``K * 0.6``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.functions.expressions import ZONE_BOXES_SQL, sql_array

N_ZONES = len(S.ZONES)

# The projections are SQL expression text: each select is parsed by the JVM in
# one call, instead of one driver round-trip per literal and function.


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _pick(values, idx: str) -> str:
    """values[idx] for a small fixed list (idx 0-based SQL expression)."""
    return f"element_at({sql_array(values)}, CAST({idx} AS INT) + 1)"


def _point(z: str, axis: str) -> str:
    return f"{z}.{axis}_lo + ({z}.{axis}_hi - {z}.{axis}_lo) * _k / 99.0D"


def _location(z: str) -> str:
    return (f"named_struct('zone_id', {z}.zone_id, 'zone_name', {z}.zone_name, "
            f"'latitude', {_point(z, 'lat')}, 'longitude', {_point(z, 'lng')})")


_BASE = [
    "event_id AS _eid", "user_id AS _uid", "event_type AS _etype", "value AS _value",
    "ts AS event_ts",
    "date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS') AS timestamp",
    "CAST(get_json_object(props, '$.k') AS INT) AS _k",
    f"element_at({ZONE_BOXES_SQL}, CAST(user_id % {N_ZONES} AS INT) + 1) AS _pz",
    f"element_at({ZONE_BOXES_SQL}, CAST((user_id + 1) % {N_ZONES} AS INT) + 1) AS _dz",
    "concat('RD-', CAST(event_id AS STRING)) AS ride_id",
    "concat('USR-', CAST(user_id AS STRING)) AS user_id",
    "concat('DRV-', CAST(user_id + 1000 AS STRING)) AS driver_id",
    f"{_pick(S.RIDE_TYPES, f'event_id % {len(S.RIDE_TYPES)}')} AS ride_type",
    f"{_pick(S.PAYMENT_MODES, f'event_id % {len(S.PAYMENT_MODES)}')} AS payment_mode",
]
# derived from _k, so computed in a second projection
_BASE_K = [
    "1.0D + _k / 50.0D AS surge_multiplier",
    "2.0D + _k * 0.23D AS distance_km",
]


def _base(events: DataFrame) -> DataFrame:
    """Columns shared by the three streams, computed once per event."""
    b = events.selectExpr(*_BASE)
    return b.selectExpr("*", *_BASE_K)


_REQUEST = [
    "concat('REQ-', CAST(_eid AS STRING)) AS event_id",
    "'RIDE_REQUEST' AS event_type",
    "timestamp", "ride_id", "user_id", "ride_type",
    f"'{S.STATUS_REQUESTED}' AS status",
    f"{_location('_pz')} AS pickup",
    f"{_location('_dz')} AS dropoff",
    "distance_km",
    "_value AS estimated_fare",
    "surge_multiplier", "payment_mode",
    "CAST(hour(event_ts) AS DOUBLE) AS hour_of_day",
    "date_format(event_ts, 'EEEE') AS day_of_week",
    "event_ts",
    "_pz.zone_id AS pickup_zone_id",
    "_pz.zone_name AS pickup_zone_name",
    "_dz.zone_id AS dropoff_zone_id",
]

_COMPLETED = [
    "concat('CMP-', CAST(_eid AS STRING)) AS event_id",
    "'RIDE_COMPLETED' AS event_type",
    "timestamp", "ride_id", "user_id", "driver_id", "ride_type",
    f"CASE WHEN _etype = 'error' THEN '{S.STATUS_CANCELLED}' ELSE '{S.STATUS_COMPLETED}' END AS status",
    "_pz.zone_id AS pickup_zone_id",
    "_dz.zone_id AS dropoff_zone_id",
    "distance_km",
    "distance_km * 4.0D AS duration_minutes",
    "2.0D + _k % 14 AS wait_time_minutes",
    "_value AS estimated_fare",
    "_value AS actual_fare",
    "surge_multiplier", "payment_mode",
    "3.0D + (_eid % 21) / 10.0D AS driver_rating",
    "3.0D + (_uid % 21) / 10.0D AS user_rating",
    f"CASE WHEN _eid % 7 = 0 THEN {_pick(S.CANCELLATION_REASONS, f'_eid % {len(S.CANCELLATION_REASONS)}')} END"
    " AS cancellation_reason",
    "event_ts",
]

_PING = [
    "concat('PNG-', CAST(_eid AS STRING)) AS event_id",
    "'DRIVER_LOCATION' AS event_type",
    "timestamp", "driver_id",
    f"{_point('_pz', 'lat')} AS latitude",
    f"{_point('_pz', 'lng')} AS longitude",
    "_pz.zone_id AS zone_id", "_pz.zone_name AS zone_name",
    "_eid % 2 = 0 AS is_available",
    "_k * 0.6D AS current_speed_kmh",
    "event_ts",
]


def ride_requests(events: DataFrame) -> DataFrame:
    return _base(events).selectExpr(*_REQUEST)


def ride_completed(events: DataFrame) -> DataFrame:
    return _base(events.where("event_type <> 'view'")).selectExpr(*_COMPLETED)


def driver_locations(events: DataFrame) -> DataFrame:
    return _base(events).selectExpr(*_PING)


STREAMS = {
    "ride_requests": ride_requests,
    "ride_completed": ride_completed,
    "driver_locations": driver_locations,
}


def silver(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """One silver stream (batch DataFrame, event_ts as timestamp_ntz)."""
    return STREAMS[stream](read_events(spark, sf_dir))


def to_bronze(silver_df: DataFrame, stream: str, keep=()) -> DataFrame:
    """Serialise silver rows back to the JSON the producer sends (``value``
    column, and the columns ``keep`` beside it)."""
    fields = S.STREAM_SCHEMAS[stream].fieldNames()
    return silver_df.select(F.to_json(F.struct(*fields)).alias("value"), *keep)
