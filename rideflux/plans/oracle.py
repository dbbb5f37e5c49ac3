"""DuckDB SQL for every registered query (the correctness oracle).

The views ``events`` etc. are registered by the checker.  The silver CTEs
restate :mod:`rideflux.sources.adapter` in SQL; the gold CTEs restate
:mod:`rideflux.operators.gold`.  Rules that make two engines agree:

* ``R(e, n)``: Spark rounds HALF_UP on the decimal text of a double; DuckDB
  does the same after ``double → varchar → decimal``.
* Sums run in ``decimal(28,10)`` in both engines, averages divide such a sum by
  the count (``AVGX``); a test holds both to plain double ``sum`` / ``avg``.
* Double literals are written ``1.0e0``: a bare ``1.0`` is DECIMAL in DuckDB.
"""

from __future__ import annotations

from rideflux import schemas as S

AS_OF = "2024-01-30"


def R(e: str, n: int) -> str:
    return f"CAST(round(CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def AVGX(e: str) -> str:
    """Average from the exact decimal sum, plain where a value does not fit."""
    d = f"TRY_CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(28,10))"
    return (f"CASE WHEN count({d}) = count({e}) THEN CAST(sum({d}) AS DOUBLE) / nullif(count({e}), 0) "
            f"ELSE avg(CAST(({e}) AS DOUBLE)) END")


def MONEY(e: str) -> str:
    d = f"TRY_CAST(CAST(({e}) AS VARCHAR) AS DECIMAL(28,10))"
    return (f"(CASE WHEN count({d}) = count({e}) THEN CAST(sum({d}) AS DOUBLE) "
            f"ELSE sum(CAST(({e}) AS DOUBLE)) END)")


def PCT(num: str, den: str) -> str:
    """DIVIDE(num, den, 0) * 100 with double division."""
    return f"(coalesce(CAST(({num}) AS DOUBLE) / nullif(CAST(({den}) AS DOUBLE), 0), 0.0e0) * 100.0e0)"


def RATIO(num: str, den: str) -> str:
    return f"coalesce(CAST(({num}) AS DOUBLE) / nullif(CAST(({den}) AS DOUBLE), 0), 0.0e0)"


def _dbl(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _str_list(vals) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + "]"


ZONES_CTE = "zones AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{z.zone_id}', '{z.zone_name}', {_dbl(z.lat_lo)}, {_dbl(z.lat_hi)}, {_dbl(z.lng_lo)}, {_dbl(z.lng_hi)})"
    for i, z in enumerate(S.ZONES)
) + ") AS t(zidx, zone_id, zone_name, lat_lo, lat_hi, lng_lo, lng_hi))"

_BASE_CTE = f"""base AS (
  SELECT e.event_id AS _eid, e.user_id AS _uid, e.event_type AS _etype, e.value AS _value,
         e.ts AS event_ts, strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS _k,
         pz.zone_id AS pz_id, pz.zone_name AS pz_name, pz.lat_lo AS pz_lat_lo, pz.lat_hi AS pz_lat_hi,
         pz.lng_lo AS pz_lng_lo, pz.lng_hi AS pz_lng_hi,
         dz.zone_id AS dz_id, dz.zone_name AS dz_name, dz.lat_lo AS dz_lat_lo, dz.lat_hi AS dz_lat_hi,
         dz.lng_lo AS dz_lng_lo, dz.lng_hi AS dz_lng_hi,
         'RD-' || CAST(e.event_id AS VARCHAR) AS ride_id,
         'USR-' || CAST(e.user_id AS VARCHAR) AS user_id,
         'DRV-' || CAST(e.user_id + 1000 AS VARCHAR) AS driver_id,
         {_str_list(S.RIDE_TYPES)}[CAST(e.event_id % {len(S.RIDE_TYPES)} AS INTEGER) + 1] AS ride_type,
         {_str_list(S.PAYMENT_MODES)}[CAST(e.event_id % {len(S.PAYMENT_MODES)} AS INTEGER) + 1] AS payment_mode,
         1.0e0 + CAST(json_extract_string(e.props, '$.k') AS INTEGER) / 50.0e0 AS surge_multiplier,
         2.0e0 + CAST(json_extract_string(e.props, '$.k') AS INTEGER) * 0.23e0 AS distance_km
  FROM events e
  JOIN zones pz ON pz.zidx = e.user_id % {len(S.ZONES)}
  JOIN zones dz ON dz.zidx = (e.user_id + 1) % {len(S.ZONES)}
)"""

_REQ_CTE = """req AS (
  SELECT 'REQ-' || CAST(_eid AS VARCHAR) AS event_id, 'RIDE_REQUEST' AS event_type, "timestamp", ride_id, user_id,
         ride_type, 'REQUESTED' AS status,
         pz_id AS pickup_zone_id, pz_name AS pickup_zone_name,
         pz_lat_lo + (pz_lat_hi - pz_lat_lo) * _k / 99.0e0 AS pickup_latitude,
         pz_lng_lo + (pz_lng_hi - pz_lng_lo) * _k / 99.0e0 AS pickup_longitude,
         dz_id AS dropoff_zone_id, dz_name AS dropoff_zone_name,
         dz_lat_lo + (dz_lat_hi - dz_lat_lo) * _k / 99.0e0 AS dropoff_latitude,
         dz_lng_lo + (dz_lng_hi - dz_lng_lo) * _k / 99.0e0 AS dropoff_longitude,
         distance_km, _value AS estimated_fare, surge_multiplier, payment_mode,
         CAST(hour(event_ts) AS DOUBLE) AS hour_of_day, dayname(event_ts) AS day_of_week, event_ts
  FROM base
)"""

_CMP_CTE = f"""cmp AS (
  SELECT 'CMP-' || CAST(_eid AS VARCHAR) AS event_id, 'RIDE_COMPLETED' AS event_type, "timestamp", ride_id, user_id,
         driver_id, ride_type,
         CASE WHEN _etype = 'error' THEN 'CANCELLED' ELSE 'COMPLETED' END AS status,
         pz_id AS pickup_zone_id, dz_id AS dropoff_zone_id, distance_km,
         distance_km * 4.0e0 AS duration_minutes, 2.0e0 + _k % 14 AS wait_time_minutes,
         _value AS estimated_fare, _value AS actual_fare, surge_multiplier, payment_mode,
         3.0e0 + (_eid % 21) / 10.0e0 AS driver_rating, 3.0e0 + (_uid % 21) / 10.0e0 AS user_rating,
         CASE WHEN _eid % 7 = 0
              THEN {_str_list(S.CANCELLATION_REASONS)}[CAST(_eid % {len(S.CANCELLATION_REASONS)} AS INTEGER) + 1]
         END AS cancellation_reason,
         event_ts
  FROM base WHERE _etype <> 'view'
)"""

_PNG_CTE = """png AS (
  SELECT 'PNG-' || CAST(_eid AS VARCHAR) AS event_id, 'DRIVER_LOCATION' AS event_type, "timestamp", driver_id,
         pz_lat_lo + (pz_lat_hi - pz_lat_lo) * _k / 99.0e0 AS latitude,
         pz_lng_lo + (pz_lng_hi - pz_lng_lo) * _k / 99.0e0 AS longitude,
         pz_id AS zone_id, pz_name AS zone_name, (_eid % 2 = 0) AS is_available,
         _k * 0.6e0 AS current_speed_kmh, event_ts
  FROM base
)"""


def _tb(minutes: int, col: str = "event_ts") -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {col})"


def _iv(minutes: int) -> str:
    return f"INTERVAL '{minutes} minutes'"


GOLD_SQL = {
    "ride_demand_by_zone": f"""demand AS (
  SELECT {_tb(5)} AS window_start, {_tb(5)} + {_iv(5)} AS window_end,
         pickup_zone_id AS zone_id, pickup_zone_name AS zone_name,
         count(*) AS total_requests,
         {R(AVGX('estimated_fare'), 2)} AS avg_estimated_fare,
         {R(AVGX('surge_multiplier'), 3)} AS avg_surge,
         {MONEY('distance_km')} AS total_distance_km
  FROM req WHERE event_ts IS NOT NULL
  GROUP BY 1, 2, 3, 4
)""",
    "surge_pricing_metrics": f"""surge AS (
  SELECT ws AS window_start, ws + {_iv(10)} AS window_end, ride_type,
         {R(AVGX('surge_multiplier'), 3)} AS avg_surge,
         {R('max(surge_multiplier)', 3)} AS max_surge,
         count(*) FILTER (WHERE surge_multiplier > {S.HIGH_SURGE_THRESHOLD}e0) AS high_surge_count,
         count(*) AS total_rides,
         {R(AVGX('estimated_fare'), 2)} AS avg_fare
  FROM (SELECT r.*, {_tb(5, 'r.event_ts')} - s.i * {_iv(5)} AS ws
        FROM req r, range(2) s(i) WHERE r.event_ts IS NOT NULL)
  GROUP BY 1, 2, 3
)""",
    "location_density": f"""density AS (
  SELECT {_tb(5)} AS window_start, zone_id, zone_name,
         count(driver_id) AS driver_pings,
         count(*) FILTER (WHERE is_available) AS available_drivers,
         {R(AVGX('current_speed_kmh'), 1)} AS avg_speed_kmh,
         {R('avg(latitude)', 6)} AS centroid_lat,
         {R('avg(longitude)', 6)} AS centroid_lng
  FROM png WHERE event_ts IS NOT NULL
  GROUP BY 1, 2, 3
)""",
    "revenue_analytics": f"""revenue AS (
  SELECT {_tb(60)} AS window_start, {_tb(60)} + {_iv(60)} AS window_end,
         pickup_zone_id AS zone_id, ride_type, payment_mode,
         count(*) AS completed_rides,
         {MONEY('actual_fare')} AS total_revenue,
         {R(AVGX('actual_fare'), 2)} AS avg_fare,
         {R(AVGX('driver_rating'), 2)} AS avg_driver_rating,
         {R(AVGX('wait_time_minutes'), 2)} AS avg_wait_time,
         {R(AVGX('duration_minutes'), 2)} AS avg_trip_duration
  FROM cmp WHERE status = 'COMPLETED' AND event_ts IS NOT NULL
  GROUP BY 1, 2, 3, 4, 5
)""",
    "cancellation_analytics": f"""cancels AS (
  SELECT {_tb(15)} AS window_start, pickup_zone_id AS zone_id,
         count(*) AS total,
         count(*) FILTER (WHERE status = 'CANCELLED') AS cancelled,
         count(*) FILTER (WHERE status = 'COMPLETED') AS completed,
         {R("CAST(count(*) FILTER (WHERE status = 'CANCELLED') AS DOUBLE) / count(*)", 4)} AS cancellation_rate
  FROM cmp WHERE event_ts IS NOT NULL
  GROUP BY 1, 2
)""",
}

GOLD_CTE_NAME = {
    "ride_demand_by_zone": "demand",
    "surge_pricing_metrics": "surge",
    "location_density": "density",
    "revenue_analytics": "revenue",
    "cancellation_analytics": "cancels",
}

_SILVER_NEEDS = {"req": ["base"], "cmp": ["base"], "png": ["base"], "base": ["zones"], "zones": []}
_SILVER_SQL = {"zones": ZONES_CTE, "base": _BASE_CTE, "req": _REQ_CTE, "cmp": _CMP_CTE, "png": _PNG_CTE}
_GOLD_NEEDS = {
    "demand": ["req"], "surge": ["req"], "density": ["png"], "revenue": ["cmp"], "cancels": ["cmp"],
}
_GOLD_BY_CTE = {v: GOLD_SQL[k] for k, v in GOLD_CTE_NAME.items()}


def with_ctes(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding the named silver/gold CTEs and what they need."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _SILVER_NEEDS.get(n, []) + _GOLD_NEEDS.get(n, []):
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [_SILVER_SQL.get(n) or _GOLD_BY_CTE[n] for n in order]
    return "WITH " + ",\n".join(parts + (extra or [])) + "\n"


def gold_select(table: str) -> str:
    cte = GOLD_CTE_NAME[table]
    return with_ctes(cte) + f"SELECT * FROM {cte}"


def stream_gold_select(table: str) -> str:
    """Append-mode output after the final flush: windows whose end is at or
    below max(event time) - watermark delay (revenue's clock only sees
    COMPLETED rides)."""
    spec = S.GOLD_SPECS[table]
    cte = GOLD_CTE_NAME[table]
    src = {"ride_requests": "req", "ride_completed": "cmp", "driver_locations": "png"}
    stream = {
        "ride_demand_by_zone": "ride_requests", "surge_pricing_metrics": "ride_requests",
        "location_density": "driver_locations", "revenue_analytics": "ride_completed",
        "cancellation_analytics": "ride_completed",
    }[table]
    s = src[stream]
    where = " WHERE status = 'COMPLETED'" if table == "revenue_analytics" else ""
    window_minutes = {"5 minutes": 5, "10 minutes": 10, "15 minutes": 15, "1 hour": 60}[spec.window]
    delay = int(spec.watermark.split()[0])
    end = "window_end" if "window_end" in S.GOLD_COLUMNS[table] else f"(window_start + {_iv(window_minutes)})"
    return (
        with_ctes(cte)
        + f"SELECT * FROM {cte} WHERE {end} <= (SELECT max(event_ts) FROM {s}{where}) - {_iv(delay)}"
    )
