"""Registered queries: silver decode and the five gold tables (batch form)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators import gold as G
from rideflux.plans import oracle as O
from rideflux.plans.catalog import register
from rideflux.sources import adapter
from rideflux.sources.json_events import PARSERS


def silver(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    return adapter.silver(spark, sf_dir, stream)


def gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    fn, stream = G.GOLD[table]
    return fn(silver(spark, sf_dir, stream))


def gold_days(spark: SparkSession, sf_dir: str, table: str, last_day, days: int) -> DataFrame:
    """Gold rows whose windows start in the ``days`` calendar days ending
    ``last_day``, computed from only the events that can reach them."""
    end = dt.date.fromisoformat(last_day) + dt.timedelta(days=1)
    start = end - dt.timedelta(days=days)
    fn, stream = G.GOLD[table]
    events = G.events_for_windows(silver(spark, sf_dir, stream), table, start, end)
    return fn(events)


def _gold_query(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold(spark, sf_dir, table)

    q.__name__ = table
    return q


for _t in G.GOLD:
    register(_t, O.gold_select(_t))(_gold_query(_t))


# --- JSON decode ------------------------------------------------------------
# The silver rows are serialised to the producer's JSON and decoded back; the
# comparison view flattens the location structs and shows event_ts as
# timestamp_ntz (UTC wall clock).

def _flat_request() -> list:
    return [
        "event_id", "event_type", "timestamp", "ride_id", "user_id", "ride_type", "status",
        "pickup_zone_id", "pickup_zone_name",
        F.col("pickup.latitude").alias("pickup_latitude"), F.col("pickup.longitude").alias("pickup_longitude"),
        "dropoff_zone_id", F.col("dropoff.zone_name").alias("dropoff_zone_name"),
        F.col("dropoff.latitude").alias("dropoff_latitude"), F.col("dropoff.longitude").alias("dropoff_longitude"),
        "distance_km", "estimated_fare", "surge_multiplier", "payment_mode", "hour_of_day", "day_of_week",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
    ]


def decoded(spark: SparkSession, sf_dir: str, stream: str) -> DataFrame:
    """Silver → JSON text → decoder (batch): projections of the scan only."""
    return PARSERS[stream](adapter.to_bronze(silver(spark, sf_dir, stream), stream))


def flat_view(df: DataFrame, stream: str) -> DataFrame:
    if stream == "ride_requests":
        return df.select(*_flat_request())
    return df.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@register("parse_ride_requests", O.with_ctes("req") + "SELECT * FROM req")
def parse_ride_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_view(decoded(spark, sf_dir, "ride_requests"), "ride_requests")


@register("parse_ride_completed", O.with_ctes("cmp") + "SELECT * FROM cmp")
def parse_ride_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_view(decoded(spark, sf_dir, "ride_completed"), "ride_completed")


@register("parse_driver_locations", O.with_ctes("png") + "SELECT * FROM png")
def parse_driver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_view(decoded(spark, sf_dir, "driver_locations"), "driver_locations")


def dirty_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ping records as a careless producer sends them, by event number modulo 6:
    cut-off JSON, a text where a number belongs, a month only as time, a time
    that is none, and no zone."""
    pings = silver(spark, sf_dir, "driver_locations").withColumn("n", F.expr("CAST(substr(event_id, 5) AS BIGINT) % 6"))
    pings = pings.withColumns({
        "timestamp": F.expr("CASE n WHEN 2 THEN substr(timestamp, 1, 7) WHEN 3 THEN 'soon' ELSE timestamp END"),
        "zone_id": F.expr("IF(n = 4, NULL, zone_id)")})
    fields = [F.expr("IF(n = 1, 'fast', string(current_speed_kmh))").alias("current_speed_kmh") if f == "current_speed_kmh" else f
              for f in S.STREAM_SCHEMAS["driver_locations"].fieldNames()]
    text = F.to_json(F.struct(*fields))
    text = F.when(F.col("n") == 1, text).otherwise(F.regexp_replace(text, '"current_speed_kmh":"([^"]*)"', '"current_speed_kmh":$1'))
    return pings.select(F.when(F.col("n") == 0, F.substring(text, 1, 30)).otherwise(text).alias("value"))


_DIRTY_NULLS = ", ".join(f"CASE WHEN n <> 0 THEN {c} END AS {c}" for c in (
    "event_id", "event_type", "driver_id", "latitude", "longitude", "zone_name", "is_available"))


@register("parse_driver_locations_dirty", O.with_ctes("png") + f"""
SELECT {_DIRTY_NULLS}, CASE WHEN n NOT IN (0, 4) THEN zone_id END AS zone_id,
       CASE WHEN n NOT IN (0, 1) THEN current_speed_kmh END AS current_speed_kmh,
       CASE n WHEN 0 THEN NULL WHEN 2 THEN substr("timestamp", 1, 7) WHEN 3 THEN 'soon' ELSE "timestamp" END AS "timestamp",
       CASE n WHEN 0 THEN NULL WHEN 2 THEN date_trunc('month', event_ts) WHEN 3 THEN NULL ELSE event_ts END AS event_ts
FROM (SELECT *, CAST(substr(event_id, 5) AS BIGINT) % 6 AS n FROM png)""")
def parse_driver_locations_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_view(PARSERS["driver_locations"](dirty_pings(spark, sf_dir)), "driver_locations")
