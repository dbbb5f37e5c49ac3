"""Decoding the JSON streams: permissive on bad input, never an exception."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rideflux.functions.expressions import parse_event_time
from rideflux.sources.json_events import parse_driver_locations, parse_ride_completed, parse_ride_requests

REQUEST = {
    "event_id": "e1", "event_type": "RIDE_REQUEST", "timestamp": "2024-01-01T10:03:00.123456",
    "ride_id": "RD-ABC", "user_id": "USR-12345", "driver_id": None, "ride_type": "Economy",
    "status": "REQUESTED",
    "pickup": {"zone_id": "Z001", "zone_name": "City Center", "latitude": 26.9, "longitude": 75.8},
    "dropoff": {"zone_id": "Z002", "zone_name": "Airport", "latitude": 26.83, "longitude": 75.81},
    "distance_km": 5.5, "estimated_fare": 120.25, "surge_multiplier": 1.2, "payment_mode": "UPI",
    "hour_of_day": 10, "day_of_week": "Monday",
}


def _values(spark, *records):
    rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(rows, "value string")


def test_request_fields_and_flattened_zones(spark):
    r = parse_ride_requests(_values(spark, REQUEST)).collect()[0]
    assert r.pickup_zone_id == "Z001" and r.pickup_zone_name == "City Center" and r.dropoff_zone_id == "Z002"
    assert r.hour_of_day == 10.0  # integer in JSON, double in the schema
    assert r.event_ts == dt.datetime(2024, 1, 1, 10, 3, 0, 123456)
    assert "driver_id" not in parse_ride_requests(_values(spark, REQUEST)).columns


def test_malformed_json_gives_all_null_row(spark):
    rows = parse_ride_requests(_values(spark, "{bad")).collect()
    assert len(rows) == 1
    assert all(v is None for v in rows[0].asDict().values())


def test_wrong_field_type_nulls_only_that_field(spark):
    bad = dict(REQUEST, distance_km="x")
    r = parse_ride_requests(_values(spark, bad)).collect()[0]
    assert r.distance_km is None
    assert r.ride_id == "RD-ABC" and r.estimated_fare == 120.25


def test_malformed_timestamp_is_null_not_an_error(spark):
    bad = dict(REQUEST, timestamp="x")
    r = parse_ride_requests(_values(spark, bad)).collect()[0]
    assert r.event_ts is None and r.ride_id == "RD-ABC"


def test_naive_timestamp_is_utc_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        df = parse_ride_requests(_values(spark, REQUEST))
        micros = df.select(F.unix_micros("event_ts")).collect()[0][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    expect = dt.datetime(2024, 1, 1, 10, 3, 0, 123456, tzinfo=dt.timezone.utc)
    assert micros == int(expect.timestamp()) * 1_000_000 + 123456


def test_explicit_offset_is_respected(spark):
    rec = dict(REQUEST, timestamp="2024-01-01T15:33:00+05:30")
    r = parse_ride_requests(_values(spark, rec)).collect()[0]
    assert r.event_ts == dt.datetime(2024, 1, 1, 10, 3, 0)


def test_completed_and_pings_decode(spark):
    c = {"event_id": "c1", "timestamp": "2024-01-01T10:00:00", "ride_id": "RD-ABC", "status": "CANCELLED",
         "actual_fare": 99.5, "driver_rating": 4.5}
    p = {"event_id": "p1", "timestamp": "2024-01-01T10:00:00", "driver_id": "DRV-1001", "is_available": True,
         "current_speed_kmh": 12.5, "zone_id": "Z003"}
    rc = parse_ride_completed(_values(spark, c)).collect()[0]
    rp = parse_driver_locations(_values(spark, p)).collect()[0]
    assert rc.status == "CANCELLED" and rc.actual_fare == 99.5 and rc.event_ts is not None
    assert rp.is_available is True and rp.zone_id == "Z003"


def test_binary_value_column_like_kafka(spark):
    df = spark.createDataFrame([(bytearray(json.dumps(REQUEST).encode()),)], "value binary")
    assert parse_ride_requests(df).collect()[0].ride_id == "RD-ABC"


@pytest.mark.parametrize("text, expected", [
    ("2024-01-01T10:03:00.123456", dt.datetime(2024, 1, 1, 10, 3, 0, 123456)),
    ("2024-01-01T10:03:00", dt.datetime(2024, 1, 1, 10, 3)),
    ("2024-01-01T10:03", dt.datetime(2024, 1, 1, 10, 3)),
    ("2024-01-05", dt.datetime(2024, 1, 5)),
    ("2024-01-01T10:03:00Z", dt.datetime(2024, 1, 1, 10, 3)),
    ("2024-01-01T15:33:00+05:30", dt.datetime(2024, 1, 1, 10, 3)),
    ("2024-01-01 10:03:00-0500", dt.datetime(2024, 1, 1, 15, 3)),
    ("x", None),
    ("", None),
    (None, None),
])
def test_event_time_forms(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    got = df.select(parse_event_time("s").cast("timestamp_ntz")).collect()[0][0]
    assert got == expected
