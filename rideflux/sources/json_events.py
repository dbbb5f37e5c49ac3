"""Decode the three JSON event streams (bronze ``value`` → silver columns).

The same functions serve a Kafka stream, a file stream and a batch
DataFrame: all that is needed is a ``value`` column (binary or string).

Decoding is PERMISSIVE: malformed JSON gives a row of nulls, a field of the
wrong type gives a null field, an unparseable timestamp gives a null
``event_ts`` (``try_to_timestamp``; a plain ``to_timestamp`` would raise under
ANSI mode and kill the stream).  Rows with a null ``event_ts`` never enter a
window; they still reach the raw sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rideflux import schemas as S
from rideflux.functions.expressions import parse_event_time


def decode(raw: DataFrame, schema: StructType) -> DataFrame:
    """``value`` → typed columns of ``schema`` + ``event_ts``."""
    return (
        raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))
        .select("data.*")
        .withColumn("event_ts", parse_event_time("timestamp"))
    )


def with_pickup(decoded: DataFrame) -> DataFrame:
    """A decoded request's zones as columns of their own."""
    return decoded.withColumns({
        "pickup_zone_id": F.col("pickup.zone_id"),
        "pickup_zone_name": F.col("pickup.zone_name"),
        "dropoff_zone_id": F.col("dropoff.zone_id"),
    })


def parse_ride_requests(raw: DataFrame) -> DataFrame:
    return with_pickup(decode(raw, S.RIDE_REQUEST_SCHEMA))


def parse_ride_completed(raw: DataFrame) -> DataFrame:
    return decode(raw, S.RIDE_COMPLETED_SCHEMA)


def parse_driver_locations(raw: DataFrame) -> DataFrame:
    return decode(raw, S.DRIVER_LOCATION_SCHEMA)


PARSERS = {
    "ride_requests": parse_ride_requests,
    "ride_completed": parse_ride_completed,
    "driver_locations": parse_driver_locations,
}
