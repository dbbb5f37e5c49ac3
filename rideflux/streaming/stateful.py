"""Stateful streaming operators over the silver streams.

* ``distinct_events``: repeated deliveries of an event, dropped within the
  watermark delay.
* ``ride_lifecycle_stream``: requests joined to their completions, both sides
  buffered, outer rows at expiry.
* ``overdue_rides``: rides without an outcome some time after the request, by
  a timer per ride, kept in buckets of rides.
* ``driver_shifts``: session windows over a driver's pings.

State is keyed by event, ride or driver id or by a bucket of ride ids, so it
spreads over all state partitions; every operator frees it by event time, so
it is bounded by the delays and intervals named, not by the data read so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def distinct_events(silver: DataFrame, delay: str) -> DataFrame:
    """``silver`` without repeated event ids.

    On a stream an id is remembered until the watermark (newest event time
    less ``delay``) passes its event time plus ``delay``: a producer's retry
    within the delay is dropped whatever batch it comes in, one that comes
    later is a late row.  Rows without an id cannot be told apart and stay,
    like rows without a time, which no window counts.  The watermark is set
    here; an aggregate behind it keeps it.

    On a batch one row per id stays.
    """
    if not silver.isStreaming:
        return silver.where("event_id IS NOT NULL").dropDuplicates(["event_id"]).unionByName(
            silver.where("event_id IS NULL"))
    # A row without an id gets a key of its own: its content and a random part.
    key = F.coalesce(F.col("event_id"), F.concat(F.lit("\0"), F.uuid()))
    return (silver.withColumn("_event", key).withWatermark("event_ts", delay)
            .dropDuplicatesWithinWatermark(["_event"]).drop("_event"))


def ride_lifecycle_stream(requests: DataFrame, completed: DataFrame, longest: str = "3 hours",
                          request_delay: str = "1 hour", completion_delay: str = "1 hour") -> DataFrame:
    """Each requested ride with its outcome, as a stream-stream left join.

    A completion belongs to the request of its ride if it is no older than
    that and at most ``longest`` younger.  Both sides are buffered until the
    watermark says that no partner can come any more: a matched ride is
    emitted when both rows are there, one without an outcome when the
    watermark has passed its request time plus ``longest``.  Repeated
    deliveries are dropped by event id first.  Rows without a ride id or a
    time have no outcome to wait for and are left to the raw sink.
    """
    r = distinct_events(requests.where("ride_id IS NOT NULL AND event_ts IS NOT NULL"), request_delay).selectExpr(
        "ride_id", "pickup_zone_id", "ride_type", "event_ts AS requested_at", "status AS _r_status", "estimated_fare")
    c = distinct_events(completed.where("ride_id IS NOT NULL AND event_ts IS NOT NULL"), completion_delay).selectExpr(
        "ride_id AS _c_ride", "event_ts AS finished_at", "status AS _c_status", "actual_fare")
    return r.join(c, F.expr(f"ride_id = _c_ride AND finished_at >= requested_at "
                            f"AND finished_at <= requested_at + INTERVAL {longest}"), "left").selectExpr(
        "ride_id", "pickup_zone_id", "ride_type", "requested_at", "finished_at",
        "coalesce(_c_status, _r_status) AS status", "estimated_fare", "actual_fare",
        "round(actual_fare - estimated_fare, 2) AS fare_delta")


_OVERDUE = "ride_id string, pickup_zone_id string, ride_type string, requested_us long"
_OPEN = "rides binary"
#: No request, or no outcome, has come yet.
_NONE_YET = np.iinfo(np.int64).max
_RIDES = pa.schema([("ride_id", pa.string()), ("pickup_zone_id", pa.string()), ("ride_type", pa.string()),
                    ("requested_us", pa.int64()), ("finished_us", pa.int64()), ("due_ms", pa.int64())])


def _pack(rides: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _RIDES) as out:
        out.write_table(pa.Table.from_pandas(rides, _RIDES, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpack(state: GroupState) -> pd.DataFrame:
    if not state.exists:
        return _RIDES.empty_table().to_pandas()
    return pa.ipc.open_stream(bytes(state.get[0])).read_pandas()


def _merged(rides: pd.DataFrame, rows: pd.DataFrame, limit_us: int, mark_ms: int) -> pd.DataFrame:
    """``rides`` with what new ``rows`` tell: per ride the earliest request
    (of equal ones the first to come) and outcome; timers of rides with new
    rows are set anew, after the watermark."""
    asked = rows["requested"].to_numpy(dtype=bool)
    at = rows["at_us"].to_numpy(dtype=np.int64)
    news = rows[["ride_id", "pickup_zone_id", "ride_type"]].assign(
        requested_us=np.where(asked, at, _NONE_YET), finished_us=np.where(asked, _NONE_YET, at), due_ms=_NONE_YET)
    both = pd.concat([rides, news], ignore_index=True) if len(rides) else news
    both = both.assign(fresh=np.arange(len(both)) >= len(rides)).sort_values("requested_us", kind="stable")
    ride, _ = pd.factorize(both["ride_id"])  # numbered as they come, like the rows that drop_duplicates leaves
    out = both.drop_duplicates("ride_id").drop(columns="fresh")
    finished, fresh = np.full(len(out), _NONE_YET), np.zeros(len(out), dtype=bool)
    np.minimum.at(finished, ride, both["finished_us"].to_numpy())
    fresh[ride[both["fresh"].to_numpy()]] = True
    # An outcome alone waits as long for its request, then its state goes as well.
    requested = out["requested_us"].to_numpy()
    start = np.where(requested < _NONE_YET, requested, finished)
    due = np.maximum((start + limit_us) // 1000, mark_ms + 1)
    return out.assign(finished_us=finished, due_ms=np.where(fresh, due, out["due_ms"].to_numpy()))


def _watch(limit_us: int):
    """State function of ``overdue_rides``: the open rides of a bucket, each
    with its earliest request and outcome and a timer at its request time plus
    the limit; the bucket's own timer is its earliest one."""

    def step(key: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark_ms, rides = state.getCurrentWatermarkMs(), _unpack(state)
        if not state.hasTimedOut:
            rides = _merged(rides, pd.concat(pieces, ignore_index=True), limit_us, mark_ms)
        due = rides["due_ms"] < mark_ms
        ended, rides = rides[due], rides[~due]
        if len(rides):
            state.update((_pack(rides),))
            state.setTimeoutTimestamp(int(rides["due_ms"].min()))
        else:
            state.remove()
        # Requested, and no outcome from the request's limit back.
        overdue = ended[(ended["requested_us"] < _NONE_YET) & (ended["finished_us"] - limit_us > ended["requested_us"])]
        if len(overdue):
            yield overdue[["ride_id", "pickup_zone_id", "ride_type", "requested_us"]]

    return step


def overdue_rides(requests: DataFrame, completed: DataFrame, minutes: int = 120, delay: str = "1 hour",
                  buckets: int = 256) -> DataFrame:
    """Rides without an outcome ``minutes`` after their request.

    The state holds each ride's earliest request and outcome; an event-time
    timer at request + ``minutes`` emits the ride if no outcome of up to then
    has come, and frees the state either way.  ``delay`` is how far records
    may be out of order.  Rows without a ride id or a time are left out.

    Rides are dealt by their id into ``buckets``, and the open ones of a bucket
    are kept, joined to new rows and timed out together: the cost per ride is
    that of a row in a data frame, not of a Python call.  A batch writes anew
    the buckets it touches.  The number is fixed in the checkpoint like that
    of the shuffle partitions: some ten thousand open rides per bucket are fine.
    """
    rows = requests.selectExpr("ride_id", "event_ts", "pickup_zone_id", "ride_type", "true AS requested").unionByName(
        completed.selectExpr("ride_id", "event_ts", "CAST(NULL AS STRING) AS pickup_zone_id",
                             "CAST(NULL AS STRING) AS ride_type", "false AS requested"))
    rows = rows.where("ride_id IS NOT NULL AND event_ts IS NOT NULL").withWatermark("event_ts", delay).selectExpr(
        "*", "unix_micros(event_ts) AS at_us", f"pmod(xxhash64(ride_id), {buckets}) AS bucket")
    found = rows.groupBy("bucket").applyInPandasWithState(
        _watch(minutes * 60_000_000), _OVERDUE, _OPEN, "append", GroupStateTimeout.EventTimeTimeout)
    return found.selectExpr("ride_id", "pickup_zone_id", "ride_type", "timestamp_micros(requested_us) AS requested_at",
                            f"timestamp_micros(requested_us + {minutes * 60_000_000}L) AS overdue_at")


def driver_shifts(pings: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """A driver's pings merged into shifts: a new one begins after more than
    ``gap`` without a ping.  The same for a batch and, with the watermark
    ``delay``, for a stream, where a shift is emitted once no ping can extend it.
    """
    if pings.isStreaming:
        pings = pings.withWatermark("event_ts", delay)
    # event_ts is a timestamp on streams and timestamp_ntz on batch tables.
    span = F.session_window("event_ts", gap).alias("session")
    return pings.where("driver_id IS NOT NULL AND event_ts IS NOT NULL").groupBy(span, "driver_id").agg(
        F.count(F.lit(1)).alias("pings"), F.count_if("is_available").alias("available_pings"),
        F.min("event_ts").alias("shift_start"), F.max("event_ts").alias("last_ping")).select(
            "driver_id", "shift_start", "last_ping", "pings", "available_pings")
