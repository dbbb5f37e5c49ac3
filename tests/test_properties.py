"""Property tests: gold tables on random small inputs vs a brute-force model."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rideflux.operators import gold as G

T0 = dt.datetime(2024, 3, 1)
ZONES = ["Z001", "Z002", "Z003"]

ride = st.tuples(
    st.integers(min_value=0, max_value=6 * 3600 * 1000),  # ms after T0
    st.sampled_from(ZONES),
    st.sampled_from(["Economy", "Bike"]),
    st.integers(min_value=100, max_value=99999),  # fare in cents
    st.integers(min_value=90, max_value=300),  # surge x100
    st.sampled_from(["COMPLETED", "CANCELLED"]),
)


def _half_up(x: float, n: int) -> float:
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-n), rounding=ROUND_HALF_UP))


def _floor(ts: dt.datetime, minutes: int) -> dt.datetime:
    m = (ts.hour * 60 + ts.minute) // minutes * minutes
    return ts.replace(hour=m // 60, minute=m % 60, second=0, microsecond=0)


def _frame(spark, rides):
    rows = [(T0 + dt.timedelta(milliseconds=ms), z, z + " name", t, c / 100.0, s / 100.0, 2.0, st_)
            for ms, z, t, c, s, st_ in rides]
    return spark.createDataFrame(
        rows, "event_ts timestamp_ntz, pickup_zone_id string, pickup_zone_name string, ride_type string, "
              "estimated_fare double, surge_multiplier double, distance_km double, status string")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ride, min_size=1, max_size=40))
def test_demand_matches_brute_force(spark, rides):
    groups = defaultdict(list)
    for ms, z, _t, c, s, _st in rides:
        ts = T0 + dt.timedelta(milliseconds=ms)
        groups[(_floor(ts, 5), z)].append((c / 100.0, s / 100.0))
    expect = {
        (w, z): (len(v), _half_up(sum(f for f, _ in v) / len(v), 2), _half_up(sum(x for _, x in v) / len(v), 3))
        for (w, z), v in groups.items()
    }
    got = {
        (r.window_start, r.zone_id): (r.total_requests, r.avg_estimated_fare, r.avg_surge)
        for r in G.ride_demand_by_zone(_frame(spark, rides)).collect()
    }
    assert got.keys() == expect.keys()
    for k, (n, fare, surge) in expect.items():
        g = got[k]
        assert g[0] == n
        # averages of at most 40 values: allow one unit in the last place from
        # summation order, exact otherwise
        assert abs(g[1] - fare) <= 0.01 + 1e-9 and abs(g[2] - surge) <= 0.001 + 1e-9


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ride, min_size=1, max_size=40))
def test_sliding_surge_counts_and_max(spark, rides):
    groups = defaultdict(list)
    for ms, _z, t, _c, s, _st in rides:
        ts = T0 + dt.timedelta(milliseconds=ms)
        b = _floor(ts, 5)
        for start in (b, b - dt.timedelta(minutes=5)):
            groups[(start, t)].append(s / 100.0)
    expect = {k: (len(v), max(v), sum(1 for x in v if x > 1.5)) for k, v in groups.items()}
    got = {
        (r.window_start, r.ride_type): (r.total_rides, r.max_surge, r.high_surge_count)
        for r in G.surge_pricing_metrics(_frame(spark, rides)).collect()
    }
    assert got == expect


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ride, min_size=1, max_size=40))
def test_cancellations_match_brute_force(spark, rides):
    groups = defaultdict(lambda: [0, 0])
    for ms, z, _t, _c, _s, status in rides:
        ts = T0 + dt.timedelta(milliseconds=ms)
        g = groups[(_floor(ts, 15), z)]
        g[0] += 1
        g[1] += status == "CANCELLED"
    expect = {k: (n, c, n - c, _half_up(c / n, 4)) for k, (n, c) in groups.items()}
    got = {
        (r.window_start, r.zone_id): (r.total, r.cancelled, r.completed, r.cancellation_rate)
        for r in G.cancellation_analytics(_frame(spark, rides)).collect()
    }
    assert got == expect


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ride, min_size=2, max_size=30), st.lists(st.integers(1, 29), min_size=1, max_size=4))
def test_stream_over_many_batches_equals_batch(spark, rides, cuts):
    """Events in time order split over several files (one micro-batch each):
    the stream emits exactly the batch table's windows that end at or before
    the final watermark, with identical values."""
    import json
    import os
    import tempfile

    from pyspark.sql import functions as F

    from rideflux.sources.json_events import parse_ride_requests
    from rideflux.sources.readers import read_topic_stream
    from rideflux.streaming import jobs

    rides = sorted(rides)
    bounds = sorted({c for c in cuts if c < len(rides)} | {0, len(rides)})
    d = tempfile.mkdtemp(prefix="rideflux-prop-")
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        path = f"{d}/topic/part-{i:03d}.json"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            for j, (ms, z, t, c, s, _st) in enumerate(rides[a:b]):
                ts = (T0 + dt.timedelta(milliseconds=ms)).isoformat()
                f.write(json.dumps({"event_id": f"{a + j}", "timestamp": ts, "ride_type": t,
                                    "pickup": {"zone_id": z, "zone_name": z + " name"},
                                    "estimated_fare": c / 100.0, "surge_multiplier": s / 100.0,
                                    "distance_km": 2.0}) + "\n")
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))
    parsed = parse_ride_requests(read_topic_stream(spark, "ride_requests", path=f"{d}/topic", max_per_trigger=1))
    jobs.run_available_now([jobs.start_gold_query(parsed, "ride_demand_by_zone", f"{d}/out", available_now=True)])
    got = jobs.read_gold(spark, f"{d}/out", "ride_demand_by_zone").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    last = T0 + dt.timedelta(milliseconds=rides[-1][0])
    want = G.ride_demand_by_zone(_frame(spark, rides)).where(
        F.col("window_end") <= F.lit(last - dt.timedelta(minutes=2)))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


delivery = st.tuples(
    st.integers(0, 5),  # ride id
    st.integers(0, 3600),  # seconds after T0
    st.integers(0, 3),  # copy number (duplicate deliveries)
    st.sampled_from(["COMPLETED", "CANCELLED"]),
    st.integers(100, 9999),  # fare in cents
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(delivery, min_size=1, max_size=25), st.lists(delivery, max_size=25))
def test_ride_lifecycle_matches_brute_force(spark, reqs, dones):
    from rideflux.operators.joins import ride_lifecycle

    def ts(sec):
        return T0 + dt.timedelta(seconds=sec)

    req_rows = [(f"r{r}", f"REQ-{r}-{sec}-{k}", ts(sec), "Z001", "Auto", "REQUESTED", c / 100.0)
                for r, sec, k, _s, c in reqs]
    cmp_rows = [(f"r{r}", f"CMP-{r}-{sec}-{k}", ts(sec), s, c / 100.0) for r, sec, k, s, c in dones]
    req = spark.createDataFrame(req_rows, "ride_id string, event_id string, event_ts timestamp_ntz, "
                                          "pickup_zone_id string, ride_type string, status string, estimated_fare double")
    cmp = spark.createDataFrame(cmp_rows, "ride_id string, event_id string, event_ts timestamp_ntz, status string, "
                                          "actual_fare double")
    first_req = {}
    for row in sorted(req_rows, key=lambda x: (x[2], x[1])):
        first_req.setdefault(row[0], row)
    last_cmp = {}
    for row in sorted(cmp_rows, key=lambda x: (x[2], x[1])):
        last_cmp[row[0]] = row
    expect = {}
    for rid, r in first_req.items():
        c = last_cmp.get(rid)
        expect[rid] = (r[2], c[2] if c else None, c[3] if c else "REQUESTED", r[6], c[4] if c else None,
                       _half_up(c[4] - r[6], 2) if c else None)
    got = {x.ride_id: (x.requested_at, x.finished_at, x.status, x.estimated_fare, x.actual_fare, x.fare_delta)
           for x in ride_lifecycle(req, cmp).collect()}
    assert got == expect
