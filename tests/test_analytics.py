"""As-of join, complete axes, sketches, grouping sets and the pruned feed on small rows."""

from __future__ import annotations

import datetime as dt
import random

from rideflux.operators import analytics as A
from rideflux.plans import dashboard as D
from rideflux.plans.queries_gold import silver
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 10)
STREAMS = ("ride_requests", "ride_completed", "driver_locations")


def _at(m):
    return None if m is None else T0 + dt.timedelta(minutes=m)


def test_as_of_join_equals_brute_force(spark):
    rng = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", None]
    left = [(i, rng.choice(keys), _at(rng.choice([None, rng.randrange(0, 600)]))) for i in range(300)]
    right = [(f"e{i}", rng.choice(keys), _at(rng.choice([None, rng.randrange(0, 600, 7)])), rng.choice([None, rng.random()]))
             for i in range(120)]
    got = A.as_of_join(spark.createDataFrame(left, "i int, zone string, event_ts timestamp_ntz"),
                       spark.createDataFrame(right, "event_id string, zone string, event_ts timestamp_ntz, surge double"),
                       "zone", "surge", "in_force")
    assert got.columns == ["i", "zone", "event_ts", "in_force"]

    def want(zone, t):
        hits = [r for r in right if zone is not None and t is not None and r[1] == zone and r[2] is not None and r[2] <= t]
        return max(hits, key=lambda r: (r[2], r[0]))[3] if hits else None

    rows = got.collect()
    assert sorted(r.i for r in rows) == list(range(300))
    assert all(r.in_force == want(r.zone, r.event_ts) for r in rows)


def test_as_of_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", T0)], "i int, zone string, event_ts timestamp_ntz")
    right = spark.createDataFrame([], "event_id string, zone string, event_ts timestamp_ntz, surge double")
    assert [r.in_force for r in A.as_of_join(left, right, "zone", "surge", "in_force").collect()] == [None]
    assert A.as_of_join(left.limit(0), right, "zone", "surge", "in_force").count() == 0


def test_complete_hours_fills_and_keeps(spark):
    df = spark.createDataFrame([(3, "x", 5, 1.5), (7, "y", 2, 2.5), (30, "x", 1, 1.0)], "hour int, zone string, rides long, fare double")
    got = {(r.hour, r.zone): (r.rides, r.fare) for r in A.complete_hours(df, last=9, zero=("rides",), by={"zone": ["x", "y"]}).collect()}
    assert len(got) == 20 and got[3, "x"] == (5, 1.5) and got[7, "y"] == (2, 2.5) and got[3, "y"] == (0, None)


def test_sketches_merge_over_windows_and_zones(spark):
    rows = [(f"D{i % 4000}", f"Z{i % 3}", _at(i % 1400)) for i in range(20_000)]
    pings = spark.createDataFrame(rows, "driver_id string, zone_id string, event_ts timestamp_ntz")
    (total,) = A.drivers_by(A.driver_sketches(pings)).collect()
    assert abs(total.drivers - 4000) <= A.COUNT_ERROR * 4000
    waits = spark.createDataFrame([("COMPLETED", "Z1", _at(i % 700), float(i)) for i in range(20_000)] + [("CANCELLED", "Z1", T0, 1e9)],
                                  "status string, pickup_zone_id string, event_ts timestamp_ntz, wait_time_minutes double")
    (q,) = A.wait_quantiles(A.wait_sketches(waits), "zone_id").collect()
    assert q.rides == 20_000
    assert abs(q.p50 - 10_000) <= 20_000 * A.RANK_ERROR and abs(q.p95 - 19_000) <= 20_000 * A.RANK_ERROR


def test_rollup_has_every_level(spark):
    rows = [(T0, "Z1", "Auto", 2, 0.1), (T0, "Z1", "Bike", 1, 0.2), (_at(60 * 24), "Z2", "Auto", 4, 5.0)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, zone_id string, ride_type string, completed_rides long, total_revenue double")
    got = {(r.level, r.zone_id, r.ride_type): (r.rides, r.revenue) for r in A.revenue_rollup(df).where("day = '2024-01-01' OR level = 7").collect()}
    assert got == {(0, "Z1", "Auto"): (2, 0.1), (0, "Z1", "Bike"): (1, 0.2), (1, "Z1", None): (3, 0.3), (3, None, None): (3, 0.3),
                   (7, None, None): (7, 5.3)}


def _stored(spark, base, tables):
    for s, df in tables.items():
        A.write_by_date(df, f"{base}/{s}")
    return {s: spark.read.parquet(f"{base}/{s}") for s in tables}


def test_pruned_feed_reads_the_newest_dates_only(spark, tmp_dir):
    tables = {s: silver(spark, SF_SMALL, s) for s in STREAMS}
    stored = _stored(spark, tmp_dir, tables)
    feed = A.pruned_feed(stored)
    assert feed.collect() == D.event_feed(*[tables[s] for s in STREAMS]).collect()
    newest = A.event_dates(stored)[0]
    assert sorted({f.split("event_date=")[1][:10] for f in feed.inputFiles()})[0] <= str(newest)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert f"event_date" in plan and "PartitionFilters" in plan


def test_pruned_feed_of_few_and_untimed_rows(spark, tmp_dir):
    tables = {s: silver(spark, SF_SMALL, s).limit(2) for s in STREAMS}
    tables["ride_requests"] = tables["ride_requests"].unionByName(tables["ride_requests"].selectExpr(
        *[f"CAST(NULL AS TIMESTAMP_NTZ) AS {c}" if c == "event_ts" else c for c in tables["ride_requests"].columns]))
    stored = _stored(spark, tmp_dir, tables)
    got = A.pruned_feed(stored, n=20).collect()
    assert len(got) == 8 and [r.event_ts is None for r in got] == [False] * 6 + [True] * 2
