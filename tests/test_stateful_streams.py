"""Deduplication, stream-stream join, timers, sessions, quarantine and backfill on hand-made topics."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from rideflux.operators import gold as G
from rideflux.plans import catalog
from rideflux.plans import queries_streaming as QS
from rideflux.sources.json_events import PARSERS
from rideflux.sources.readers import read_topic_stream
from rideflux.streaming import backfill, jobs, quarantine, stateful
from rideflux.streaming.sinks import read_audit, read_sink, write_stream
from tests.conftest import SF_SMALL, assert_same, write_json_lines

DAY = "2024-01-01T"


def _topic(path, batches, start=1_700_000_000):
    for i, records in enumerate(batches):
        write_json_lines(f"{path}/part-{i:03d}.json", records, mtime=start + 10 * i)


def _req(at, event=None, ride=None, zone="Z001"):
    return {"event_id": event if event is not None else f"REQ-{at}", "timestamp": f"{DAY}{at}:00", "ride_id": ride or f"RD-{at}",
            "ride_type": "Auto", "status": "REQUESTED", "estimated_fare": 50.0, "surge_multiplier": 1.0, "distance_km": 2.0,
            "pickup": {"zone_id": zone, "zone_name": "City Center", "latitude": 26.9, "longitude": 75.8}}


def _done(at, ride, event=None, status="COMPLETED"):
    return {"event_id": event or f"CMP-{at}-{ride}", "timestamp": f"{DAY}{at}:00", "ride_id": ride, "status": status,
            "actual_fare": 60.0, "pickup_zone_id": "Z001", "ride_type": "Auto"}


def _stream(spark, stream, path, files=1):
    return PARSERS[stream](read_topic_stream(spark, stream, path=path, max_per_trigger=files))


def _run(spark, df, base, report=None):
    q = write_stream(df, f"{base}/t", f"{base}/c", table_name="t", available_now=True)
    jobs.run_available_now([q])
    if report is not None:
        report.extend(jobs.watermark_report(q))
    return read_sink(spark, f"{base}/t", df.schema).collect()


@pytest.mark.parametrize("name", [
    "stream_demand_dedup", "stream_ride_lifecycle", "stream_overdue_rides", "stream_driver_shifts",
    "quarantine_driver_locations", "backfill_demand", "pipeline_health"])
def test_keys_equal_sql(spark, name):
    assert_same(catalog.queries()[name](spark, SF_SMALL), catalog.oracle_sql()[name], SF_SMALL)


def test_repeats_are_dropped_across_batches_and_state_stays_flat(spark, tmp_dir):
    first = [[_req(f"{10 + k // 6:02d}:{k % 6 * 10:02d}", event=f"e{k}"),
              _req(f"{10 + k // 6:02d}:{k % 6 * 10:02d}", event=f"e{k}")] for k in range(24)]
    # The next batch repeats the record of the one before.
    batches = [b + (first[i - 1][:1] if i else []) for i, b in enumerate(first)]
    batches.append([_req("23:00", event="end")])
    _topic(f"{tmp_dir}/topic", batches)
    report = []
    once = stateful.distinct_events(_stream(spark, "ride_requests", f"{tmp_dir}/topic"), "20 minutes")
    rows = _run(spark, G.ride_demand_by_zone(once), tmp_dir, report)
    assert len(rows) == 24 and all(r.total_requests == 1 for r in rows)
    assert max(r["state_rows"] for r in report) <= 16  # ids and windows of some 40 minutes


def test_rows_without_an_id_are_not_merged(spark, tmp_dir):
    none = dict(_req("10:00"), event_id=None)
    _topic(f"{tmp_dir}/topic", [[none, none, _req("10:01", event="a"), _req("10:01", event="a")], [_req("12:00")]])
    once = stateful.distinct_events(_stream(spark, "ride_requests", f"{tmp_dir}/topic"), "2 minutes")
    rows = _run(spark, G.ride_demand_by_zone(once), tmp_dir)
    assert [r.total_requests for r in rows] == [3]
    batch = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "event_id string, x int")
    assert stateful.distinct_events(batch, "2 minutes").count() == 3


def test_ride_link_matches_expires_and_ignores_what_lies_outside(spark, tmp_dir):
    _topic(f"{tmp_dir}/req", [[_req("10:00", ride="A"), _req("10:01", ride="B"), _req("10:02", ride="C")],
                              [_req("11:00", ride="D"), _req("10:00", ride="A")], [_req("23:00", ride="Z")]])
    _topic(f"{tmp_dir}/cmp", [[_done("10:30", "A"), _done("09:59", "B")],  # B's outcome is older than its request
                              [_done("11:30", "C"), _done("14:30", "D")], [_done("23:00", "Y")]])
    rides = stateful.ride_lifecycle_stream(_stream(spark, "ride_requests", f"{tmp_dir}/req"),
                                           _stream(spark, "ride_completed", f"{tmp_dir}/cmp"), longest="3 hours")
    report = []
    got = {r.ride_id: (r.status, r.fare_delta) for r in _run(spark, rides, tmp_dir, report)}
    assert got == {"A": ("COMPLETED", 10.0), "B": ("REQUESTED", None), "C": ("COMPLETED", 10.0), "D": ("REQUESTED", None)}
    assert report[-1]["state_rows"] <= 6  # Y and Z, in join and deduplication


def test_overdue_rides_by_timer(spark, tmp_dir):
    _topic(f"{tmp_dir}/req", [[_req("10:00", ride="A"), _req("10:00", ride="B"), _req("10:05", ride="C")],
                              [_req("10:05", ride="A", event="again")], [_req("23:00", ride="Z")]])
    _topic(f"{tmp_dir}/cmp", [[_done("10:20", "A")], [_done("12:10", "C"), _done("10:30", "X")], [_done("23:00", "Y")]])
    report = []
    rides = stateful.overdue_rides(_stream(spark, "ride_requests", f"{tmp_dir}/req"),
                                   _stream(spark, "ride_completed", f"{tmp_dir}/cmp"), minutes=120)
    got = sorted((r.ride_id, r.overdue_at.strftime("%H:%M")) for r in _run(spark, rides, tmp_dir, report))
    assert got == [("B", "12:00"), ("C", "12:05")]  # C's outcome came five minutes too late
    assert report[-1]["state_rows"] == 2  # Y and Z


def test_overdue_state_is_kept_by_bucket_of_rides(spark, tmp_dir):
    # 3,000 rides in two batches, a third each without outcome, with one at the limit and with one a minute late;
    # every second request comes again, earlier and from another zone, in the batch behind.
    n, at = 3000, lambda minute: f"{10 + minute // 60:02d}:{minute % 60:02d}"
    first = [_req(at(20 + k % 30), ride=f"R{k}", event=f"e{k}") for k in range(n)]
    again = [_req(at(10 + k % 30), ride=f"R{k}", event=f"a{k}", zone="Z002") for k in range(0, n, 2)]
    asked = lambda k: 20 + k % 30 - 10 * (k % 2 == 0)
    done = [_done(at(asked(k) + 120 + k % 3 - 1), f"R{k}") for k in range(n) if k % 3]
    _topic(f"{tmp_dir}/req", [first, again, [_req("23:00", ride="Z")]])
    _topic(f"{tmp_dir}/cmp", [[_done("10:00", "X")], done, [_done("23:00", "Y")]])
    report = []
    rides = stateful.overdue_rides(_stream(spark, "ride_requests", f"{tmp_dir}/req"),
                                   _stream(spark, "ride_completed", f"{tmp_dir}/cmp"), minutes=120)
    got = {(r.ride_id, r.pickup_zone_id, r.requested_at.strftime("%H:%M"), r.overdue_at.strftime("%H:%M"))
           for r in _run(spark, rides, tmp_dir, report)}
    assert got == {(f"R{k}", "Z001" if k % 2 else "Z002", at(asked(k)), at(asked(k) + 120))
                   for k in range(n) if k % 3 != 1}
    assert max(r["state_rows"] for r in report) <= 256  # buckets, not rides


def test_shifts_merge_and_split_at_the_gap(spark):
    base = dt.datetime(2024, 1, 1, 10)
    minutes = {"a": [0, 29, 58, 90], "b": [0, 30], "c": [0, 31]}
    rows = [(d, base + dt.timedelta(minutes=m), m % 2 == 0) for d, ms in minutes.items() for m in ms] + [(None, base, True), ("d", None, True)]
    df = spark.createDataFrame(rows, "driver_id string, event_ts timestamp_ntz, is_available boolean")
    got = sorted((r.driver_id, r.shift_start.strftime("%H:%M"), r.last_ping.strftime("%H:%M"), r.pings) for r in stateful.driver_shifts(df).collect())
    assert got[:2] == [("a", "10:00", "10:58", 3), ("a", "11:30", "11:30", 1)]
    assert got[2:] == [("b", "10:00", "10:30", 2), ("c", "10:00", "10:00", 1), ("c", "10:31", "10:31", 1)]


def test_quarantine_reasons_and_counts(spark, tmp_dir):
    good = {"event_id": "g", "timestamp": f"{DAY}10:00:00", "driver_id": "DRV-1", "current_speed_kmh": 3.0}
    bad = ['{"event_id": "cut', "[1]", "text", json.dumps({**good, "current_speed_kmh": "fast"}), json.dumps({**good, "timestamp": "soon"}),
           json.dumps({"event_id": "n"}), " "]
    _topic(f"{tmp_dir}/topic", [[good, *bad[:3]], [*bad[3:], good], [good]])
    raw = read_topic_stream(spark, "driver_locations", path=f"{tmp_dir}/topic", max_per_trigger=1)
    for _ in range(2):  # a second start finds nothing new
        jobs.run_available_now([quarantine.start_checked_query(raw, "driver_locations", tmp_dir, available_now=True)])
    held = quarantine.read_quarantine(spark, tmp_dir, "driver_locations").collect()
    assert sorted((r.reason, r.value) for r in held) == sorted(zip(
        ["malformed json", "malformed json", "malformed json", "wrong type", "unreadable time", "no time", "empty record"], bad))
    clean = quarantine.read_clean(spark, tmp_dir, "driver_locations")
    assert clean.columns == [*PARSERS["driver_locations"](spark.createDataFrame([], "value string")).columns]
    assert [r.event_id for r in clean.collect()] == ["g", "g", "g"]
    counts = {r.table_name: r["sum(num_rows)"] for r in read_audit(spark, jobs.audit_path(tmp_dir)).groupBy("table_name").sum("num_rows").collect()}
    assert counts == {"clean_driver_locations": 3, "quarantine_driver_locations": 7, "untimed_driver_locations": 6}
    assert quarantine.decode_checked(spark.createDataFrame([], "value string"), "ride_requests").count() == 0


def test_backfill_repairs_late_windows_and_can_be_repeated(spark):
    table = "ride_demand_by_zone"
    base = QS.late_requests_run(spark, SF_SMALL)
    spark.catalog.clearCache()
    stored = jobs.read_gold(spark, base, table)
    want = G.ride_demand_by_zone(spark.read.parquet(jobs.raw_path(base, "ride_requests")).drop("batch_id"))
    newest = want.agg({"window_end": "max"}).first()[0]
    before = stored.collect()
    for _ in range(2):
        backfill.backfill(spark, base, table)
        after = backfill.read_repaired(spark, base, table).collect()
        assert sum(r.total_requests for r in after) > sum(r.total_requests for r in before)
        closed = {(r.window_start, r.zone_id): r.total_requests for r in want.collect() if r.window_end < newest - dt.timedelta(minutes=5)}
        got = {(r.window_start, r.zone_id): r.total_requests for r in after}
        assert len(got) == len(after) and {k: got.get(k) for k in closed} == closed


def test_backfill_of_sliding_windows(spark, tmp_dir):
    _topic(f"{tmp_dir}/topic", [[_req("10:01"), _req("10:07")], [_req("10:30")], [_req("10:31")], [_req("10:02", event="late")], [_req("12:00")]])
    parsed = _stream(spark, "ride_requests", f"{tmp_dir}/topic")
    jobs.run_available_now([jobs.start_gold_query(parsed, "surge_pricing_metrics", tmp_dir, available_now=True),
                            jobs.start_raw_query(parsed, "ride_requests", tmp_dir, available_now=True)])
    stored = {r.window_start.strftime("%H:%M"): r.total_rides for r in jobs.read_gold(spark, tmp_dir, "surge_pricing_metrics").collect()}
    backfill.backfill(spark, tmp_dir, "surge_pricing_metrics")
    after = {r.window_start.strftime("%H:%M"): r.total_rides for r in backfill.read_repaired(spark, tmp_dir, "surge_pricing_metrics").collect()}
    assert after == {"09:55": 2, "10:00": 3, "10:05": 1, "10:25": 2, "10:30": 2}
    assert stored == {**after, "09:55": 1, "10:00": 2}
