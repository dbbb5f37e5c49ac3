"""Structured Streaming semantics: watermark, late rows, restart, idempotent sink."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from rideflux.operators.gold import GOLD
from rideflux.sources.json_events import PARSERS
from rideflux.sources.readers import read_topic_stream
from rideflux.streaming import jobs
from rideflux.streaming.history import table_history
from rideflux.streaming.sinks import batch_writer, read_audit
from tests.conftest import SF_SMALL, assert_same, write_json_lines


def _req(ts: str, zone="Z001"):
    return {"event_id": ts, "timestamp": f"2024-01-01T{ts}:00", "ride_id": f"RD-{ts}", "ride_type": "Auto",
            "pickup": {"zone_id": zone, "zone_name": "City Center", "latitude": 26.9, "longitude": 75.8},
            "distance_km": 2.0, "estimated_fare": 50.0, "surge_multiplier": 1.0, "payment_mode": "UPI"}


def _files(topic, batches, start=1_700_000_000):
    """One file per batch, mtimes 10 s apart (the file source lists by mtime)."""
    for i, recs in enumerate(batches):
        write_json_lines(f"{topic}/part-{i:03d}.json", recs, mtime=start + 10 * i)


def _run(spark, table, stream, topic, base, max_files=1, report=None):
    parsed = PARSERS[stream](read_topic_stream(spark, stream, path=topic, max_per_trigger=max_files))
    q = jobs.start_gold_query(parsed, table, base, available_now=True)
    jobs.run_available_now([q])
    if report is not None:
        report.extend(jobs.watermark_report(q))
    return jobs.read_gold(spark, base, table)


def test_late_rows_one_batch_lag(spark, tmp_dir):
    topic, base = f"{tmp_dir}/topic", f"{tmp_dir}/out"
    batches = [[_req("10:01"), _req("10:02")], [_req("10:08")], [_req("10:20")], [_req("10:12")],
               [_req("10:13")], [_req("10:03"), _req("10:04")]]
    _files(topic, batches)
    report = []
    out = _run(spark, "ride_demand_by_zone", "ride_requests", topic, base, report=report)
    got = sorted((r.window_start.strftime("%H:%M"), r.total_requests) for r in out.collect())
    assert sum(r["dropped_late"] for r in report) >= 2
    assert [r["input_rows"] for r in report][:6] == [2, 1, 1, 1, 1, 2]
    # 10:12 arrives one batch after the watermark passed its window and is still
    # counted; 10:13 and 10:03/10:04 arrive later and are dropped.
    assert got == [("10:00", 2), ("10:05", 1), ("10:10", 1)]


def _done(ts: str, status="COMPLETED"):
    return {"event_id": ts, "timestamp": f"2024-01-01T{ts}:00", "ride_id": f"RD-{ts}", "status": status,
            "pickup_zone_id": "Z001", "ride_type": "Auto", "payment_mode": "UPI", "actual_fare": 10.0,
            "driver_rating": 4.0, "wait_time_minutes": 3.0, "duration_minutes": 9.0}


def test_cancelled_rides_do_not_move_the_revenue_watermark(spark, tmp_dir):
    topic, base = f"{tmp_dir}/topic", f"{tmp_dir}/out"
    _files(topic, [[_done("10:01"), _done("10:30")], [_done("23:00", "CANCELLED")]])
    out = _run(spark, "revenue_analytics", "ride_completed", topic, base)
    assert out.count() == 0  # the 10:00 hour stays open: its watermark is 10:20
    out2 = _run(spark, "cancellation_analytics", "ride_completed", topic, f"{tmp_dir}/out2")
    assert out2.count() == 2  # the cancellation table's clock did move


def test_restart_continues_without_duplicates(spark, tmp_dir):
    topic, base = f"{tmp_dir}/topic", f"{tmp_dir}/out"
    _files(topic, [[_req("10:01"), _req("10:02")], [_req("10:08")]])
    _run(spark, "ride_demand_by_zone", "ride_requests", topic, base)
    write_json_lines(f"{topic}/part-100.json", [_req("10:30")], mtime=time.time())
    out = _run(spark, "ride_demand_by_zone", "ride_requests", topic, base)
    got = sorted((r.window_start.strftime("%H:%M"), r.total_requests) for r in out.collect())
    assert got == [("10:00", 2), ("10:05", 1)]


def test_rewriting_a_batch_id_replaces_it(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "Z001", 1)], "window_start timestamp, zone_id string, n int")
    w = batch_writer(path, "t", ("zone_id",), audit_path=f"{tmp_dir}/audit")
    w(df, 7)
    w(df, 7)
    assert spark.read.parquet(path).count() == 1
    hist = read_audit(spark, f"{tmp_dir}/audit").collect()
    assert len(hist) == 1 and hist[0].num_rows == 1


@pytest.mark.parametrize("table", list(GOLD))
def test_stream_equals_batch_up_to_the_watermark(spark, table):
    name = f"stream_{table}"
    assert_same(E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name], SF_SMALL)


@pytest.mark.parametrize("name", ["raw_ride_completed", "replay_demand", "table_history", "compact_gold"])
def test_sinks_replay_history_compaction(spark, name):
    assert_same(E.queries()[name](spark, SF_SMALL), E.oracle_sql()[name], SF_SMALL)


def test_start_all_queries_and_history(spark, tmp_dir):
    from rideflux.plans.queries_ops import file_topic
    topics = {s: file_topic(spark, SF_SMALL, s, tmp_dir) for s in PARSERS}
    base = f"{tmp_dir}/app"
    qs = jobs.start_all(spark, base, topic_paths=topics, max_per_trigger=None, available_now=True)
    assert len(qs) == 8
    jobs.run_available_now(qs)
    for t in GOLD:
        assert jobs.read_gold(spark, base, t).count() > 0
    raw = jobs.read_raw(spark, base, "ride_requests")
    assert raw.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    hist = table_history(spark, base, limit=3)
    assert hist.select("table_name").distinct().count() == 8
    assert hist.groupBy("table_name").count().where(F.col("count") > 3).count() == 0
    assert os.path.isdir(f"{base}/_checkpoints/ride_demand_by_zone")


def test_topic_records_are_written_once_and_by_slice(spark, tmp_dir):
    from rideflux.plans.queries_ops import SLICES, file_topic, files_per_slice
    n = 4000
    spark.range(n).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id * 60)::timestamp_ntz AS ts", "id % 9 AS user_id",
        "IF(id % 4 = 0, 'view', 'click') AS event_type", "id / 4.0D AS value", "concat('{\"k\": ', id % 100, '}') AS props",
    ).write.parquet(f"{tmp_dir}/sf/events.parquet")
    topic = file_topic(spark, f"{tmp_dir}/sf", "ride_completed", f"{tmp_dir}/base")
    written = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_dir}/base")
    assert written.count() == n * 3 // 4
    files = sorted((f for f in os.listdir(topic) if f.startswith("part-")), key=lambda f: os.path.getmtime(f"{topic}/{f}"))
    per = files_per_slice(spark)
    assert len(files) == SLICES * per
    for i in range(SLICES):
        ids = [int(r[0]) for r in spark.read.text([f"{topic}/{f}" for f in files[i * per:(i + 1) * per]]).select(
            F.regexp_extract("value", '"event_id":"CMP-([0-9]+)"', 1)).collect()]
        assert sorted(ids) == [k for k in range(1, n) if k % 4 and min((k - 1) * SLICES // (n - 2), SLICES - 1) == i]


def test_await_any_returns_when_one_query_ends(spark, tmp_dir):
    topic = f"{tmp_dir}/topic"
    _files(topic, [[_req("10:01")], [_req("10:09")]])
    parsed = PARSERS["ride_requests"](read_topic_stream(spark, "ride_requests", path=topic, max_per_trigger=1))
    qs = [jobs.start_gold_query(parsed, "ride_demand_by_zone", f"{tmp_dir}/a", available_now=True),
          jobs.start_raw_query(parsed, "ride_requests", f"{tmp_dir}/a", available_now=True)]
    jobs.await_any(spark, qs)
    for q in qs:
        q.awaitTermination()
    assert not any(q.isActive for q in qs)


def test_pipeline_health_from_audit(spark, tmp_dir):
    from rideflux.streaming.history import pipeline_health
    topic, base = f"{tmp_dir}/topic", f"{tmp_dir}/out"
    _files(topic, [[_req("10:01"), _req("10:02")], [_req("10:08")], [_req("10:20")]])
    _run(spark, "ride_demand_by_zone", "ride_requests", topic, base)
    h = pipeline_health(spark, base).collect()
    assert len(h) == 1 and h[0].table_name == "ride_demand_by_zone"
    assert h[0].writes >= 1 and h[0].rows_written == 2 and h[0].max_lag_sec > 0


def test_backfill_from_a_topic_read_as_batch(spark, tmp_dir):
    """The same decode + aggregate over the topic files read as a bounded batch."""
    from rideflux.operators.gold import ride_demand_by_zone
    from rideflux.plans.queries_gold import gold
    from rideflux.plans.queries_ops import file_topic
    from rideflux.sources.readers import read_topic_batch
    topic = file_topic(spark, SF_SMALL, "ride_requests", tmp_dir)
    back = ride_demand_by_zone(PARSERS["ride_requests"](read_topic_batch(spark, topic)))
    back = back.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
    direct = gold(spark, SF_SMALL, "ride_demand_by_zone")
    assert back.exceptAll(direct).count() == 0 and direct.exceptAll(back).count() == 0


def test_incremental_compaction_of_the_sink(spark, tmp_dir):
    """Batches compacted run by run: no row lost or doubled, a retried run
    replaces itself, nothing new gives None."""
    from rideflux.operators.layout import compact_new_batches, read_compacted
    topic, base, out = f"{tmp_dir}/topic", f"{tmp_dir}/sink", f"{tmp_dir}/compacted"
    table = "ride_demand_by_zone"
    _files(topic, [[_req("10:01"), _req("10:02", "Z002")], [_req("10:08")], [_req("10:20")]])
    _run(spark, table, "ride_requests", topic, base)
    sink = jobs.gold_path(base, table)
    done = jobs.committed_batch(spark, base, table)
    top = compact_new_batches(spark, sink, out, table, done, after_batch=-1)
    assert top is not None
    assert compact_new_batches(spark, sink, out, table, done, after_batch=-1) == top  # retry: same run replaced
    assert compact_new_batches(spark, sink, out, table, done, after_batch=top) is None
    write_json_lines(f"{topic}/part-100.json", [_req("10:40")], mtime=time.time())
    _run(spark, table, "ride_requests", topic, base)
    top2 = compact_new_batches(spark, sink, out, table, jobs.committed_batch(spark, base, table), after_batch=top)
    assert top2 is not None and top2 > top
    got = read_compacted(spark, out, table)
    want = jobs.read_gold(spark, base, table)
    assert got.count() == want.count() == 4
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_fan_out_reads_each_topic_once_and_matches(spark, tmp_dir):
    """Gold queries fed from the silver table give the same tables as gold
    queries reading the topics directly."""
    from rideflux.plans.queries_ops import file_topic
    topics = {s: file_topic(spark, SF_SMALL, s, tmp_dir) for s in PARSERS}
    direct, fanned = f"{tmp_dir}/direct", f"{tmp_dir}/fanned"
    jobs.run_available_now(jobs.start_all(spark, direct, topic_paths=topics, max_per_trigger=None,
                                          available_now=True, raw=False))
    qs = jobs.start_fan_out(spark, fanned, topic_paths=topics, max_per_trigger=None, available_now=True)
    assert len(qs) == 3 + 5
    jobs.run_available_now(qs)
    for t in GOLD:
        a, b = jobs.read_gold(spark, direct, t), jobs.read_gold(spark, fanned, t)
        assert a.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, t
    silver = spark.read.parquet(jobs.silver_path(fanned, "ride_requests"))
    assert silver.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
