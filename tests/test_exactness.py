"""Values kept as they are, joins with missing keys, and jobs on odd tables."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.functions.expressions import exact_avg, money_sum, parse_event_time
from rideflux.operators import gold as G
from rideflux.operators import joins as J
from rideflux.operators import layout
from rideflux.plans.queries_gold import silver
from rideflux.streaming import jobs
from rideflux.streaming.sinks import batch_writer, read_audit
from tests.conftest import SF_SMALL

REQ = ("event_ts timestamp_ntz, pickup_zone_id string, pickup_zone_name string, estimated_fare double, "
       "surge_multiplier double, distance_km double")
T0 = dt.datetime(2024, 1, 1, 10)


def _demand(spark, rows):
    return G.ride_demand_by_zone(spark.createDataFrame([(T0, "Z001", "A", *r) for r in rows], REQ)).collect()[0]


def test_small_distances_are_not_rounded_before_summing(spark):
    assert _demand(spark, [(1.0, 1.0, 0.004)] * 1000).total_distance_km == 4.0


def test_large_and_nan_values_are_not_left_out(spark):
    r = _demand(spark, [(1e17, 1.0, 1.0), (10.0, 1.0, 1.0)])
    assert r.avg_estimated_fare == pytest.approx(5e16) and r.total_requests == 2
    r = _demand(spark, [(1e30, 1.0, 1e30), (10.0, 1.0, 1.0), (None, None, None)])
    assert r.avg_estimated_fare == pytest.approx(5e29) and r.total_distance_km == pytest.approx(1e30)
    assert math.isnan(_demand(spark, [(float("nan"), 1.0, 1.0), (10.0, 1.0, 1.0)]).avg_estimated_fare)


@pytest.mark.parametrize("stream, keys, values", [
    ("ride_requests", ["pickup_zone_id"], ["estimated_fare", "distance_km", "surge_multiplier"]),
    ("ride_completed", ["pickup_zone_id", "ride_type"], ["actual_fare", "driver_rating", "duration_minutes"])])
def test_exact_sums_agree_with_plain_ones(spark, stream, keys, values):
    rows = silver(spark, SF_SMALL, stream).groupBy(*keys).agg(*[
        f(v).alias(f"{n}_{v}") for v in values for n, f in (("s", money_sum), ("a", exact_avg), ("ps", F.sum), ("pa", F.avg))])
    for r in rows.collect():
        for v in values:
            assert r[f"s_{v}"] == pytest.approx(r[f"ps_{v}"], rel=1e-9)
            assert r[f"a_{v}"] == pytest.approx(r[f"pa_{v}"], rel=1e-9)


@pytest.mark.parametrize("text, expected", [
    ("2024", dt.datetime(2024, 1, 1)), ("2024-01", dt.datetime(2024, 1, 1)), ("2024-1-5", dt.datetime(2024, 1, 5)),
    ("2024-01-01T10", dt.datetime(2024, 1, 1, 10)), ("2024-01-01T9:05", dt.datetime(2024, 1, 1, 9, 5)),
    ("2024-01-01T10:00:00 UTC", dt.datetime(2024, 1, 1, 10)), ("2024-01-01T10:00:00 Europe/Paris", dt.datetime(2024, 1, 1, 9))])
def test_every_form_that_spark_parses_is_read(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_event_time("s").cast("timestamp_ntz")).first()[0] == expected


def test_windows_without_averages_have_no_weight(spark):
    w = "window_start timestamp_ntz, zone_id string, total_requests long, avg_estimated_fare double, avg_surge double"
    demand = spark.createDataFrame([(T0, "Z001", 10, 100.0, 2.0), (T0, "Z001", 10, None, None), (T0, "Z002", 5, None, None)], w)
    revenue = spark.createDataFrame([], "zone_id string, total_revenue double")
    cancels = spark.createDataFrame([("Z003", 0, 0)], "zone_id string, total long, cancelled long")
    got = {r.zone_id: r for r in J.zone_performance(demand, revenue, cancels).collect()}
    assert (got["Z001"].avg_fare, got["Z001"].avg_surge, got["Z001"].high_surge) == (100.0, 2.0, True)
    assert got["Z002"].requests == 5 and got["Z002"].avg_fare is None and got["Z003"].cancel_rate is None


def test_requests_without_a_ride_id_stay_apart(spark):
    req = spark.createDataFrame(
        [(r, f"e{i}", T0, "Z001", "Auto", "REQUESTED", 1.0) for i, r in enumerate([None, None, "r1", "r1"])],
        "ride_id string, event_id string, event_ts timestamp_ntz, pickup_zone_id string, ride_type string, status string, "
        "estimated_fare double")
    done = spark.createDataFrame([(None, "c", T0, "COMPLETED", 2.0)],
                                 "ride_id string, event_id string, event_ts timestamp_ntz, status string, actual_fare double")
    got = [(r.ride_id, r.status) for r in J.ride_lifecycle(req, done).collect()]
    assert sorted(got, key=str) == [("r1", "REQUESTED"), (None, "REQUESTED"), (None, "REQUESTED")]


def test_zone_table_join_keeps_every_point_once(spark):
    points = spark.createDataFrame([(None, 1.0, 1.0), (None, 1.0, 1.0), ("a", 80.0, 100.0), ("b", None, 1.0),
                                    ("c", float("nan"), 1.0), ("d", 1e300, 1.0)], "event_id string, latitude double, longitude double")
    zones = spark.createDataFrame([("W", -90.0, 90.0, -180.0, 180.0), ("P", 1.0, 1.0, 1.0, 1.0), ("N", None, 1.0, 0.0, 1.0)],
                                  "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    got = [(r.event_id, r.assigned_zone_id) for r in J.assign_zone_join(points, zones).collect()]
    assert sorted(got, key=str) == [("a", "W"), ("b", None), ("c", None), ("d", None), (None, "P"), (None, "P")]
    none = J.assign_zone_join(points, zones.limit(0)).collect()
    assert len(none) == 6 and not any(r.assigned_zone_id for r in none)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, 5.0), (1, 5.0)], [(1, None), (2, 3.0)]])
def test_zorder_of_empty_and_constant_columns(spark, tmp_dir, rows):
    df = spark.createDataFrame(rows, "a long, b double")
    layout.zorder_cluster(df, ["a", "b"], f"{tmp_dir}/z", materialize=True)
    got = spark.read.schema("a long, b double").parquet(f"{tmp_dir}/z").collect()
    assert sorted(map(str, got)) == sorted(map(str, df.collect()))


def _windows(spark, *zones, hour=10):
    row = {"window_start": dt.datetime(2024, 1, 1, hour), "window_end": dt.datetime(2024, 1, 1, hour, 5), "total_requests": 1}
    return spark.createDataFrame([tuple({**row, "zone_id": z}.get(f.name) for f in S.GOLD_SCHEMAS["ride_demand_by_zone"])
                                  for z in zones], _nullable(S.GOLD_SCHEMAS["ride_demand_by_zone"]))


def _nullable(schema):
    from pyspark.sql.types import StructField, StructType
    return StructType([StructField(f.name, f.dataType) for f in schema])


def test_compaction_waits_for_the_audit_row(spark, tmp_dir):
    """A batch that becomes visible in two steps loses no row."""
    table, sink = "ride_demand_by_zone", jobs.gold_path(tmp_dir, "ride_demand_by_zone")
    part = S.GOLD_SPECS[table].partition_cols
    write = batch_writer(sink, table, part, jobs.audit_path(tmp_dir))
    write(_windows(spark, "Z001"), 4)
    # The first half of batch 5: its files are there, its audit row is not.
    batch_writer(sink, table, part)(_windows(spark, "Z001", hour=11), 5)
    top = layout.compact_new_batches(spark, sink, f"{tmp_dir}/c", table, jobs.committed_batch(spark, tmp_dir, table))
    assert top == 4
    write(_windows(spark, "Z001", "Z002", hour=11), 5)
    assert layout.compact_new_batches(spark, sink, f"{tmp_dir}/c", table, jobs.committed_batch(spark, tmp_dir, table), top) == 5
    assert layout.read_compacted(spark, f"{tmp_dir}/c", table).count() == 3


def test_retried_batches_have_one_audit_row_and_rejects_are_kept(spark, tmp_dir):
    table = "ride_demand_by_zone"
    write = batch_writer(jobs.gold_path(tmp_dir, table), table, S.GOLD_SPECS[table].partition_cols, jobs.audit_path(tmp_dir),
                         one_file_per_value=True, schema=S.GOLD_SCHEMAS[table], rejects_path=jobs.rejects_path(tmp_dir, table))
    for _ in range(2):
        write(_windows(spark, "Z001", None), 7)
    write(_windows(spark), 8)
    audit = read_audit(spark, jobs.audit_path(tmp_dir)).collect()
    assert [(r.batch_id, r.num_rows) for r in audit] == [(7, 1)]
    assert [r.zone_id for r in jobs.read_gold(spark, tmp_dir, table).collect()] == ["Z001"]
    assert [r.reject_reason for r in spark.read.parquet(jobs.rejects_path(tmp_dir, table)).collect()] == ["null zone_id"]


def test_zone_table_join_takes_sides_beyond_the_grid(spark):
    inf = float("inf")
    points = spark.createDataFrame([("a", 5.0, 5.0), ("b", 3e6, 5.0), ("c", -inf, 1e300), ("d", 1e6, -2e6), ("e", float("nan"), 1.0),
                                    ("f", None, 1.0), ("g", 9e6, 9e6)], "event_id string, latitude double, longitude double")
    zones = spark.createDataFrame(
        [("Z", -inf, inf, -inf, inf), ("Y", 2e6, 4e6, 0.0, 10.0), ("X", 0.0, 10.0, 0.0, inf), ("V", 1e6, 1e6, -inf, -2e6),
         ("N", float("nan"), float("nan"), 0.0, 1.0), ("I", inf, inf, -90.0, 1e5), ("U", 5e6, 8e6, 5e6, 8e6)],
        "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    got = {r.event_id: r.assigned_zone_id for r in J.assign_zone_join(points, zones).collect()}
    assert got == {"a": "X", "b": "Y", "c": "Z", "d": "V", "e": None, "f": None, "g": "Z"}


def test_a_lost_mark_loses_and_doubles_no_row(spark, tmp_dir):
    table, sink, out = "ride_demand_by_zone", f"{tmp_dir}/sink", f"{tmp_dir}/c"
    from rideflux import schemas as S
    from rideflux.__main__ import _read_mark

    def row(batch):
        return (dt.datetime(2024, 1, 1, batch), dt.datetime(2024, 1, 1, batch, 5), "Z001", "City Center", batch, 1.0, 1.0, 1.0)

    for batch in range(4):
        spark.createDataFrame([row(batch)], S.GOLD_SCHEMAS[table]).withColumn("batch_id", F.lit(batch).cast("long")).write.mode(
            "append").partitionBy("batch_id", "zone_id").parquet(sink)
    assert layout.compact_new_batches(spark, sink, out, table, 1, -1) == 1
    assert layout.compact_new_batches(spark, sink, out, table, 2, 1) == 2
    assert layout.read_compacted(spark, out, table).count() == 3
    # Without a mark the next run starts over; the runs it covers are not read any more.
    assert _read_mark(spark, f"{tmp_dir}/mark") == -1
    assert layout.compact_new_batches(spark, sink, out, table, 2, -1) == 2
    assert sorted(r.total_requests for r in layout.read_compacted(spark, out, table).collect()) == [0, 1, 2]
    assert layout.compact_new_batches(spark, sink, out, table, 3, 2) == 3
    assert sorted(r.total_requests for r in layout.read_compacted(spark, out, table).collect()) == [0, 1, 2, 3]
    for top in (1, 3, 2):  # marks are appended, the largest counts
        spark.createDataFrame([(top,)], "batch_id long").write.mode("append").parquet(f"{tmp_dir}/mark")
    assert _read_mark(spark, f"{tmp_dir}/mark") == 3
