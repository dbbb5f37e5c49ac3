"""Edge rows for measures, panels, joins and pricing rules."""

from __future__ import annotations

import datetime as dt


from rideflux import schemas as S
from rideflux.functions.expressions import expected_fare, heatmap_band, rule_surge, surge_tier
from rideflux.operators import joins as J
from rideflux.plans import dashboard as DB
from rideflux.plans import measures as M

AS_OF = "2024-01-30"
REV_SCHEMA = ("window_start timestamp_ntz, zone_id string, ride_type string, payment_mode string, "
              "completed_rides long, total_revenue double, avg_driver_rating double, avg_wait_time double")


def _rev(spark, rows):
    return spark.createDataFrame(rows, REV_SCHEMA)


def test_wow_change_is_zero_without_a_previous_week(spark):
    rows = [(dt.datetime(2024, 1, 29, 10), "Z001", "Auto", "UPI", 2, 100.0, 4.0, 5.0)]
    r = M.revenue_wow_change(_rev(spark, rows), AS_OF).collect()[0]
    assert (r.this_week_revenue, r.last_week_revenue, r.wow_change_pct) == (100.0, 0.0, 0.0)


def test_wow_change_uses_whole_days(spark):
    rows = [(dt.datetime(2024, 1, 30, 23), "Z001", "Auto", "UPI", 1, 150.0, 4.0, 5.0),   # this week
            (dt.datetime(2024, 1, 23, 23), "Z001", "Auto", "UPI", 1, 100.0, 4.0, 5.0),   # previous week
            (dt.datetime(2024, 1, 16, 23), "Z001", "Auto", "UPI", 1, 999.0, 4.0, 5.0)]   # older: ignored
    r = M.revenue_wow_change(_rev(spark, rows), AS_OF).collect()[0]
    assert (r.this_week_revenue, r.last_week_revenue, r.wow_change_pct) == (150.0, 100.0, 50.0)


def test_top_zone_tie_goes_to_smaller_id(spark):
    rows = [(dt.datetime(2024, 1, 30, 1), "Z004", "Auto", "UPI", 1, 50.0, 4.0, 5.0),
            (dt.datetime(2024, 1, 30, 1), "Z002", "Auto", "UPI", 1, 50.0, 4.0, 5.0),
            (dt.datetime(2024, 1, 30, 1), "Z003", "Auto", "UPI", 1, 20.0, 4.0, 5.0)]
    r = M.top_zone_by_revenue(_rev(spark, rows)).collect()
    assert [(x.zone_id, x.zone_revenue) for x in r] == [("Z002", 50.0)]


def test_ratio_measures_are_zero_on_empty_input(spark):
    empty = spark.createDataFrame([], "window_start timestamp_ntz, zone_id string, total long, cancelled long, "
                                      "completed long, cancellation_rate double")
    assert M.cancellation_rate_pct(empty).collect()[0][0] == 0.0
    assert M.total_rides_today(spark.createDataFrame([], "window_start timestamp_ntz, total_requests long"),
                               AS_OF).collect()[0][0] == 0


def test_surge_tier_thresholds(spark):
    df = spark.createDataFrame([(2.0,), (1.99,), (1.5,), (1.2,), (1.19,), (None,)], "x double")
    got = [r[0] for r in df.select(surge_tier("x")).collect()]
    assert got == ["Critical", "High", "High", "Moderate", "Normal", "Normal"]


def test_heatmap_bands(spark):
    df = spark.createDataFrame([(0.0,), (19.99,), (20.0,), (54.0,), (81.9,), (89.9,), (90.0,), (100.0,)], "s double")
    assert [r[0] for r in df.select(heatmap_band("s")).collect()] == [0, 0, 1, 2, 4, 5, 6, 6]


def test_point_in_two_boxes_and_in_none(spark):
    pts = spark.createDataFrame([("a", 26.89, 75.79), ("b", 0.0, 0.0), ("c", 26.83, 75.81), ("d", None, 75.8),
                                 ("e", 26.845, 75.79)],
                                "event_id string, latitude double, longitude double")
    got = {r.event_id: r.assigned_zone_id for r in J.assign_zone(pts).collect()}
    assert got == {"a": "Z001", "b": None, "c": "Z002", "d": None, "e": None}
    zones = spark.createDataFrame([(z.zone_id, z.lat_lo, z.lat_hi, z.lng_lo, z.lng_hi) for z in S.ZONES],
                                  "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    got2 = {r.event_id: r.assigned_zone_id for r in J.assign_zone_join(pts, zones).collect()}
    assert got2 == got
    for cell in (0.001, 0.02, 50.0):
        got3 = {r.event_id: r.assigned_zone_id for r in J.assign_zone_join(pts, zones, cell_deg=cell).collect()}
        assert got3 == got


def test_grid_zone_join_matches_literal_zones_on_real_pings(spark):
    from rideflux.plans.queries_gold import silver
    from tests.conftest import SF_SMALL
    pings = silver(spark, SF_SMALL, "driver_locations").select("event_id", "latitude", "longitude")
    zones = spark.createDataFrame([(z.zone_id, z.lat_lo, z.lat_hi, z.lng_lo, z.lng_hi) for z in S.ZONES],
                                  "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    a = J.assign_zone(pings).select("event_id", "assigned_zone_id")
    b = J.assign_zone_join(pings, zones, cell_deg=0.013).select("event_id", "assigned_zone_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_crowded_cells_equal_brute_force(spark, monkeypatch):
    """Many small, nested and equal boxes in one cell, hot and missing coordinates, a clashing column."""
    import random
    monkeypatch.setattr(J, "CELL_BOXES", 4)
    rng = random.Random(3)
    boxes = []
    for i in range(150):
        y, x, h, w = rng.random() / 20, rng.random() / 20, rng.random() / rng.choice((5, 50, 500)), rng.random() / 100
        boxes.append((f"Z{rng.randrange(90):03}", y, y + h, x, x + w))
    boxes += [("Y001", 0.01, 0.02, 0.01, 0.02)] * 20 + [("A", None, 1.0, 0.0, 1.0), (None, 0.0, 1.0, 0.0, 1.0), ("A", 1.0, 0.0, 0.0, 1.0)]
    rows = [(i, rng.random() / 15, rng.random() / 15, "kept") for i in range(300)]
    rows += [(1000 + i, 0.015, 0.015, "hot") for i in range(200)] + [(2000, None, 0.0, "x"), (2001, float("nan"), 0.0, "x"), (2002, -0.0, 0.0, "x")]
    points = spark.createDataFrame(rows, "event_id long, latitude double, longitude double, zone_id string")
    zones = spark.createDataFrame(boxes, "zone_id string, lat_lo double, lat_hi double, lng_lo double, lng_hi double")
    got = J.assign_zone_join(points, zones).collect()

    def zone(y, x):
        held = [z for z, a, b, c, d in boxes if None not in (z, a, y) and a <= y <= b and c <= x <= d]
        return min(held, default=None)

    assert sorted((r.event_id, r.assigned_zone_id, r.zone_id) for r in got) == [(i, zone(y, x), z) for i, y, x, z in sorted(rows, key=lambda r: r[0])]


def test_ride_lifecycle_dedups_and_keeps_unmatched(spark):
    req = spark.createDataFrame(
        [("r1", "REQ-1", dt.datetime(2024, 1, 1, 10), "Z001", "Auto", "REQUESTED", 100.0),
         ("r1", "REQ-1b", dt.datetime(2024, 1, 1, 10, 1), "Z001", "Auto", "REQUESTED", 100.0),
         ("r2", "REQ-2", dt.datetime(2024, 1, 1, 11), "Z002", "Bike", "REQUESTED", 40.0)],
        "ride_id string, event_id string, event_ts timestamp_ntz, pickup_zone_id string, ride_type string, "
        "status string, estimated_fare double")
    cmp = spark.createDataFrame(
        [("r1", "CMP-1", dt.datetime(2024, 1, 1, 10, 30), "COMPLETED", 110.5),
         ("r1", "CMP-1", dt.datetime(2024, 1, 1, 10, 30), "COMPLETED", 110.5)],
        "ride_id string, event_id string, event_ts timestamp_ntz, status string, actual_fare double")
    out = {r.ride_id: r for r in J.ride_lifecycle(req, cmp).collect()}
    assert len(out) == 2
    assert out["r1"].status == "COMPLETED" and out["r1"].fare_delta == 10.5
    assert out["r1"].requested_at == dt.datetime(2024, 1, 1, 10)
    assert out["r2"].status == "REQUESTED" and out["r2"].finished_at is None


def test_pricing_rules(spark):
    df = spark.createDataFrame([(8, "Z002", "Economy", 10.0, 1.7), (18, "Z001", "Bike", 2.0, 1.7),
                                (23, "Z003", "Premium", 5.0, 1.3), (12, "Z002", "Shared", 3.0, 1.2),
                                (3, "Z002", "Auto", 1.0, 1.5)],
                               "h int, z string, t string, d double, s double")
    rows = df.select(rule_surge("h", "z").alias("r"), expected_fare("t", "d", "s").alias("f")).collect()
    assert [r.r for r in rows] == [1.7, 1.7, 1.3, 1.2, 1.5]
    assert [r.f for r in rows] == [254.0, 65.8, 198.0, 73.2, 58.0]


def test_rating_histogram_keeps_empty_bins(spark):
    cmp = spark.createDataFrame([("COMPLETED", 4.9), ("COMPLETED", 5.0), ("CANCELLED", 1.0)],
                                "status string, driver_rating double")
    got = sorted((r.stars, r.rides) for r in DB.rating_histogram(cmp).collect())
    assert got == [(1, 0), (2, 0), (3, 0), (4, 1), (5, 1)]


def test_zone_performance_full_outer(spark):
    demand = spark.createDataFrame([("Z001", 2, 100.0, 1.6)],
                                   "zone_id string, total_requests long, avg_estimated_fare double, avg_surge double")
    revenue = spark.createDataFrame([("Z002", 10.0)], "zone_id string, total_revenue double")
    cancels = spark.createDataFrame([("Z001", 10, 2)], "zone_id string, total long, cancelled long")
    out = {r.zone_id: r for r in J.zone_performance(demand, revenue, cancels).collect()}
    assert set(out) == {"Z001", "Z002"}
    assert out["Z001"].cancel_flag == "high" and out["Z001"].high_surge is True and out["Z001"].revenue is None
    assert out["Z002"].requests is None and out["Z002"].revenue == 10.0
