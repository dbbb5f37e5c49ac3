"""Window and aggregate semantics of the gold tables on hand-made rows."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from rideflux.operators import gold as G
from rideflux.plans.queries_gold import silver
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1, 0, 3)


def _requests(spark, rows):
    schema = ("event_ts timestamp_ntz, pickup_zone_id string, pickup_zone_name string, ride_type string, "
              "estimated_fare double, surge_multiplier double, distance_km double")
    return spark.createDataFrame(rows, schema)


def test_sliding_window_puts_a_row_in_two_windows(spark):
    df = _requests(spark, [(T0, "Z001", "City Center", "Economy", 100.0, 1.6, 3.0)])
    out = G.surge_pricing_metrics(df).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end) for r in out] == [
        (dt.datetime(2023, 12, 31, 23, 55), dt.datetime(2024, 1, 1, 0, 5)),
        (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 10)),
    ]
    assert all(r.high_surge_count == 1 and r.total_rides == 1 for r in out)


def test_tumbling_sums_equal_rows_and_sliding_doubles(spark):
    req = silver(spark, SF_SMALL, "ride_requests")
    n = req.count()
    assert G.ride_demand_by_zone(req).agg(F.sum("total_requests")).collect()[0][0] == n
    assert G.surge_pricing_metrics(req).agg(F.sum("total_rides")).collect()[0][0] == 2 * n


def test_cancelled_plus_completed_equals_total(spark):
    cmp = silver(spark, SF_SMALL, "ride_completed")
    bad = G.cancellation_analytics(cmp).where(F.col("cancelled") + F.col("completed") != F.col("total"))
    assert bad.count() == 0


def test_null_event_time_never_enters_a_window(spark):
    df = _requests(spark, [(None, "Z001", "City Center", "Economy", 1.0, 1.0, 1.0),
                           (T0, "Z001", "City Center", "Economy", 3.0, 1.0, 1.0)])
    out = G.ride_demand_by_zone(df).collect()
    assert len(out) == 1 and out[0].total_requests == 1 and out[0].avg_estimated_fare == 3.0


def test_null_driver_and_availability_are_not_counted(spark):
    schema = ("event_ts timestamp_ntz, zone_id string, zone_name string, driver_id string, "
              "is_available boolean, current_speed_kmh double, latitude double, longitude double")
    rows = [(T0, "Z001", "City Center", None, None, 10.0, 26.9, 75.8),
            (T0, "Z001", "City Center", "DRV-1", True, 20.0, 26.9, 75.8),
            (T0, "Z001", "City Center", "DRV-2", False, 30.0, 26.9, 75.8)]
    r = G.location_density(spark.createDataFrame(rows, schema)).collect()[0]
    assert (r.driver_pings, r.available_drivers, r.avg_speed_kmh) == (2, 1, 20.0)


def test_revenue_counts_only_completed_rides(spark):
    schema = ("event_ts timestamp_ntz, pickup_zone_id string, ride_type string, payment_mode string, "
              "status string, actual_fare double, driver_rating double, wait_time_minutes double, "
              "duration_minutes double")
    rows = [(T0, "Z001", "Auto", "UPI", "COMPLETED", 100.10, 4.0, 5.0, 10.0),
            (T0, "Z001", "Auto", "UPI", "COMPLETED", 50.20, 5.0, 7.0, 20.0),
            (T0, "Z001", "Auto", "UPI", "CANCELLED", 999.0, 1.0, 1.0, 1.0)]
    r = G.revenue_analytics(spark.createDataFrame(rows, schema)).collect()[0]
    assert (r.completed_rides, r.total_revenue, r.avg_fare, r.avg_driver_rating) == (2, 150.3, 75.15, 4.5)


def test_round_half_up_on_decimal_text(spark):
    assert spark.sql("SELECT round(1.005D, 2) AS r").collect()[0].r == 1.01


def test_gold_columns_follow_the_declared_schema(spark):
    from rideflux import schemas as S
    for table, (fn, stream) in G.GOLD.items():
        assert fn(silver(spark, SF_SMALL, stream)).columns == S.GOLD_COLUMNS[table]


def test_event_range_restriction_is_exact_for_every_table(spark):
    """Windows starting inside the requested days come out the same whether
    gold is built from all events or only from the events that can reach them."""
    from rideflux.plans.queries_gold import gold, gold_days
    for table in G.GOLD:
        full = gold(spark, SF_SMALL, table).where(
            (F.col("window_start") >= F.lit("2024-01-29").cast("timestamp_ntz"))
            & (F.col("window_start") < F.lit("2024-01-31").cast("timestamp_ntz")))
        part = gold_days(spark, SF_SMALL, table, "2024-01-30", 2).where(
            F.col("window_start") >= F.lit("2024-01-29").cast("timestamp_ntz"))
        assert full.count() > 0
        assert full.exceptAll(part).count() == 0 and part.exceptAll(full).count() == 0, table


def test_null_fares_are_skipped_and_all_null_gives_null(spark):
    rows = [(T0, "Z001", "City Center", "Economy", 10.0, 1.2, 2.0),
            (T0, "Z001", "City Center", "Economy", None, 1.4, 2.0),
            (T0, "Z002", "Airport", "Economy", None, None, None)]
    out = {r.zone_id: r for r in G.ride_demand_by_zone(_requests(spark, rows)).collect()}
    assert (out["Z001"].total_requests, out["Z001"].avg_estimated_fare, out["Z001"].avg_surge) == (2, 10.0, 1.3)
    assert out["Z002"].total_requests == 1
    assert out["Z002"].avg_estimated_fare is None and out["Z002"].avg_surge is None
    assert out["Z002"].total_distance_km is None


def test_empty_input_gives_empty_tables(spark):
    empty = _requests(spark, [])
    assert G.ride_demand_by_zone(empty).count() == 0
    assert G.surge_pricing_metrics(empty).count() == 0


def test_nan_and_out_of_range_values_do_not_stop_the_query(spark):
    rows = [(T0, "Z001", "City Center", "Economy", 10.0, 1.2, 2.0),
            (T0, "Z001", "City Center", "Economy", float("nan"), 1.4, 1e30),
            (T0, "Z001", "City Center", "Economy", 1e30, 1.6, 3.0)]
    r = G.ride_demand_by_zone(_requests(spark, rows)).collect()[0]
    # No value is left out: a NaN makes the plain average NaN, 1e30 stays in the plain sum.
    assert (r.total_requests, r.avg_surge, r.total_distance_km) == (3, 1.4, 1e30)
    assert math.isnan(r.avg_estimated_fare)
