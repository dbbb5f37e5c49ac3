"""Analytic operators over silver rows and gold windows.

As-of join, complete time axes, mergeable sketches (distinct counts and
quantiles), grouping sets and a newest-first feed.  All are DataFrame
expressions: partial aggregation first, one shuffle per aggregate.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators.gold import EXACT_SUM
from rideflux.plans.dashboard import event_feed

#: Largest rank error that a quantile from merged sketches (k = 200) may have.
RANK_ERROR = 0.02
#: Relative error within which a merged distinct count stays.
COUNT_ERROR = 0.03


# --- as-of join ------------------------------------------------------------------

def as_of_join(left: DataFrame, right: DataFrame, key: str, value: str, out: str, *, left_time: str = "event_ts",
               right_time: str = "event_ts", tie: str = "event_id", bucket: str = "1 hour") -> DataFrame:
    """``left`` with ``out``: the ``value`` of the newest ``right`` row of the
    same ``key`` at or before the left row's time; null if there is none.

    Of right rows at one time the one with the largest ``tie`` counts; a right
    row's null value counts like any other.  Left rows without a key or a time
    get null.  No join: both sides are united and the last right row is
    carried forward within a key and ``bucket`` of time, so a key that holds
    most rows is split over its buckets.  What a bucket starts with comes from
    one row per key and bucket, aggregated first.
    """
    names = left.columns
    held = F.struct(F.col(value).alias("v"))
    lhs = left.select(
        F.struct(*names).alias("_row"), F.col(key).alias("_k"), F.col(left_time).alias("_t"),
        F.lit(None).cast(dict(right.dtypes)[tie]).alias("_tie"),
        F.lit(None).cast(right.select(held.alias("x")).schema["x"].dataType).alias("_v"), F.lit(2).alias("_side"))
    rhs = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.lit(None).cast(lhs.schema["_row"].dataType).alias("_row"), F.col(key).alias("_k"), F.col(right_time).alias("_t"),
        F.col(tie).alias("_tie"), held.alias("_v"), F.lit(1).alias("_side"))
    both = lhs.where("_k IS NOT NULL AND _t IS NOT NULL").unionByName(rhs).withColumn("_b", F.window("_t", bucket)["start"])
    # One row per key and bucket: its last right row; carried to the next buckets.
    order = F.when(F.col("_side") == 1, F.struct("_t", "_tie", "_v"))
    ends = both.groupBy("_k", "_b").agg(F.max(F.struct(order.isNotNull().alias("has"), order.alias("r"))).alias("end"))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    edges = ends.select("_k", "_b", F.last(F.when(F.col("end.has"), F.col("end.r._v")), ignorenulls=True).over(earlier).alias("_v"))
    edges = edges.where("_v IS NOT NULL").select(
        F.lit(None).cast(lhs.schema["_row"].dataType).alias("_row"), "_k", F.col("_b").alias("_t"),
        F.lit(None).cast(dict(right.dtypes)[tie]).alias("_tie"), "_v", F.lit(0).alias("_side"), "_b")
    within = Window.partitionBy("_k", "_b").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    # Edge rows come first of all rows of their bucket: a bucket's start is its smallest time.
    carried = both.unionByName(edges).withColumn("_last", F.last("_v", ignorenulls=True).over(within))
    found = carried.where("_side = 2").select("_row.*", F.col("_last.v").alias(out))
    unkeyed = left.where(F.col(key).isNull() | F.col(left_time).isNull()).withColumn(
        out, F.lit(None).cast(dict(right.dtypes)[value]))
    return found.unionByName(unkeyed.select(*names, out))


# --- complete axes ----------------------------------------------------------------

def complete_hours(df: DataFrame, hour: str = "hour", first: int = 0, last: int = 23, zero=(), by: dict[str, list] | None = None) -> DataFrame:
    """``df`` (one row per hour, and per value of the columns ``by``) with a
    row for every hour from ``first`` to ``last`` and every listed value.

    Columns of ``zero`` are 0 in the added rows, others null.  Rows outside the
    axes are left out.  The axes are a literal table of a few hundred rows.
    """
    by = by or {}
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias(hour))
    for name, values in by.items():
        spine = spine.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    kinds = dict(df.dtypes)
    filled = [F.coalesce(F.col(c), F.lit(0).cast(kinds[c])).alias(c) if c in zero else F.col(c) for c in df.columns]
    return F.broadcast(spine).join(df, [hour, *by], "left").select(*filled)


# --- mergeable sketches -----------------------------------------------------------

def driver_sketches(pings: DataFrame, minutes: int = 5) -> DataFrame:
    """Distinct drivers per zone and window as a mergeable sketch: a binary
    column of bounded size that can be united over any range of windows and
    zones, which distinct counts cannot."""
    return pings.where("event_ts IS NOT NULL").groupBy(
        F.window("event_ts", f"{minutes} minutes").alias("w"), "zone_id").agg(
            F.hll_sketch_agg("driver_id", 14).alias("drivers")).select(
                F.col("w.start").alias("window_start"), "zone_id", "drivers")


def drivers_by(sketches: DataFrame, *keys: Column) -> DataFrame:
    """Distinct drivers per ``keys`` from united window sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("drivers")).alias("drivers"))


def wait_sketches(completed: DataFrame, minutes: int = 60) -> DataFrame:
    """Waiting times of completed rides per pickup zone and window as a
    mergeable quantile sketch."""
    done = completed.where(F.col("status") == S.STATUS_COMPLETED).where("event_ts IS NOT NULL AND wait_time_minutes IS NOT NULL")
    return done.groupBy(F.window("event_ts", f"{minutes} minutes").alias("w"), F.col("pickup_zone_id").alias("zone_id")).agg(
        F.kll_sketch_agg_double("wait_time_minutes").alias("waits"), F.count(F.lit(1)).alias("rides")).select(
            F.col("w.start").alias("window_start"), "zone_id", "rides", "waits")


def wait_quantiles(sketches: DataFrame, *keys: Column) -> DataFrame:
    """Rides, median and 95th percentile of the waiting time per ``keys`` from
    merged window sketches."""
    return sketches.groupBy(*keys).agg(F.sum("rides").alias("rides"), F.kll_merge_agg_double("waits").alias("_s")).withColumns({
        "p50": F.kll_sketch_get_quantile_double("_s", F.lit(0.5)), "p95": F.kll_sketch_get_quantile_double("_s", F.lit(0.95))}).drop("_s")


# --- grouping sets ----------------------------------------------------------------

def revenue_rollup(revenue: DataFrame) -> DataFrame:
    """Revenue and rides by day, zone and ride type with all subtotals in one
    pass; ``level`` is the grouping id (0: all three given, 7: grand total)."""
    return revenue.withColumn("day", F.to_date("window_start")).rollup("day", "zone_id", "ride_type").agg(
        F.grouping_id().cast("long").alias("level"), F.sum("completed_rides").alias("rides"),
        F.expr(f"{EXACT_SUM.format(x='total_revenue')} AS revenue"))


# --- newest-first feed ------------------------------------------------------------

def write_by_date(silver: DataFrame, path: str) -> None:
    """Silver rows partitioned by event date (rows without a time in a partition of their own)."""
    silver.withColumn("event_date", F.to_date("event_ts")).hint("rebalance", "event_date").write.partitionBy("event_date").parquet(path)


def event_dates(tables: dict[str, DataFrame]) -> list[dt.date]:
    """Dates that the tables have partitions for, newest first (file names only)."""
    found = {m for t in tables.values() for f in t.inputFiles() for m in re.findall(r"/event_date=(\d{4}-\d\d-\d\d)/", f)}
    return sorted((dt.date.fromisoformat(d) for d in found), reverse=True)


def pruned_feed(tables: dict[str, DataFrame], n: int = 8) -> DataFrame:
    """``event_feed`` over tables written by ``write_by_date``.

    Dates are read backward, twice as many each time, until ``n`` rows are
    held: an older date cannot win then, and the scan is pruned to those read.
    Only where all dates hold fewer than ``n`` rows is everything read, for the
    rows without a time, which come last.
    """
    dates, take = event_dates(tables), 1
    streams = ("ride_requests", "ride_completed", "driver_locations")
    while take <= len(dates):
        recent = [tables[s].where(F.col("event_date") >= F.lit(dates[take - 1])) for s in streams]
        feed = event_feed(*recent, n=n)
        if feed.count() >= n:
            return feed
        if take == len(dates):
            break
        take = min(2 * take, len(dates))
    return event_feed(*[tables[s] for s in streams], n=n)
