"""Joins: zone performance, request ↔ completion link, point → zone.

Scale notes
* ``zone_performance`` combines three per-zone inputs: a union and one
  aggregate on ``zone_id`` gives the full outer join's rows with one shuffle
  (partial aggregation first, so a hot zone is combined map-side).
* ``ride_lifecycle`` deduplicates each side per ``ride_id`` with a
  min/max-of-struct aggregate (partial aggregation first, so a ride id
  repeated a million times collapses map-side), then joins on the unique key:
  both sides arrive hash-partitioned on ``ride_id`` and the join reuses it.
* ``assign_zone`` uses the fixed zone table as a literal array: a projection,
  no join, no shuffle.  ``assign_zone_join`` takes a zone DataFrame instead:
  an exact equi-join on grid cells of several levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.functions.expressions import cancel_flag, zone_of_point
from rideflux.operators.gold import EXACT_SUM
from rideflux.session import run_dir

#: Coarsest grid level: cells of 2 ** MAX_LEVEL base cells.
MAX_LEVEL = 40
#: The grid reaches so far from zero on both axes.
GRID = 1e6
#: Boxes of one grid cell that are tested from one array.
CELL_BOXES = 256


def zone_performance(demand: DataFrame, revenue: DataFrame, cancels: DataFrame) -> DataFrame:
    """One row per zone: requests, request-weighted fare and surge, revenue,
    cancellation rate, and the dashboard's flags.

    Same rows as a full outer join of three per-zone aggregates, planned as
    the three gold inputs unioned (each padded with nulls for the others'
    columns) and one ``groupBy(zone_id)``: one shuffle instead of three
    aggregates and two joins.  A window without an average has no weight in
    it; sums are exact (``gold.EXACT_SUM``).
    """
    columns = {"_req": "BIGINT", "_fare_w": "DOUBLE", "_fare_n": "BIGINT", "_surge_w": "DOUBLE", "_surge_n": "BIGINT",
               "_rev": "DOUBLE", "_total": "BIGINT", "_cancelled": "BIGINT"}

    def padded(df: DataFrame, **given: str) -> DataFrame:
        return df.selectExpr("zone_id", *[f"CAST({given.get(c, 'NULL')} AS {t}) AS {c}" for c, t in columns.items()])

    d = padded(
        demand, _req="total_requests", _fare_w="avg_estimated_fare * total_requests", _surge_w="avg_surge * total_requests",
        _fare_n="IF(avg_estimated_fare IS NULL, NULL, total_requests)", _surge_n="IF(avg_surge IS NULL, NULL, total_requests)")
    r = padded(revenue, _rev="total_revenue")
    c = padded(cancels, _total="total", _cancelled="cancelled")
    per_zone = d.unionByName(r).unionByName(c).groupBy("zone_id").agg(
        F.expr("sum(_req) AS requests"),
        *[F.expr(f"{EXACT_SUM.format(x=x)} AS {name}")
          for x, name in (("_fare_w", "_fare_w"), ("_surge_w", "_surge_w"), ("_rev", "revenue"))],
        *[F.expr(f"sum({x}) AS {x}") for x in ("_fare_n", "_surge_n", "_cancelled", "_total")],
    )
    return per_zone.selectExpr(
        "zone_id", "requests",
        "round(try_divide(_fare_w, _fare_n), 2) AS avg_fare",
        "round(try_divide(_surge_w, _surge_n), 3) AS avg_surge",
        "revenue",
        "round(try_divide(_cancelled, _total), 4) AS cancel_rate",
    ).withColumn("cancel_flag", cancel_flag("cancel_rate")).withColumn(
        "high_surge", F.col("avg_surge") >= F.lit(S.SURGE_FLAG_THRESHOLD))


def _first_per_ride(df: DataFrame, cols: list[str], latest: bool) -> DataFrame:
    """One row per ride_id: earliest (or latest) by (event_ts, event_id)."""
    pick = "max" if latest else "min"
    packed = ", ".join(["event_ts", "event_id", *cols])
    return df.where("ride_id IS NOT NULL").groupBy("ride_id").agg(F.expr(f"{pick}(struct({packed})) AS _r")).selectExpr(
        "ride_id", *[f"_r.{c} AS {c}" for c in ("event_ts", *cols)])


def ride_lifecycle(requests: DataFrame, completed: DataFrame) -> DataFrame:
    """Each requested ride with its outcome (left join on the unique ride id).

    Duplicate deliveries are removed first: the earliest request and the
    latest completion of a ride are kept.  Requests without a ride id are
    rides of their own, with no outcome.
    """
    cols = ["pickup_zone_id", "ride_type", "status", "estimated_fare"]
    r = _first_per_ride(requests, cols, latest=False)
    c = _first_per_ride(completed, ["status", "actual_fare"], latest=True).selectExpr(
        "ride_id", "event_ts AS finished_at", "status AS _c_status", "actual_fare")
    alone = requests.where("ride_id IS NULL").select("ride_id", "event_ts", *cols)
    return r.join(c, "ride_id", "left").unionByName(alone, allowMissingColumns=True).selectExpr(
        "ride_id", "pickup_zone_id", "ride_type", "event_ts AS requested_at", "finished_at",
        "coalesce(_c_status, status) AS status", "estimated_fare", "actual_fare",
        "round(actual_fare - estimated_fare, 2) AS fare_delta",
    )


def assign_zone(points: DataFrame, lat: str = "latitude", lng: str = "longitude",
                out: str = "assigned_zone_id") -> DataFrame:
    """Zone of each point: smallest zone id whose box holds it, else null."""
    return points.withColumn(out, zone_of_point(lat, lng))


def _smallest_zone(boxes: str, lat: str, lng: str):
    """Smallest zone id among the boxes of an array column that hold the point."""
    inside = F.filter(boxes, lambda z: F.col(lat).between(z["lat_lo"], z["lat_hi"])
                      & F.col(lng).between(z["lng_lo"], z["lng_hi"]))
    return F.array_min(F.transform(inside, lambda z: z["zone_id"]))


def _crowded_cells(counts: DataFrame) -> DataFrame:
    """``_lat, _lng, _chunks`` of crowded cells, stored: as a table of its own
    it leaves Spark free to split a hot cell of what it is joined to."""
    path = run_dir(counts.sparkSession, "crowded-cells")
    counts.select("_lat", "_lng", F.ceil(F.col("_n") / CELL_BOXES).cast("int").alias("_chunks")).write.parquet(path)
    return counts.sparkSession.read.schema("_lat long, _lng long, _chunks int").parquet(path)


def _zones_of_coordinates(places: DataFrame, boxes: DataFrame, crowded: DataFrame) -> DataFrame:
    """``_y, _x``, smallest zone: the distinct coordinates in crowded cells that some box holds."""
    chunk = F.pmod(F.xxhash64("zone_id", "lat_lo", "lat_hi", "lng_lo", "lng_hi"), F.col("_chunks")).cast("int")
    chunks = boxes.withColumn("_chunk", chunk).groupBy("_lat", "_lng", "_chunk").agg(
        F.collect_list(F.struct("zone_id", "lat_lo", "lat_hi", "lng_lo", "lng_hi")).alias("_boxes"))
    asked = places.distinct().join(crowded, ["_lat", "_lng"]).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return (asked.join(chunks, ["_lat", "_lng", "_chunk"]).withColumn("_zone", _smallest_zone("_boxes", "_y", "_x"))
            .where("_zone IS NOT NULL").groupBy("_y", "_x").agg(F.min("_zone").alias("_zone")))


def assign_zone_join(points: DataFrame, zones: DataFrame, lat: str = "latitude", lng: str = "longitude",
                     out: str = "assigned_zone_id", cell_deg: float = 0.01) -> DataFrame:
    """Same result with a caller's zone table (zone_id, lat_lo, lat_hi, lng_lo, lng_hi).

    Boxes are listed by grid cell.  A box goes to the grid level whose cells
    are at least as long as its longer side (each level doubles the cell), so
    it lies in at most four cells, however large it is.  Per level (at most
    ``MAX_LEVEL`` + 1, usually a few) the points are joined to their one cell:
    an equi-join on a unique key, so every point comes back exactly once, a
    small zone table is broadcast by Spark and a hot cell is split by AQE.
    A cell with more than ``CELL_BOXES`` boxes is dealt into chunks of about
    that many: its distinct coordinates meet each chunk in a row of their own,
    and the smallest zone per coordinate is joined back to the points.
    Equal boxes count once, with their smallest zone.  Sides and points beyond
    the grid (``GRID``, also infinite ones) belong to its outermost cells; the
    containment test is on the true values.  Points without coordinates, and
    boxes without all four sides, match nothing.
    """
    def held(c: str):
        v = F.col(c).cast("double")
        return F.when(v.isNotNull() & ~F.isnan(v), F.greatest(F.lit(-GRID), F.least(F.lit(GRID), v)))

    size = F.greatest(held("lat_hi") - held("lat_lo"), held("lng_hi") - held("lng_lo"))
    level = F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.ceil(F.log2(F.greatest(size, F.lit(cell_deg)) / cell_deg))))
    sides = ["lat_lo", "lat_hi", "lng_lo", "lng_hi"]
    boxes = zones.select("zone_id", *[F.col(c).cast("double").alias(c) for c in sides])
    boxes = (boxes.where("zone_id IS NOT NULL AND lat_lo <= lat_hi AND lng_lo <= lng_hi")
             .groupBy(*sides).agg(F.min("zone_id").alias("zone_id")).withColumn("_level", level.cast("int")))

    def cell(c: str, n):
        return F.floor(held(c) / (cell_deg * F.pow(F.lit(2.0), n)))

    for axis in ("lat", "lng"):
        lo, hi = (cell(f"{axis}_{end}", F.col("_level")) for end in ("lo", "hi"))
        boxes = boxes.withColumn(f"_{axis}", F.explode(F.sequence(lo, hi)))
    grid = ["_level", "_lat", "_lng"]
    counts = boxes.groupBy(*grid).agg(F.count("*").alias("_n"))
    result, found = points, []
    for n, most in sorted(counts.groupBy("_level").agg(F.max("_n")).collect()):
        keys = [f"_rf_lat{n}", f"_rf_lng{n}"]
        result = result.withColumns({keys[0]: cell(lat, F.lit(n)), keys[1]: cell(lng, F.lit(n))})
        few = boxes.where(F.col("_level") == n)
        if most > CELL_BOXES:
            crowded = _crowded_cells(counts.where((F.col("_level") == n) & (F.col("_n") > CELL_BOXES)))
            zone_at = _zones_of_coordinates(result.select(*[F.col(k).alias(c) for k, c in zip(keys, grid[1:])],
                                                          F.col(lat).alias("_y"), F.col(lng).alias("_x")),
                                            few.join(crowded, grid[1:]), crowded)
            few = few.join(crowded, grid[1:], "left_anti")
            at = zone_at.toDF(f"_rf_y{n}", f"_rf_x{n}", f"_rf_zone{n}")
            result = result.join(at, (F.col(lat) == F.col(f"_rf_y{n}")) & (F.col(lng) == F.col(f"_rf_x{n}")), "left")
            found.append(F.col(f"_rf_zone{n}"))
        cells = few.groupBy(F.col("_lat").alias(keys[0]), F.col("_lng").alias(keys[1])).agg(
            F.collect_list(F.struct("zone_id", *sides)).alias(f"_rf_boxes{n}"))
        result = result.join(cells, keys, "left")
        found.append(_smallest_zone(f"_rf_boxes{n}", lat, lng))
    best = F.least(*found) if len(found) > 1 else (found or [F.lit(None).cast("string")])[0]
    return result.select(*points.columns, best.alias(out))
