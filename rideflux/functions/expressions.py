"""Column expressions shared by the operators.

Everything here is a built-in Spark expression (no Python UDF), so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rideflux import schemas as S

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- time ------------------------------------------------------------------

# a zone designator after a time of day: ...HH:MM[:SS[.fff]] then Z or +hh[:mm]
_HAS_ZONE = r"\d\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|[+-]\d\d(:?\d\d)?)$"
_DATE_ONLY = r"^\s*\d{4}-\d\d-\d\d\s*$"
_NO_SECONDS = r"[T ]\d\d:\d\d$"


def parse_event_time(s: ColumnOrName) -> Column:
    """ISO-8601 text → timestamp, null on bad input instead of an ANSI error.

    Producers send naive UTC strings; a missing zone is read as UTC so the
    instant does not depend on the session time zone.  (Spark accepts a zone
    only after the seconds, so date-only and minute-precision text are
    completed first.)  Every other form that Spark parses (shorter dates,
    hours only, zone names) is read as Spark reads it, in the session zone,
    which the library pins to UTC.
    """
    s = _c(s)
    with_zone = (
        F.when(s.rlike(_HAS_ZONE), s)
        .when(s.rlike(_DATE_ONLY), F.concat(F.trim(s), F.lit("T00:00:00Z")))
        .when(s.rlike(_NO_SECONDS), F.concat(s, F.lit(":00Z")))
        .otherwise(F.concat(s, F.lit("Z")))
    )
    return F.coalesce(F.try_to_timestamp(with_zone), F.try_to_timestamp(s))


def as_date(d: dt.date | str | Column) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def on_day(ts: ColumnOrName, day) -> Column:
    """Calendar-day filter: ``to_date(ts) = day``."""
    return F.to_date(_c(ts)) == as_date(day)


def in_trailing_days(ts: ColumnOrName, day, days: int, offset: int = 0) -> Column:
    """Whole calendar days in (day - offset - days, day - offset]."""
    end = F.date_sub(as_date(day), offset)
    d = F.to_date(_c(ts))
    return (d > F.date_sub(end, days)) & (d <= end)


def day_end(day) -> Column:
    """Midnight after ``day`` as a timestamp_ntz (exclusive end of the day)."""
    return F.date_add(as_date(day), 1).cast("timestamp_ntz")


# --- arithmetic --------------------------------------------------------------

def ratio_or_zero(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``DIVIDE(a, b, 0)``: a / b, 0 when b is 0 or null."""
    return F.coalesce(F.try_divide(_c(num), _c(den)), F.lit(0.0))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    return ratio_or_zero(num, den) * F.lit(100.0)


def money_sum(x: ColumnOrName) -> Column:
    """Exact sum (see ``gold.EXACT_SUM``): decimal arithmetic, double out.

    A double sum depends on row order, so two engines (or two partitionings)
    could round a tie differently; a decimal sum cannot.  Values that no
    decimal holds make it the plain double sum.
    """
    v = _c(x).cast("double")
    d = v.try_cast("decimal(28,10)")
    return F.coalesce(F.when(F.count(d) == F.count(v), F.try_sum(d).cast("double")), F.sum(v))


def exact_avg(x: ColumnOrName) -> Column:
    """Average from the exact decimal sum (see ``gold.EXACT_AVG``).

    One division of two exactly known numbers: the result does not depend
    on the order rows were summed in.
    """
    v = _c(x).cast("double")
    d = v.try_cast("decimal(28,10)")
    return F.coalesce(
        F.when(F.count(d) == F.count(v), F.try_divide(F.try_sum(d).cast("double"), F.count(v))), F.avg(v))


# --- labels ------------------------------------------------------------------

def surge_tier(avg_surge: ColumnOrName) -> Column:
    x = _c(avg_surge)
    expr = None
    for threshold, label in S.SURGE_TIERS:
        cond = x >= F.lit(threshold)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(S.SURGE_TIER_DEFAULT)


def heatmap_band(score_pct: ColumnOrName) -> Column:
    """Band 0..6 of a 0..100 score: number of cut points at or below score/100."""
    v = _c(score_pct) / F.lit(100.0)
    expr = None
    for i, cut in enumerate(S.HEATMAP_CUTS):
        expr = F.when(v < F.lit(cut), F.lit(i)) if expr is None else expr.when(v < F.lit(cut), F.lit(i))
    return expr.otherwise(F.lit(len(S.HEATMAP_CUTS)))


def _band_above(x: Column, bands, default: str) -> Column:
    expr = None
    for threshold, label in bands:
        cond = x > F.lit(threshold)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def availability_band(pct_col: ColumnOrName) -> Column:
    return _band_above(_c(pct_col), S.AVAILABILITY_BANDS, S.AVAILABILITY_DEFAULT)


def cancel_flag(rate: ColumnOrName) -> Column:
    return _band_above(_c(rate), S.CANCEL_FLAGS, S.CANCEL_FLAG_DEFAULT)


# --- pricing rules -------------------------------------------------------------

def rule_surge(hour: ColumnOrName, zone_id: ColumnOrName) -> Column:
    """Rush-hour surge by rule (random jitter of the simulator left out)."""
    h, z = _c(hour), _c(zone_id)
    m_lo, m_hi, m_add = S.SURGE_MORNING
    e_lo, e_hi, e_add = S.SURGE_EVENING
    n_from, n_to, n_add = S.SURGE_NIGHT
    time_part = (
        F.when(h.between(m_lo, m_hi), F.lit(m_add))
        .when(h.between(e_lo, e_hi), F.lit(e_add))
        .when((h >= n_from) | (h <= n_to), F.lit(n_add))
        .otherwise(F.lit(0.0))
    )
    zone_part = F.when(z == S.SURGE_AIRPORT_ZONE, F.lit(S.SURGE_AIRPORT_PREMIUM)).otherwise(F.lit(0.0))
    return F.round(F.least(F.lit(S.SURGE_BASE) + time_part + zone_part, F.lit(S.SURGE_CAP)), 2)


def base_fare(ride_type: ColumnOrName) -> Column:
    m = F.create_map(*[x for k, v in S.BASE_FARE.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, _c(ride_type))


def expected_fare(ride_type: ColumnOrName, distance_km: ColumnOrName, surge: ColumnOrName) -> Column:
    return F.round(base_fare(ride_type) + _c(distance_km) * F.lit(S.FARE_PER_KM) * _c(surge), 2)


# --- geography ---------------------------------------------------------------

def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


ZONE_BOXES_SQL = "array(" + ", ".join(
    f"named_struct('zone_id', {_sql_str(z.zone_id)}, 'zone_name', {_sql_str(z.zone_name)}, "
    f"'lat_lo', CAST({z.lat_lo!r} AS DOUBLE), 'lat_hi', CAST({z.lat_hi!r} AS DOUBLE), "
    f"'lng_lo', CAST({z.lng_lo!r} AS DOUBLE), 'lng_hi', CAST({z.lng_hi!r} AS DOUBLE))"
    for z in S.ZONES
) + ")"


def zone_boxes() -> Column:
    """The fixed zone table as one literal array<struct> (6 entries).

    Written as one SQL expression: the JVM parses it in a single call
    instead of one call per literal.
    """
    return F.expr(ZONE_BOXES_SQL)


def sql_array(values) -> str:
    """SQL text of a literal string array."""
    return "array(" + ", ".join(_sql_str(v) for v in values) + ")"


def zone_of_point(lat: ColumnOrName, lng: ColumnOrName) -> Column:
    """Smallest zone_id whose box contains the point, else null.

    A projection over a literal array: no join, no shuffle, any data size.
    """
    la, ln = _c(lat), _c(lng)
    hits = F.filter(
        zone_boxes(),
        lambda z: la.between(z["lat_lo"], z["lat_hi"]) & ln.between(z["lng_lo"], z["lng_hi"]),
    )
    return F.array_min(F.transform(hits, lambda z: z["zone_id"]))
