"""Registered queries: streaming forms, raw sinks, replay and table history.

Each stream key serialises the adapter's silver rows to the producer's JSON
in a file topic under the shared folder, runs the real streaming query with
an ``availableNow`` trigger into the foreachBatch sink, and returns the sink
table read back.  Append mode emits a window once the watermark (max event
time seen - delay) has passed its end, so the oracle keeps exactly the
windows with ``end <= max(event_ts) - delay``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators import gold as G
from rideflux.plans import measures as M
from rideflux.plans import oracle as O
from rideflux.plans.catalog import register
from rideflux.operators.layout import accepted, compact, conform, read_table, rejected
from rideflux.operators.layout import zorder_cluster as cluster
from rideflux.plans.queries_bi import HEATMAP_SQL
from rideflux.plans.queries_gold import flat_view, gold, silver
from rideflux.session import ensure_utc, run_dir, shuffle_partitions
from rideflux.sources import adapter
from rideflux.sources.json_events import PARSERS
from rideflux.sources.readers import read_topic_stream, write_topic_files
from rideflux.streaming import jobs
from rideflux.streaming.history import table_history


#: Time slices of a file topic; a trigger reads one, so every query runs in
#: several micro-batches and its state holds the open windows only.
SLICES = 5


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock ``timestamp_ntz`` for comparison."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def file_topic(spark: SparkSession, sf_dir: str, stream: str, base: str, rows: DataFrame | None = None,
               arrival: str = "event_ts") -> str:
    """The stream as JSON files, written one slice of time after the other,
    ``files_per_slice`` files each.

    ``rows`` are the stream's silver rows unless given; ``arrival`` is the SQL
    timestamp that places a record in a slice.  Each slice reads the rows anew
    and makes its own records only, so every record is made and written once;
    what is dealt to the files are the events, not the records made of them.
    """
    path, n = f"{base}/topics/{stream}", files_per_slice(spark)
    place = F.expr(f"unix_micros(CAST({arrival} AS TIMESTAMP))")
    if rows is None:
        events = adapter.read_events(spark, sf_dir)
        rows, dealt = adapter.STREAMS[stream](events), adapter.STREAMS[stream](events.repartition(n))
    else:
        dealt = rows.repartition(n)
    lo, hi = rows.select(place.alias("_us")).agg(F.min("_us"), F.max("_us")).first()
    at = F.expr(f"least({SLICES - 1}, (_us - {lo or 0}L) * {SLICES} div greatest({(hi or 0) - (lo or 0)}L, 1L))")
    dealt = dealt.withColumn("_us", place)
    for i in range(SLICES):  # the filter moves in front of the exchange
        write_topic_files(adapter.to_bronze(dealt.where(F.coalesce(at, F.lit(0)) == i), stream), path)
    return path


def files_per_slice(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def run_gold_stream(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Run one gold query over a file topic to completion; returns its base folder.

    State partitions: the cluster's default parallelism (set while the query
    starts and runs; the session's own setting is restored afterwards).
    """
    ensure_utc(spark)
    base = run_dir(spark, f"stream-{table}")
    stream = G.GOLD[table][1]
    topic = file_topic(spark, sf_dir, stream, base)
    parsed = PARSERS[stream](read_topic_stream(spark, stream, path=topic, max_per_trigger=files_per_slice(spark)))
    with shuffle_partitions(spark, spark.sparkContext.defaultParallelism):
        jobs.run_available_now([jobs.start_gold_query(parsed, table, base, available_now=True)])
    return base


def run_raw_stream(spark: SparkSession, sf_dir: str, stream: str) -> str:
    ensure_utc(spark)
    base = run_dir(spark, f"raw-{stream}")
    topic = file_topic(spark, sf_dir, stream, base)
    parsed = PARSERS[stream](read_topic_stream(spark, stream, path=topic, max_per_trigger=None))
    jobs.run_available_now([jobs.start_raw_query(parsed, stream, base, available_now=True)])
    return base


def _stream_query(table: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(jobs.read_gold(spark, run_gold_stream(spark, sf_dir, table), table))

    q.__name__ = f"stream_{table}"
    return q


for _t in G.GOLD:
    register(f"stream_{_t}", O.stream_gold_select(_t))(_stream_query(_t))


def _raw_query(stream: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = jobs.read_raw(spark, run_raw_stream(spark, sf_dir, stream), stream)
        return flat_view(raw.select(*S.STREAM_SCHEMAS[stream].fieldNames(), *_extra(stream)), stream)

    q.__name__ = f"raw_{stream}"
    return q


def _extra(stream: str) -> list[str]:
    if stream == "ride_requests":
        return ["event_ts", "pickup_zone_id", "pickup_zone_name", "dropoff_zone_id"]
    return ["event_ts"]


_SILVER_CTE = {"ride_requests": "req", "ride_completed": "cmp", "driver_locations": "png"}
for _s, _cte in _SILVER_CTE.items():
    register(f"raw_{_s}", O.with_ctes(_cte) + f"SELECT * FROM {_cte}")(_raw_query(_s))


@register("replay_demand", O.gold_select("ride_demand_by_zone"))
def replay_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill: the demand aggregate recomputed in batch from the raw sink."""
    base = run_raw_stream(spark, sf_dir, "ride_requests")
    return ntz(G.ride_demand_by_zone(jobs.read_raw(spark, base, "ride_requests")))


# Batch k + 1 starts with the watermark that slices 0..k have set and emits the
# windows that end by then.
_HISTORY_SQL = O.with_ctes("demand", extra=[
    "span AS (SELECT min(epoch_us(event_ts)) AS lo, max(epoch_us(event_ts)) AS hi FROM req)",
    f"""marks AS (SELECT i + 1 AS batch_id, max(max(event_ts)) OVER (ORDER BY i) - INTERVAL '2 minutes' AS mark
        FROM (SELECT least({SLICES - 1}, ((epoch_us(event_ts) - lo) * {SLICES}) // greatest(hi - lo, 1)) AS i, event_ts
              FROM req, span) GROUP BY i)""",
    "emitted AS (SELECT d.*, (SELECT min(m.batch_id) FROM marks m WHERE d.window_end <= m.mark) AS batch_id FROM demand d)"]) + """
SELECT 'ride_demand_by_zone' AS table_name, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS num_rows,
       min(window_start) AS min_window_start, max(window_start) AS max_window_start
FROM emitted WHERE batch_id IS NOT NULL GROUP BY batch_id
QUALIFY row_number() OVER (ORDER BY batch_id DESC) <= 3"""


@register("table_history", _HISTORY_SQL)
def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest of the demand stream's commits."""
    base = run_gold_stream(spark, sf_dir, "ride_demand_by_zone")
    h = table_history(spark, base, "ride_demand_by_zone", limit=3)
    return ntz(h.drop("written_at"))


# --- table layout jobs ---------------------------------------------------------

def _conform_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with the zone missing in the windows that start on the hour."""
    demand = gold(spark, sf_dir, "ride_demand_by_zone").withColumn(
        "zone_id", F.expr("IF(minute(window_start) <> 0, zone_id, NULL)"))
    return conform(demand, S.GOLD_SCHEMAS["ride_demand_by_zone"])


_NO_ZONE = ["ddemand AS (SELECT * REPLACE (CASE WHEN minute(window_start) <> 0 THEN zone_id END AS zone_id) FROM demand)"]


@register("conform_gold_accepted", O.with_ctes("demand", extra=_NO_ZONE) + (
    "SELECT * FROM ddemand WHERE window_start IS NOT NULL AND zone_id IS NOT NULL"))
def conform_gold_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(accepted(_conform_demand(spark, sf_dir)))


@register("conform_gold_rejected", O.with_ctes("demand", extra=_NO_ZONE) + """
SELECT *, concat_ws(', ', CASE WHEN window_start IS NULL THEN 'null window_start' END,
                          CASE WHEN zone_id IS NULL THEN 'null zone_id' END) AS reject_reason
FROM ddemand WHERE window_start IS NULL OR zone_id IS NULL""")
def conform_gold_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ntz(rejected(_conform_demand(spark, sf_dir)))


@register("zorder_cluster", O.gold_select("surge_pricing_metrics"))
def zorder_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surge table rewritten on a Z-curve over (window_start, avg_surge),
    partitioned by ride_type; the rows must come back unchanged."""
    table = "surge_pricing_metrics"
    spec = S.GOLD_SPECS[table]
    path = f"{run_dir(spark, 'zorder')}/{table}"
    cluster(gold(spark, sf_dir, table), list(spec.cluster_cols), path, partition_cols=spec.partition_cols,
            materialize=True)
    return ntz(read_table(spark, path, table))


@register("compact_gold", O.stream_gold_select("ride_demand_by_zone"))
def compact_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand stream's per-batch files compacted into a new directory."""
    table = "ride_demand_by_zone"
    spec = S.GOLD_SPECS[table]
    base = run_gold_stream(spark, sf_dir, table)
    path = f"{base}/compacted/{table}"
    compact(jobs.read_gold(spark, base, table), path, partition_cols=spec.partition_cols,
            sort_cols=spec.cluster_cols)
    return ntz(read_table(spark, path, table))


# --- measures over a stored gold table -------------------------------------------

def stored_gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The gold table written once, partitioned as declared, and read back."""
    spec = S.GOLD_SPECS[table]
    path = f"{run_dir(spark, 'gold')}/{table}"
    compact(gold(spark, sf_dir, table), path, partition_cols=spec.partition_cols, sort_cols=spec.cluster_cols)
    return ntz(read_table(spark, path, table))


@register("stored_total_revenue_today", O.with_ctes("revenue") + (
    f"SELECT coalesce({O.MONEY('total_revenue')}, 0.0e0) AS total_revenue_today FROM revenue "
    f"WHERE CAST(window_start AS DATE) = DATE '{O.AS_OF}'"))
def stored_total_revenue_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.total_revenue_today(stored_gold(spark, sf_dir, "revenue_analytics"), O.AS_OF)


@register("stored_demand_heatmap", O.with_ctes("demand") + HEATMAP_SQL)
def stored_demand_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.demand_heatmap_score(stored_gold(spark, sf_dir, "ride_demand_by_zone"))
