"""Launch the streaming application: 5 gold queries + 3 raw sinks.

Layout under ``base``::

    gold/<table>/batch_id=N/<partition cols>/...
    raw/<stream>/batch_id=N/...
    _rejects/<table>/batch_id=N/...
    _audit/table_name=<t>/day=<d>/...
    _checkpoints/<query>/...

Each query has its own source, watermark and checkpoint.  State lives in the
state store configured on the session (RocksDB in ``build_session``); the
number of shuffle partitions is fixed into the checkpoint at first start, so
set ``spark.sql.shuffle.partitions`` for the target scale before the first run.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from rideflux import schemas as S
from rideflux.operators.gold import GOLD
from rideflux.sources.json_events import PARSERS
from rideflux.sources.readers import read_topic_stream
from rideflux.streaming.sinks import read_audit, read_sink, write_stream

AGG_TRIGGER_SECS = 30
RAW_TRIGGER_SECS = 60


def gold_path(base: str, table: str) -> str:
    return f"{base}/gold/{table}"


def raw_path(base: str, stream: str) -> str:
    return f"{base}/raw/{stream}"


def rejects_path(base: str, table: str) -> str:
    """Windows that break the declared schema (a null zone), with the reason."""
    return f"{base}/_rejects/{table}"


def audit_path(base: str) -> str:
    return f"{base}/_audit"


def checkpoint_path(base: str, name: str) -> str:
    return f"{base}/_checkpoints/{name}"


def start_gold_query(silver: DataFrame, table: str, base: str, *, available_now: bool = False,
                     trigger_secs: int = AGG_TRIGGER_SECS) -> StreamingQuery:
    fn, _ = GOLD[table]
    return write_stream(
        fn(silver), gold_path(base, table), checkpoint_path(base, table),
        table_name=table, partition_cols=S.GOLD_SPECS[table].partition_cols,
        audit_path=audit_path(base), trigger_secs=trigger_secs, available_now=available_now,
        query_name=None, one_file_per_value=True, schema=S.GOLD_SCHEMAS[table], rejects_path=rejects_path(base, table),
    )


def start_raw_query(silver: DataFrame, stream: str, base: str, *, available_now: bool = False,
                    trigger_secs: int = RAW_TRIGGER_SECS) -> StreamingQuery:
    """Raw (audit / replay) sink: every decoded row, malformed ones included."""
    return write_stream(
        silver, raw_path(base, stream), checkpoint_path(base, f"raw_{stream}"),
        table_name=f"raw_{stream}", audit_path=audit_path(base),
        trigger_secs=trigger_secs, available_now=available_now,
    )


def open_streams(spark: SparkSession, topic_paths: dict[str, str] | None = None,
                 bootstrap_servers: str | None = None, max_per_trigger: int | None = 1000) -> dict[str, DataFrame]:
    """Decoded streaming DataFrame per stream (Kafka topics or file topics)."""
    out = {}
    for stream, parse in PARSERS.items():
        raw = read_topic_stream(
            spark, stream, path=(topic_paths or {}).get(stream),
            bootstrap_servers=bootstrap_servers, max_per_trigger=max_per_trigger,
        )
        out[stream] = parse(raw)
    return out


def start_all(spark: SparkSession, base: str, *, topic_paths: dict[str, str] | None = None,
              bootstrap_servers: str | None = None, max_per_trigger: int | None = 1000,
              available_now: bool = False, tables=None, raw: bool = True,
              state_partitions: int | None = None) -> list[StreamingQuery]:
    """Start every gold query and the raw sinks; returns the running queries.

    ``state_partitions`` sets ``spark.sql.shuffle.partitions`` on the session
    before the queries start (each records it in its checkpoint at first
    start; later runs keep the recorded value).
    """
    if state_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    streams = open_streams(spark, topic_paths, bootstrap_servers, max_per_trigger)
    queries = [
        start_gold_query(streams[GOLD[t][1]], t, base, available_now=available_now)
        for t in (tables or GOLD)
    ]
    if raw:
        queries += [start_raw_query(df, s, base, available_now=available_now) for s, df in streams.items()]
    return queries


def silver_path(base: str, stream: str) -> str:
    return f"{base}/silver/{stream}"


def start_fan_out(spark: SparkSession, base: str, *, topic_paths: dict[str, str] | None = None,
                  bootstrap_servers: str | None = None, max_per_trigger: int | None = 1000,
                  available_now: bool = False, tables=None, state_partitions: int | None = None,
                  trigger_secs: int = AGG_TRIGGER_SECS, start_timeout_secs: int = 600, max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Read each topic once and fan out from a silver table.

    One query per topic decodes the records and appends them with Spark's
    file sink, which commits each micro-batch exactly once through its
    ``_spark_metadata`` log; the gold queries stream from that table, and the
    file source reads only files committed there.  The broker serves each
    topic once instead of once per query, at the cost of one extra trigger of
    latency.  ``max_per_trigger`` limits the topics' records, and
    ``max_files_per_trigger`` the silver files that a gold query reads at once.
    With ``available_now`` the silver queries drain first, then
    the gold queries run.
    """
    if state_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    streams = open_streams(spark, topic_paths, bootstrap_servers, max_per_trigger)
    needed = sorted({GOLD[t][1] for t in (tables or GOLD)})
    silver_qs = []
    for stream in needed:
        w = (
            streams[stream].writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_path(base, f"silver_{stream}"))
            .option("path", silver_path(base, stream))
        )
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_secs} seconds")
        silver_qs.append(w.start())
    if available_now:
        run_available_now(silver_qs)
    else:
        # the gold sources need the silver folders to exist: wait for a first commit
        deadline = time.time() + start_timeout_secs
        while any(q.lastProgress is None for q in silver_qs):
            if time.time() > deadline:
                raise TimeoutError(f"no silver commit within {start_timeout_secs} s")
            time.sleep(1)
    gold_qs = []
    for t in tables or GOLD:
        stream = GOLD[t][1]
        src = spark.readStream.schema(streams[stream].schema)
        if max_files_per_trigger:
            src = src.option("maxFilesPerTrigger", max_files_per_trigger)
        gold_qs.append(start_gold_query(src.parquet(silver_path(base, stream)), t, base,
                                        available_now=available_now, trigger_secs=trigger_secs))
    return silver_qs + gold_qs


def await_any(spark: SparkSession, queries: list[StreamingQuery], poll_secs: int = 5) -> None:
    """Block until any of ``queries`` ends; stop the rest and re-raise its error.

    Polls the session's termination signal and re-checks the given queries,
    so terminations of unrelated queries, or ones recorded before the call,
    neither end the wait early nor make it hang.
    """
    try:
        while all(q.isActive for q in queries):
            spark.streams.awaitAnyTermination(poll_secs)
            spark.streams.resetTerminated()
    finally:
        failed = [q.exception() for q in queries if q.exception() is not None]
        for q in queries:
            if q.isActive:
                q.stop()
    if failed:
        raise failed[0]


def run_available_now(queries: list[StreamingQuery]) -> None:
    """Wait for availableNow queries to drain; raise the first failure."""
    for q in queries:
        q.awaitTermination()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def committed_batch(spark: SparkSession, base: str, table: str) -> int | None:
    """Largest batch of ``table`` with an audit row, None before the first."""
    try:
        top = read_audit(spark, audit_path(base)).where(F.col("table_name") == table).agg(F.max("batch_id")).first()[0]
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return None if top is None else int(top)


def watermark_report(query: StreamingQuery) -> list[dict]:
    """Per recent micro-batch: input rows, the event-time watermark, and rows
    the stateful operator dropped as late.

    The dropped count is taken after partial aggregation (two late events of
    one group count once): a health signal, not an exact event count.
    """
    out = []
    for p in query.recentProgress:
        ops = p.get("stateOperators") or []
        out.append({
            "batch_id": p["batchId"],
            "input_rows": p.get("numInputRows", 0),
            "watermark": (p.get("eventTime") or {}).get("watermark"),
            "dropped_late": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops),
            "state_rows": sum(o.get("numRowsTotal", 0) for o in ops),
        })
    return out


def read_gold(spark: SparkSession, base: str, table: str) -> DataFrame:
    return read_sink(spark, gold_path(base, table), S.GOLD_SCHEMAS[table])


def read_raw(spark: SparkSession, base: str, stream: str) -> DataFrame:
    return read_sink(spark, raw_path(base, stream))
