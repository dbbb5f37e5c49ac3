"""Command line: run the streaming application and the table jobs.

    python -m rideflux stream   --base DIR (--bootstrap HOST:PORT | --topics DIR) [--available-now] [--fan-out]
    python -m rideflux setup    --base DIR            create the empty gold tables
    python -m rideflux optimize --base DIR [--table T] Z-order gold tables into DIR/optimized/
    python -m rideflux compact  --base DIR [--table T] incremental compaction of the sink
    python -m rideflux history  --base DIR [--limit N] newest commits per table

``--topics DIR`` expects one sub-directory of JSON-lines files per stream
(``ride_requests``, ``ride_completed``, ``driver_locations``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators import layout
from rideflux.session import build_session
from rideflux.sources.json_events import PARSERS
from rideflux.streaming import history, jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m rideflux")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("stream", "setup", "optimize", "compact", "history"):
        s = sub.add_parser(name)
        s.add_argument("--base", required=True, help="root folder of sinks, tables and checkpoints")
        if name == "stream":
            src = s.add_mutually_exclusive_group(required=True)
            src.add_argument("--bootstrap", help="Kafka bootstrap servers")
            src.add_argument("--topics", help="folder with one JSON-lines directory per stream")
            s.add_argument("--max-per-trigger", type=int, default=1000)
            s.add_argument("--state-partitions", type=int, default=None)
            s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
            s.add_argument("--fan-out", action="store_true",
                           help="read each topic once into a silver table; gold queries stream from it")
        if name in ("optimize", "compact"):
            s.add_argument("--table", choices=sorted(S.GOLD_SPECS), action="append")
        if name == "history":
            s.add_argument("--limit", type=int, default=5)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app_name=f"rideflux-{args.cmd}")
    base = args.base.rstrip("/")
    tables = getattr(args, "table", None) or sorted(S.GOLD_SPECS)

    if args.cmd == "stream":
        topics = {s: f"{args.topics.rstrip('/')}/{s}" for s in PARSERS} if args.topics else None
        start = jobs.start_fan_out if args.fan_out else jobs.start_all
        qs = start(
            spark, base, topic_paths=topics, bootstrap_servers=args.bootstrap,
            max_per_trigger=args.max_per_trigger, available_now=args.available_now,
            state_partitions=args.state_partitions,
        )
        if args.available_now:
            jobs.run_available_now(qs)
        else:
            jobs.await_any(spark, qs)
    elif args.cmd == "setup":
        for t in tables:
            created = layout.create_table(spark, t, jobs.gold_path(base, t))
            print(f"{t}: {'created' if created else 'exists'}")
    elif args.cmd == "optimize":
        for t in tables:
            spec = S.GOLD_SPECS[t]
            src = jobs.read_gold(spark, base, t)
            layout.zorder_cluster(src, list(spec.cluster_cols), f"{base}/optimized/{t}",
                                  partition_cols=spec.partition_cols)
            print(f"{t}: optimized")
    elif args.cmd == "compact":
        for t in tables:
            mark = f"{base}/compacted/_high_water/{t}"
            top = layout.compact_new_batches(spark, jobs.gold_path(base, t), f"{base}/compacted/{t}", t,
                                             jobs.committed_batch(spark, base, t), _read_mark(spark, mark))
            if top is not None:  # marks are appended and the largest counts: none is ever replaced
                spark.createDataFrame([(top,)], "batch_id long").write.mode("append").parquet(mark)
            print(f"{t}: {'up to batch ' + str(top) if top is not None else 'nothing new'}")
    elif args.cmd == "history":
        rows = history.table_history(spark, base, limit=args.limit).orderBy("table_name", "batch_id")
        for r in rows.toLocalIterator():
            print("\t".join(str(v) for v in r))
    return 0


def _read_mark(spark: SparkSession, path: str) -> int:
    """High-water batch id of the compaction runs so far (-1 before the first)."""
    if not layout.table_exists(spark, path):
        return -1
    top = spark.read.schema("batch_id long").parquet(path).agg(F.max("batch_id")).first()[0]
    return -1 if top is None else int(top)


if __name__ == "__main__":
    sys.exit(main())
