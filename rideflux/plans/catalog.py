"""Registry of named queries: ``name → (spark_fn(spark, sf_dir), oracle_sql | None)``.

Each Spark query reads the driver's test tables (through the adapter) and
returns a DataFrame with ``timestamp_ntz`` times and aliased columns, so it
compares one-to-one with its DuckDB SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rideflux.session import ensure_utc

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Event times are UTC wall clock; decoded instants are shown as
            # timestamp_ntz through the session zone, so pin it to UTC.
            ensure_utc(spark)
            return fn(spark, sf_dir.rstrip("/"))

        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return deco


def _load() -> None:
    # Importing the modules registers their queries.
    from rideflux.plans import queries_gold, queries_bi, queries_dashboard, queries_ops, queries_streaming, queries_analytics  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
