from __future__ import annotations

import datetime as dt
import decimal
import json
import math
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("rideflux-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rideflux-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rideflux-test-")


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, str(x)) for x in row)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def assert_same(df, sql: str, sf_dir: str):
    """Spark DataFrame equals the DuckDB result: columns, row count, values."""
    con = duck(sf_dir)
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    o_idx = [rel.columns.index(c) for c in cols]
    o_rows = [tuple(_norm(r[i]) for i in o_idx) for r in rel.fetchall()]
    assert len(s_rows) == len(o_rows)
    assert sorted(s_rows, key=_key) == sorted(o_rows, key=_key)


def write_json_lines(path: str, records: list, mtime: float | None = None):
    """One JSON-lines file (a record may be a raw string for malformed input)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))
