"""Helpers shared by the operators: table access and lineage cuts."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflux.session import run_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the Python workers, once per application,
    so that an executor needs no installed copy (like ``--py-files``)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(), "rideflux_src.zip")  # the driver's; Spark serves it to executors
    with open(path, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a table every executor can read again, so a lost
    executor costs a re-read and not a recomputation.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_share(column: F.Column, share: float) -> F.Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range: a
    sample of that expected size, the same in every run, without sorting."""
    return column <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)) - 1))


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads no further)."""
    return df.limit(max_rows + 1).count() <= max_rows


def with_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` is within the bound."""
    return F.broadcast(df) if small_enough(df, max_rows) else df
