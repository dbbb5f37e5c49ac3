"""Table layout jobs: create, conform, Z-order, compact."""

from __future__ import annotations

import datetime as dt
import glob

from pyspark.sql import functions as F

from rideflux import schemas as S
from rideflux.operators import layout as L
from rideflux.plans.queries_gold import gold
from tests.conftest import SF_SMALL


def test_create_table_once_and_read_with_declared_schema(spark, tmp_dir):
    path = f"{tmp_dir}/demand"
    assert L.create_table(spark, "ride_demand_by_zone", path) is True
    assert L.create_table(spark, "ride_demand_by_zone", path) is False
    df = L.read_table(spark, path, "ride_demand_by_zone")
    assert df.columns == S.GOLD_COLUMNS["ride_demand_by_zone"] and df.count() == 0


def test_conform_splits_rows_and_reports_reasons(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), "Z001", "3"), (dt.datetime(2024, 1, 1), None, "4"), (None, "Z002", "x")],
        "window_start timestamp, zone_id string, total string")
    schema = S.GOLD_SCHEMAS["cancellation_analytics"]
    tagged = L.conform(df, schema)
    ok, bad = L.accepted(tagged), L.rejected(tagged)
    assert ok.columns == schema.fieldNames()
    assert dict(ok.dtypes)["total"] == "bigint"
    assert [r.zone_id for r in ok.collect()] == ["Z001"]
    reasons = sorted(r.reject_reason for r in bad.collect())
    assert reasons == ["null window_start, bad total", "null zone_id"]


def _multiset(df):
    return sorted(tuple(r) for r in df.collect())


def test_zorder_keeps_rows_and_clusters(spark, tmp_dir):
    surge = gold(spark, SF_SMALL, "surge_pricing_metrics")
    path = f"{tmp_dir}/z"
    L.zorder_cluster(surge, ["window_start", "avg_surge"], path, partition_cols=("ride_type",), n_files=4)
    back = L.read_table(spark, path, "surge_pricing_metrics").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz"))
    assert _multiset(back) == _multiset(surge)
    assert len(glob.glob(f"{path}/ride_type=*/*.parquet")) >= 5


def test_z_value_is_monotone_in_each_column_alone(spark):
    df = spark.range(0, 64).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"))
    z = L.z_value(df, ["a", "b"], bits=6).orderBy("a").select("_z").collect()
    vals = [r[0] for r in z]
    assert vals == sorted(vals) and len(set(vals)) > 32


def test_compaction_keeps_rows_in_fewer_files(spark, tmp_dir):
    demand = gold(spark, SF_SMALL, "ride_demand_by_zone").repartition(32)
    src, dst = f"{tmp_dir}/src", f"{tmp_dir}/dst"
    demand.write.partitionBy("zone_id").parquet(src)
    before = len(glob.glob(f"{src}/*/*.parquet"))
    L.compact(L.read_table(spark, src, "ride_demand_by_zone"), dst, partition_cols=("zone_id",),
              sort_cols=("window_start",))
    after = len(glob.glob(f"{dst}/*/*.parquet"))
    assert after < before
    assert _multiset(L.read_table(spark, dst, "ride_demand_by_zone")) == _multiset(
        L.read_table(spark, src, "ride_demand_by_zone"))


def test_zorder_rejects_text_columns(spark):
    import pytest
    df = spark.createDataFrame([("a", 1.0)], "s string, x double")
    with pytest.raises(TypeError):
        L.z_value(df, ["s", "x"])
