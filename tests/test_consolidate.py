"""Gold consolidation (J3): union, projection and every quality rule."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tripflow.operators.consolidate import consolidate, union_all
from tripflow.plans.inspect import plan_text
from tripflow.specs import GOLD_COLUMNS, REFERENCE_QUALITY as Q


def test_union_keeps_all_rows(df_yellow_silver, df_green_silver):
    assert union_all(df_yellow_silver, df_green_silver).count() == 7


def test_union_is_strict(df_yellow_silver, df_green_silver):
    with pytest.raises(AnalysisException):
        union_all(df_yellow_silver, df_green_silver.drop("taxi_type")).count()


def test_gold_columns_and_types(df_yellow_silver, df_green_silver):
    out = consolidate([df_yellow_silver, df_green_silver], Q)
    assert out.columns == list(GOLD_COLUMNS)
    kinds = {f.name: f.dataType for f in out.schema.fields}
    assert kinds["VendorID"] == T.IntegerType() and kinds["passenger_count"] == T.IntegerType()


def test_filters(df_yellow_silver, df_green_silver):
    out = consolidate([df_yellow_silver, df_green_silver], Q)
    assert out.count() == 5
    assert out.filter("passenger_count > 6").count() == 0
    assert out.filter("total_amount <= 0").count() == 0


def test_boundaries(df_boundary_silver):
    out = consolidate([df_boundary_silver], Q).collect()
    kept = sorted((r.passenger_count, r.total_amount) for r in out)
    assert kept == [(1, 0.01), (6, 9.9)]


def test_window_is_a_pushed_range(spark, tmp_dir, df_yellow_silver):
    silver = df_yellow_silver.selectExpr(
        "vendor_id", "passenger_count", "total_amount", "CAST(pickup_datetime AS TIMESTAMP_NTZ) AS pickup_datetime",
        "CAST(dropoff_datetime AS TIMESTAMP_NTZ) AS dropoff_datetime", "taxi_type", "partition_year",
        "partition_month")
    silver.write.parquet(tmp_dir + "/silver")
    plan = plan_text(consolidate([spark.read.parquet(tmp_dir + "/silver")], Q))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(pickup_datetime,2023-01-01T00:00)" in pushed
    assert "LessThan(pickup_datetime,2023-06-01T00:00)" in pushed
