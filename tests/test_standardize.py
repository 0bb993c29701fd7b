"""Silver standardisation."""

import math

from pyspark.sql import types as T

from tripflow.operators.standardize import complete, silver_typed, to_silver
from tripflow.specs import GREEN, SILVER_COLUMNS, YELLOW


def test_columns_renamed_and_ordered(df_bronze_yellow):
    out = to_silver(df_bronze_yellow, YELLOW)
    assert out.columns == list(SILVER_COLUMNS)
    assert "tpep_pickup_datetime" not in out.columns and "vendorid" not in out.columns


def test_tag_is_literal(df_bronze_yellow, df_bronze_green):
    assert {r.taxi_type for r in to_silver(df_bronze_yellow, YELLOW).collect()} == {"yellow"}
    assert {r.taxi_type for r in to_silver(df_bronze_green, GREEN).collect()} == {"green"}


def test_rows_with_required_nulls_removed(df_bronze_yellow, df_bronze_green):
    assert to_silver(df_bronze_yellow, YELLOW).count() == 2
    assert to_silver(df_bronze_green, GREEN).count() == 2


def test_no_nulls_left(df_bronze_yellow):
    out = to_silver(df_bronze_yellow, YELLOW)
    for c in ("vendor_id", "passenger_count", "total_amount", "pickup_datetime", "dropoff_datetime"):
        assert out.filter(out[c].isNull()).count() == 0


def test_types(df_bronze_yellow):
    kinds = {f.name: f.dataType for f in to_silver(df_bronze_yellow, YELLOW).schema.fields}
    assert kinds["vendor_id"] == T.IntegerType()
    assert kinds["passenger_count"] == T.IntegerType()
    assert kinds["total_amount"] == T.DoubleType()
    assert kinds["pickup_datetime"] == T.TimestampNTZType()
    assert kinds["dropoff_datetime"] == T.TimestampNTZType()
    assert kinds["taxi_type"] == T.StringType()
    assert kinds["partition_year"] == T.IntegerType()


def test_double_to_int_truncates_and_nan_is_dropped(spark):
    rows = [(1, 2.7, 10.0, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1),
            (1, -2.7, 10.0, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1),
            (1, math.nan, 10.0, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1),
            (1, 1.0, math.nan, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1)]
    df = spark.createDataFrame(rows, ["vendorid", "passenger_count", "total_amount", "tpep_pickup_datetime",
                                      "tpep_dropoff_datetime", "partition_year", "partition_month"])
    out = sorted(r.passenger_count for r in to_silver(df, YELLOW).collect())
    assert out == [-2, 2]


def test_non_numeric_vendor_goes_with_nulls(spark):
    rows = [("7", 1.0, 10.0, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1),
            ("x", 1.0, 10.0, "2023-01-01 00:00:00", "2023-01-01 00:05:00", 2023, 1)]
    df = spark.createDataFrame(rows, ["vendorid", "passenger_count", "total_amount", "tpep_pickup_datetime",
                                      "tpep_dropoff_datetime", "partition_year", "partition_month"])
    assert [r.vendor_id for r in to_silver(df, YELLOW).collect()] == [7]


def test_complete_predicate_equals_na_drop(df_bronze_yellow):
    typed = silver_typed(df_bronze_yellow, YELLOW)
    assert typed.filter(complete(typed)).count() == to_silver(df_bronze_yellow, YELLOW).count()


def test_valid_rows_preserved(df_bronze_yellow):
    from datetime import datetime

    rows = sorted(tuple(r) for r in to_silver(df_bronze_yellow, YELLOW).collect())
    assert rows == [
        (1, 1, 8.4, datetime(2023, 3, 2, 5, 12), datetime(2023, 3, 2, 5, 21), "yellow", 2023, 3),
        (6, 4, 31.75, datetime(2023, 1, 19, 22, 41), datetime(2023, 1, 19, 23, 2), "yellow", 2023, 1),
    ]
