"""Bronze ingest (J1): lower-case names, soft cast, failure counts."""

import pytest
from pyspark.sql import types as T

from tripflow.operators.ingest import cast_failures, lowercase_columns, rename_report, soft_cast, to_bronze
from tripflow.specs import GREEN, YELLOW


@pytest.fixture
def raw_yellow(spark):
    rows = [(1, "2023-01-01 08:00:00", "2023-01-01 08:30:00", 1.0, 1.5, 10.0, 0.0, "N", 5),
            (2, "2023-01-01 09:00:00", "2023-01-01 09:30:00", 2.0, 2.5, 20.0, 1.25, "Y", 7)]
    return spark.createDataFrame(rows, ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
                                        "passenger_count", "trip_distance", "total_amount", "Airport_fee",
                                        "store_and_fwd_flag", "PULocationID"])


def test_all_names_lower(raw_yellow):
    assert all(c == c.lower() for c in lowercase_columns(raw_yellow).columns)


def test_rename_report(spark, raw_yellow):
    rows = {(r.original, r.renamed) for r in rename_report(spark, raw_yellow, "yellow").collect()}
    assert rows == {("VendorID", "vendorid"), ("Airport_fee", "airport_fee"), ("PULocationID", "pulocationid")}


def test_colliding_names_fail(spark):
    df = spark.createDataFrame([(1.0, 2.0)], ["airport_fee", "Airport_fee_x"]).toDF("airport_fee", "Airport_fee")
    with pytest.raises(ValueError):
        lowercase_columns(df)


def test_types_follow_the_spec(raw_yellow):
    kinds = {f.name: f.dataType for f in soft_cast(lowercase_columns(raw_yellow), YELLOW).schema.fields}
    assert kinds["vendorid"] == T.LongType()
    assert kinds["tpep_pickup_datetime"] == T.TimestampNTZType()
    assert kinds["pulocationid"] == T.LongType()
    assert kinds["store_and_fwd_flag"] == T.StringType()


def test_row_count_kept_and_unknown_columns_pass(spark, raw_yellow):
    extra = raw_yellow.withColumnRenamed("trip_distance", "mystery")
    out = soft_cast(lowercase_columns(extra), YELLOW)
    assert out.count() == 2 and "mystery" in out.columns


def test_feed_exclusive_columns(raw_yellow):
    out = soft_cast(lowercase_columns(raw_yellow), GREEN)
    assert "airport_fee" in out.columns  # not in the green spec: passes through untouched
    assert dict(out.dtypes)["airport_fee"] == "double"


def test_bad_values_become_null_and_are_counted(spark):
    df = spark.createDataFrame([("1", "3"), ("x", "y"), (None, "4")], ["VendorID", "payment_type"])
    low = lowercase_columns(df)
    fails = {r.coluna: r.falhas for r in cast_failures(low, YELLOW).collect()}
    assert fails == {"vendorid": 1, "payment_type": 1}
    assert [r.vendorid for r in soft_cast(low, YELLOW).collect()] == [1, None, None]


def test_to_bronze_partition_columns_are_int(spark):
    df = spark.createDataFrame([(1, 10.0, 2023, 1)], ["VendorID", "total_amount", "partition_year", "partition_month"])
    kinds = dict(to_bronze(df, YELLOW).dtypes)
    assert kinds["partition_year"] == "int" and kinds["vendorid"] == "bigint"
