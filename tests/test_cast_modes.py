"""P2 by value and by column, and the quarantine of what the cast cannot read."""

import json

import pytest

from tripflow.operators.ingest import column_cast, quarantine, to_bronze, uncastable_columns
from tripflow.plans.medallion import Lake, ingest_bronze, ingest_bronze_from_landing, quarantine_path
from tripflow.specs import YELLOW

SPEC = YELLOW.with_months("2023-01", "2023-03")


def raw(spark, vendors, month=1, fare="1.5"):
    return spark.createDataFrame([(v, fare, 2, "n", 2023, month) for v in vendors],
                                 "VendorID string, fare_amount string, passenger_count int, note string, partition_year int, partition_month int")


def test_a_column_with_one_bad_value_stays_as_delivered(spark):
    df = raw(spark, ["1", None, "x"]).toDF("vendorid", "fare_amount", "passenger_count", "note", "partition_year", "partition_month")
    assert uncastable_columns(df, SPEC) == ["vendorid"]
    kinds = dict(column_cast(df, SPEC).dtypes)
    assert (kinds["vendorid"], kinds["fare_amount"], kinds["passenger_count"], kinds["note"]) == ("string", "double", "double", "string")
    assert [r.vendorid for r in column_cast(df, SPEC).collect()] == ["1", None, "x"]
    by_value = to_bronze(raw(spark, ["1", None, "x"]), SPEC)
    assert [r.vendorid for r in by_value.collect()] == [1, None, None]
    assert dict(to_bronze(raw(spark, ["1", None]), SPEC, cast="column").dtypes)["vendorid"] == "bigint"
    assert dict(to_bronze(raw(spark, []), SPEC, cast="column").dtypes)["vendorid"] == "bigint"
    with pytest.raises(ValueError):
        to_bronze(raw(spark, []), SPEC, cast="none")


def test_quarantine_holds_every_failed_value(spark):
    df = raw(spark, ["1", None, "x", "y"], fare="?").toDF("vendorid", "fare_amount", "passenger_count", "note", "partition_year", "partition_month")
    got = quarantine(df, SPEC).collect()
    assert sorted((r.coluna, r.tipo, r.valor) for r in got) == [("fare_amount", "double", "?")] * 4 + [("vendorid", "bigint", "x"), ("vendorid", "bigint", "y")]
    assert {(r.feed, r.partition_year, r.partition_month) for r in got} == {("yellow", 2023, 1)}
    assert json.loads(next(r.linha for r in got if r.valor == "x"))["vendorid"] == "x"
    assert quarantine(df.drop("partition_year", "partition_month"), SPEC).first().partition_year is None
    assert quarantine(df.select("note"), SPEC).count() == 0


def test_column_mode_raises_over_a_table_of_another_type(spark, tmp_dir):
    lake = Lake(tmp_dir, "cm_b", "cm_s", "cm_g")
    ingest_bronze(spark, raw(spark, ["1"]), SPEC, lake, cast="column")
    with pytest.raises(ValueError, match="vendorid"):
        ingest_bronze(spark, raw(spark, ["x"], month=2), SPEC, lake, cast="column")
    assert [tuple(r) for r in spark.table("cm_b.yellow_trips").select("vendorid", "partition_month").collect()] == [(1, 1)]


def land(spark, root, month, vendors):
    path = f"{root}/yellow_tripdata_2023-0{month}.parquet"
    raw(spark, vendors).drop("partition_year", "partition_month").write.mode("overwrite").parquet(path)


def test_landed_months_keep_their_failed_values(spark, tmp_dir):
    lake, root = Lake(tmp_dir + "/lake", "cq_b", "cq_s", "cq_g"), tmp_dir + "/landing"
    for month, vendors in ((1, ["1", "x"]), (2, ["y", "z"]), (3, ["3"])):
        land(spark, root, month, vendors)

    def load(months=None):
        status = ingest_bronze_from_landing(spark, SPEC, root, lake, months=months, keep_failed=True)
        assert {r.status for r in status.collect()} == {"ok"}
        kept = spark.read.parquet(quarantine_path(lake, SPEC)).orderBy("valor").collect()
        return [(r.valor, r.partition_month) for r in kept]

    assert load() == [("x", 1), ("y", 2), ("z", 2)]
    land(spark, root, 2, ["2", "w"])
    land(spark, root, 1, ["1"])
    assert load(("2023-01", "2023-02")) == [("w", 2)]  # replaced with their months, also by nothing
    assert spark.table("cq_b.yellow_trips").where("vendorid IS NULL").count() == 1
