"""Monthly landing files: drift, zero-byte and missing months."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tripflow.operators.schema_audit import schema_drift
from tripflow.sources.landing import (
    file_volume, ingest_tally, land_feed, list_landing, month_file, month_parts, month_schemas, month_status,
    require_complete, scan_landing,
)
from tripflow.specs import YELLOW, FeedSpec, month_range

SPEC = FeedSpec(tag="yellow", prefix="yellow_tripdata", bronze_types=YELLOW.bronze_types,
                pickup_col="tpep_pickup_datetime", dropoff_col="tpep_dropoff_datetime",
                months=month_range("2023-01", "2023-04"))


@pytest.fixture
def drift_landing(tmp_dir):
    """Month 1: int64 ids, airport_fee, all-null ehail_fee; month 2: int32 ids,
    Airport_fee, double ehail_fee; month 3: zero bytes; month 4: missing."""
    ts = pa.array([1672560000000000, 1672563600000000], pa.timestamp("us"))
    m1 = pa.table({"VendorID": pa.array([1, 2], pa.int64()), "tpep_pickup_datetime": ts,
                   "passenger_count": pa.array([1.0, None]), "total_amount": pa.array([10.0, 20.0]),
                   "airport_fee": pa.array([0.0, 1.25]), "ehail_fee": pa.array([None, None], pa.null())})
    ts2 = pa.array([1675238400000000, 1675242000000000, 1675245600000000], pa.timestamp("us"))
    m2 = pa.table({"VendorID": pa.array([3, 4, 5], pa.int32()), "tpep_pickup_datetime": ts2,
                   "passenger_count": pa.array([2.0, 3.0, 1.0]), "total_amount": pa.array([5.0, -1.0, 7.5]),
                   "Airport_fee": pa.array([None, 1.25, 0.0]), "ehail_fee": pa.array([None, 2.5, None])})
    pq.write_table(m1, month_file(tmp_dir, SPEC.prefix, "2023-01"))
    pq.write_table(m2, month_file(tmp_dir, SPEC.prefix, "2023-02"))
    open(month_file(tmp_dir, SPEC.prefix, "2023-03"), "wb").close()
    return tmp_dir


def test_month_path_and_parts():
    assert month_file("/x", "yellow_tripdata", "2023-01") == "/x/yellow_tripdata_2023-01.parquet"
    assert month_parts("2023-01") == (2023, 1)


def test_listing_sees_empty_files(spark, drift_landing):
    files = list_landing(spark, drift_landing, SPEC.prefix)
    assert [(f.month, f.size > 0) for f in files] == [("2023-01", True), ("2023-02", True), ("2023-03", False)]


def test_one_scan_reads_drifting_months(spark, drift_landing):
    df = scan_landing(spark, SPEC, drift_landing)
    kinds = dict(df.dtypes)
    assert kinds["vendorid"] == "bigint" and kinds["airport_fee"] == "double"
    rows = sorted((r.partition_month, r.vendorid, r.airport_fee) for r in df.collect())
    assert rows == [(1, 1, 0.0), (1, 2, 1.25), (2, 3, None), (2, 4, 1.25), (2, 5, 0.0)]


def test_month_status(spark, drift_landing):
    status = {r.mes: (r.status, r.linhas) for r in month_status(spark, SPEC, drift_landing).collect()}
    assert status == {"2023-01": ("ok", 2), "2023-02": ("ok", 3), "2023-03": ("empty", 0),
                      "2023-04": ("missing", 0)}
    tally = ingest_tally(month_status(spark, SPEC, drift_landing)).collect()[0]
    assert (tally.sucessos, tally.falhas) == (2, 2)
    with pytest.raises(ValueError):
        require_complete(month_status(spark, SPEC, drift_landing))


def test_schema_drift_matrix(spark, drift_landing):
    schemas = month_schemas(spark, list_landing(spark, drift_landing, SPEC.prefix))
    drift = {r.coluna: (r["2023-01"], r["2023-02"]) for r in schema_drift(spark, schemas, "yellow").collect()}
    assert drift["VendorID"] == ("bigint", "int")
    assert drift["airport_fee"][1] == "AUSENTE" and drift["Airport_fee"][0] == "AUSENTE"
    assert drift["ehail_fee"][1] == "double"
    assert "total_amount" not in drift


def test_file_volume(spark, drift_landing):
    vol = {r.mes: (r.linhas, r.colunas, r.tamanho_mb) for r in file_volume(spark, SPEC, drift_landing).collect()}
    assert vol["2023-01"][:2] == (2, 6) and vol["2023-02"][:2] == (3, 6)
    assert vol["2023-01"][2] == round(os.path.getsize(month_file(drift_landing, SPEC.prefix, "2023-01")) / 1048576, 2)


def test_land_feed_round_trip(spark, tmp_dir):
    raw = spark.createDataFrame([(1, 10.0, 2023, 1), (2, 11.0, 2023, 1), (3, 12.0, 2023, 2)],
                                ["VendorID", "total_amount", "partition_year", "partition_month"])
    out = land_feed(raw, SPEC, tmp_dir)
    back = scan_landing(spark, SPEC, out)
    assert sorted((r.partition_month, r.vendorid) for r in back.collect()) == [(1, 1), (1, 2), (2, 3)]
    assert back.filter(F.col("partition_year") != 2023).count() == 0


def test_colliding_names_are_reported_and_skipped(spark, drift_landing):
    bad = pa.table({"VendorID": pa.array([9], pa.int64()), "airport_fee": pa.array([1.0]),
                    "Airport_fee": pa.array([2.0])})
    pq.write_table(bad, month_file(drift_landing, SPEC.prefix, "2023-04"))
    status = {r.mes: (r.status, r.erro) for r in month_status(spark, SPEC, drift_landing).collect()}
    assert status["2023-04"][0] == "error" and "airport_fee" in status["2023-04"][1]
    assert status["2023-01"][0] == "ok" and status["2023-02"][0] == "ok"


def test_landing_ingest_skips_unreadable_months(spark, drift_landing, tmp_dir):
    from tripflow.plans.medallion import Lake, ingest_bronze_from_landing

    bad = pa.table({"VendorID": pa.array([9], pa.int64()), "airport_fee": pa.array([1.0]),
                    "Airport_fee": pa.array([2.0])})
    pq.write_table(bad, month_file(drift_landing, SPEC.prefix, "2023-04"))
    lake = Lake(tmp_dir + "/lake", "col_bronze", "col_silver", "col_gold")
    status = ingest_bronze_from_landing(spark, SPEC, drift_landing, lake)
    assert status.filter("status = 'ok'").count() == 2
    assert spark.table("col_bronze.yellow_trips").count() == 5


def test_stream_reads_drifting_and_empty_months(spark, drift_landing, tmp_dir):
    from tripflow.streaming.incremental_ingest import run_bronze_ingest_once

    rows = run_bronze_ingest_once(spark, SPEC, drift_landing, tmp_dir + "/bronze", tmp_dir + "/ck")
    out = spark.read.parquet(tmp_dir + "/bronze")
    assert rows == 5 and out.count() == 5
    assert dict(out.dtypes)["vendorid"] == "bigint"
    assert sorted(r.airport_fee for r in out.filter("partition_month = 2").collect() if r.airport_fee is not None) \
        == [0.0, 1.25]


def _month(folder, month, table):
    pq.write_table(table, month_file(folder, SPEC.prefix, month))


def test_unknown_columns_text_ids_and_garbage_are_one_month_each(spark, drift_landing, tmp_dir):
    from tripflow.plans.medallion import Lake, ingest_bronze_from_landing

    _month(drift_landing, "2023-04", pa.table({"VendorID": ["7", "x"], "total_amount": [1.0, 2.0], "New_Col": pa.array([5, 6], pa.int32())}))
    _month(drift_landing, "2023-09", pa.table({"VendorID": pa.array([8], pa.int64()), "New_Col": pa.array([1 << 40], pa.int64())}))
    with open(month_file(drift_landing, SPEC.prefix, "2023-05"), "wb") as f:
        f.write(b"no parquet here" * 100)
    lake = Lake(tmp_dir + "/lake", "un_bronze", "un_silver", "un_gold")
    status = {r.mes: (r.status, r.linhas) for r in ingest_bronze_from_landing(spark, SPEC, drift_landing, lake).collect()}
    assert status == {"2023-01": ("ok", 2), "2023-02": ("ok", 3), "2023-03": ("empty", 0), "2023-04": ("ok", 2),
                      "2023-05": ("error", 0), "2023-09": ("ok", 1)}
    table = spark.table("un_bronze.yellow_trips")
    assert table.count() == 8 and dict(table.dtypes)["new_col"] == "bigint"
    rows = {(r.vendorid, r.new_col) for r in table.where("partition_month IN (4, 9)").collect()}
    assert rows == {(7, 5), (None, 6), (8, 1 << 40)}
    with pytest.raises(ValueError):
        ingest_bronze_from_landing(spark, SPEC, drift_landing, lake, strict=True)


def test_only_the_months_asked_for_are_loaded(spark, drift_landing, tmp_dir):
    from tripflow.plans.medallion import Lake, ingest_bronze_from_landing

    lake = Lake(tmp_dir + "/lake", "few_bronze", "few_silver", "few_gold")
    for months, rows in (((), 0), (("2023-03",), 0), (("2023-02",), 3), (("2024-01", "2023-01"), 5)):
        status = ingest_bronze_from_landing(spark, SPEC, drift_landing, lake, months=months)
        assert sorted(r.mes for r in status.collect()) == sorted(months)
        assert (spark.table("few_bronze.yellow_trips").count() if rows else 0) == rows


def test_parts_of_a_month_may_disagree(spark, tmp_dir):
    folder = f"{tmp_dir}/landing_file={SPEC.prefix}_2023-01"
    os.makedirs(folder)
    pq.write_table(pa.table({"VendorID": pa.array([1], pa.int64()), "odd": ["a"]}), folder + "/part-0.parquet")
    pq.write_table(pa.table({"VendorID": pa.array(["2"]), "Airport_fee": [1.5], "odd": pa.array([3], pa.int32())}), folder + "/part-1.parquet")
    rows = sorted((r.vendorid, r.airport_fee, r.odd) for r in scan_landing(spark, SPEC, tmp_dir).collect())
    assert rows == [(1, None, "a"), (2, 1.5, "3")]


def test_backups_are_not_months_and_the_month_is_a_constant(spark, drift_landing):
    from tripflow.plans.inspect import plan_text

    for name in ("yellow_tripdata_2023-01.parquet.bak", "old_yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-01 (1).parquet"):
        with open(f"{drift_landing}/{name}", "wb") as f:
            f.write(b"x")
    assert [f.month for f in list_landing(spark, drift_landing, SPEC.prefix)] == ["2023-01", "2023-02", "2023-03"]
    assert "regexp_extract" not in plan_text(scan_landing(spark, SPEC, drift_landing))


def test_stream_keeps_unknown_columns_and_counts_every_batch(spark, drift_landing, tmp_dir):
    from tripflow.streaming.incremental_ingest import run_bronze_ingest_once

    _month(drift_landing, "2023-04", pa.table({"VendorID": pa.array([1], pa.int64()), "New_Col": ["kept"]}))
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        assert run_bronze_ingest_once(spark, SPEC, drift_landing, tmp_dir + "/b", tmp_dir + "/c") == 6
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    out = spark.read.option("mergeSchema", "true").parquet(tmp_dir + "/b")
    assert [r.new_col for r in out.where("new_col IS NOT NULL").collect()] == ["kept"]


def test_a_month_landed_again_with_damaged_pages_keeps_its_earlier_rows(spark, tmp_dir):
    from tripflow.plans.medallion import Lake, ingest_bronze_from_landing

    def ids(*values):
        return pa.table({"VendorID": pa.array(values, pa.int64()), "total_amount": pa.array([1.0] * len(values))})

    landing, lake = tmp_dir + "/landing", Lake(tmp_dir + "/lake", "cut_bronze", "cut_silver", "cut_gold")
    os.makedirs(landing)
    for month, values in (("2023-01", (1, 2)), ("2023-02", (3,)), ("2023-03", (4,))):
        _month(landing, month, ids(*values))
    months = ("2023-01", "2023-02", "2023-03")
    ingest_bronze_from_landing(spark, SPEC, landing, lake, months)
    for together in (True, False):  # the damaged month in a group, and by itself
        _month(landing, "2023-01", ids(*range(1000)))
        with open(month_file(landing, SPEC.prefix, "2023-01"), "r+b") as f:
            f.seek(4)
            f.write(b"\xff" * 1000)  # the first data pages; the footer is whole
        _month(landing, "2023-02", ids(5, 6))
        _month(landing, "2023-03", ids())
        status = ingest_bronze_from_landing(spark, SPEC, landing, lake, months if together else ("2023-01",))
        assert {r.mes: (r.status, r.linhas) for r in status.collect()} == \
            {"2023-01": ("error", 0), **({"2023-02": ("ok", 2), "2023-03": ("ok", 0)} if together else {})}
        rows = spark.read.parquet(lake.path("bronze", "yellow_trips")).select("partition_month", "vendorid").collect()
        assert sorted(map(tuple, rows)) == [(1, 1), (1, 2), (2, 5), (2, 6)]


def test_parts_that_disagree_are_all_read_whatever_their_ending(spark, tmp_dir):
    folder = f"{tmp_dir}/landing_file={SPEC.prefix}_2023-01"
    os.makedirs(folder)
    for k, (name, kind) in enumerate((("part-0.parquet", pa.int64()), ("part-1.parquet", pa.string()), ("part-00002", pa.int64()), ("part-3.parq", pa.int64()))):
        pq.write_table(pa.table({"VendorID": pa.array([k]).cast(kind)}), f"{folder}/{name}")
    with open(folder + "/_SUCCESS.txt", "wb") as f:
        f.write(b"hidden")
    assert sorted(r.vendorid for r in scan_landing(spark, SPEC, tmp_dir).collect()) == [0, 1, 2, 3]
    with open(folder + "/part-00004", "wb") as f:
        f.write(b"no parquet here" * 100)
    status = {r.mes: r.status for r in month_status(spark, SPEC, tmp_dir).collect()}
    assert status["2023-01"] == "error"


def test_file_volume_key_compares_the_size_with_the_files(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    from tripflow.plans import registry

    assert {r.tem_tamanho for r in registry.QUERIES["file_volume"](spark, SF_SMALL).collect()} == {True}
    real = registry.landing.file_volume
    monkeypatch.setattr(registry.landing, "file_volume", lambda *a, **k: real(*a, **k).withColumn("tamanho_mb", F.col("tamanho_mb") + 7))
    assert {r.tem_tamanho for r in registry.QUERIES["file_volume"](spark, SF_SMALL).collect()} == {False}
