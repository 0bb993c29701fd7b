"""The streamed Bronze against the batch one: odd files, months that land again, retried batches."""

import datetime
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tripflow.plans.medallion import Lake, ingest_bronze_from_landing
from tripflow.specs import GREEN
from tripflow.sources import sinks
from tripflow.streaming.incremental_ingest import BronzeIngest, run_bronze_ingest_once

STAMP = datetime.datetime(2023, 1, 5, 8, 0)


def land(spark, folder, month, rows, vendor="long", suffix=".parquet", **more):
    """A month file as a source would deliver it: one plain file."""
    os.makedirs(folder, exist_ok=True)
    df = spark.range(rows).select(
        F.col("id").cast(vendor).alias("VendorID"), F.lit(STAMP).alias("lpep_pickup_datetime"), F.lit(STAMP).alias("lpep_dropoff_datetime"),
        F.lit(1.0).alias("passenger_count"), (F.col("id") + 0.5).alias("total_amount"), *[F.lit(v).alias(k) for k, v in more.items()])
    out = f"{folder}/../tmp-{month}-{len(os.listdir(folder))}-{rows}"
    df.coalesce(1).write.parquet(out)
    part = next(f for f in os.listdir(out) if f.startswith("part-"))
    shutil.copy(f"{out}/{part}", f"{folder}/{GREEN.prefix}_{month}{suffix}")


def stored(spark, path):
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return sorted(map(str, (r.asDict() for r in df.select(*sorted(df.columns)).collect())))


def both(spark, tmp_dir, name):
    """Rows written by the stream, and what stream and batch have then."""
    landing = tmp_dir + "/landing"
    n = run_bronze_ingest_once(spark, GREEN, landing, tmp_dir + "/stream", tmp_dir + "/ck")
    lake = Lake(f"{tmp_dir}/lake-{name}", f"{name}_b", f"{name}_s", f"{name}_g")
    ingest_bronze_from_landing(spark, GREEN, landing, lake)
    return n, stored(spark, tmp_dir + "/stream"), stored(spark, lake.path("bronze", "green_trips"))


def test_odd_months_end_as_in_batch(spark, tmp_dir):
    landing = tmp_dir + "/landing"
    land(spark, landing, "2023-01", 4)
    land(spark, landing, "2023-01", 4, suffix="_backup.parquet")
    land(spark, landing, "2023-02", 3, vendor="string", unknown_column="kept")
    open(f"{landing}/{GREEN.prefix}_2023-03.parquet", "wb").close()
    with open(f"{landing}/{GREEN.prefix}_2023-04.parquet", "wb") as f:
        f.write(b"PAR1 this is no footer PAR1")
    land(spark, landing, "2023-05", 2)
    n, stream, batch = both(spark, tmp_dir, "odd")
    assert n == 9 and stream == batch and len(stream) == 9
    ledger = {r.mes: (r.status, r.linhas) for r in BronzeIngest(spark, GREEN, landing, tmp_dir + "/stream").ledger().collect()}
    assert {m: s for m, (s, _) in ledger.items()} == {"2023-01": "ok", "2023-02": "ok", "2023-03": "empty", "2023-04": "error", "2023-05": "ok"}
    assert both(spark, tmp_dir, "odd")[0] == 0  # nothing new: nothing written


def test_a_month_that_lands_again_replaces_its_rows(spark, tmp_dir):
    landing = tmp_dir + "/landing"
    land(spark, landing, "2023-01", 4)
    land(spark, landing, "2023-02", 3)
    assert both(spark, tmp_dir, "again")[0] == 7
    land(spark, landing, "2023-01", 6)  # the same name, other bytes
    land(spark, landing, "2023-03", 1)
    n, stream, batch = both(spark, tmp_dir, "again")
    assert n == 7 and stream == batch and len(stream) == 10


def test_a_month_folder_that_gains_and_loses_files(spark, tmp_dir):
    landing, month = tmp_dir + "/landing", f"landing_file={GREEN.prefix}_2023-01"
    for name, rows in (("a", 2), ("b", 3)):
        land(spark, tmp_dir + "/parts", name, rows)
    os.makedirs(f"{landing}/{month}")
    shutil.copy(f"{tmp_dir}/parts/{GREEN.prefix}_a.parquet", f"{landing}/{month}/a.parquet")
    assert run_bronze_ingest_once(spark, GREEN, landing, tmp_dir + "/stream", tmp_dir + "/ck") == 2
    shutil.copy(f"{tmp_dir}/parts/{GREEN.prefix}_b.parquet", f"{landing}/{month}/b.parquet")
    n, stream, batch = both(spark, tmp_dir, "parts")
    assert n == 5 and stream == batch and len(stream) == 5


def test_a_retried_batch_is_a_no_op_and_a_lost_ledger_entry_does_not_double(spark, tmp_dir, monkeypatch):
    landing = tmp_dir + "/landing"
    land(spark, landing, "2023-01", 4)
    ingest = BronzeIngest(spark, GREEN, landing, tmp_dir + "/stream")
    rows = spark.createDataFrame([(f"file:{landing}/{GREEN.prefix}_2023-01.parquet",)] * 4, "path string")
    with monkeypatch.context() as m:  # the batch fails between the months and the ledger
        m.setattr(ingest, "_enter", lambda entries: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.batch(rows, 0)
    ingest.batch(rows, 0)
    once = stored(spark, tmp_dir + "/stream")
    ingest.batch(rows, 0)
    assert ingest.rows == 4 and stored(spark, tmp_dir + "/stream") == once and len(once) == 4


def test_folders_of_a_file_sink_are_refused(spark, tmp_dir):
    os.makedirs(tmp_dir + "/stream/_spark_metadata")
    with pytest.raises(ValueError, match="file sink"):
        BronzeIngest(spark, GREEN, tmp_dir, tmp_dir + "/stream")


def test_months_are_looked_for_once_a_file(spark, tmp_dir):
    """No pattern is matched for every landed row; a path that names no month is left out."""
    landing = tmp_dir + "/landing"
    land(spark, landing, "2023-01", 4)
    land(spark, landing, "2023-02", 3)
    ingest, collected = BronzeIngest(spark, GREEN, landing, tmp_dir + "/stream"), []

    class Watched:  # stands for the batch's frame: what is asked of it
        def __init__(self, df):
            self.df = df

        def select(self, *columns):
            return Watched(self.df.select(*columns))

        def distinct(self):
            return Watched(self.df.distinct())

        def collect(self):
            collected.append(self.df._jdf.queryExecution().optimizedPlan().toString())
            return self.df.collect()

    paths = [f"file:{landing}/{GREEN.prefix}_2023-01.parquet", f"file:{landing}/{GREEN.prefix}_other.parquet"] * 3
    ingest.batch(Watched(spark.createDataFrame([(p,) for p in paths], "path string")), 0)
    assert ingest.rows == 4 and len(collected) == 1 and "regexp_extract" not in collected[0]


def test_months_are_counted_by_one_observed_value(spark, tmp_dir, monkeypatch):
    """Rows of every month, also those without any, are exact however many months and tasks there are."""
    df = spark.range(0, 20000, 1, 7).select(
        (1990 + F.col("id") % 11).cast("int").alias("partition_year"), (F.col("id") % 13).cast("int").alias("partition_month"), "id")
    months = [f"{y}-{m:02d}" for y in range(1989, 2003) for m in range(13)]
    want = dict.fromkeys(months, 0) | {f"{r[0]}-{r[1]:02d}": r[2] for r in df.groupBy("partition_year", "partition_month").count().collect()}
    observed, real = [], type(df).observe
    monkeypatch.setattr(type(df), "observe", lambda self, name, *values: observed.append(len(values)) or real(self, name, *values))
    assert sinks.write_months(df, tmp_dir + "/out", months) == want
    assert observed == [1]
    some = ["1990-00", "1991-01", "1989-05"]  # other months in the rows are not counted
    assert sinks.write_months(df, tmp_dir + "/some", some) == {m: want[m] for m in some}
    assert sinks.write_months(df.limit(0), tmp_dir + "/none", some) == dict.fromkeys(some, 0)
