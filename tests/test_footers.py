"""The footers of all landed months by one job: what it tells, and that odd months are read as before."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripflow.sources import landing
from tripflow.sources.footers import entry_footers, read_footers
from tripflow.sources.landing import land_feed, landed_columns, list_landing, month_file, month_status, read_months, scan_landing
from tripflow.specs import YELLOW, FeedSpec, month_range

SPEC = FeedSpec(tag="yellow", prefix="yellow_tripdata", bronze_types=YELLOW.bronze_types, pickup_col="tpep_pickup_datetime",
                dropoff_col="tpep_dropoff_datetime", months=month_range("2022-01", "2022-12"))


def write(root, month, ids, kind=pa.int64(), part=None, **options):
    path = month_file(root, SPEC.prefix, month)
    if part is not None:
        os.makedirs(path, exist_ok=True)
        path = f"{path}/{part}"
    pq.write_table(pa.table({"VendorID": pa.array(ids, kind), "total_amount": pa.array([1.5] * len(ids), pa.float64())}), path, **options)


def jobs(spark, work):
    """The result of ``work`` and how many Spark jobs it ran."""
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    return work(), len(set(tracker.getJobIdsForGroup(None)) - before)


@pytest.fixture
def mixed(tmp_dir):
    """Ten alike months (two of them folders), then one of another type, one of parts that disagree, one that is no Parquet."""
    for m in range(1, 9):
        write(tmp_dir, f"2022-{m:02d}", list(range(m)), row_group_size=2)
    for m in (9, 10):
        write(tmp_dir, f"2022-{m:02d}", [1] * m, part="a.parquet")
        write(tmp_dir, f"2022-{m:02d}", [2], part="b.parquet")
    write(tmp_dir, "2022-11", [5, 6], pa.int32())
    write(tmp_dir, "2022-12", [7], pa.int32(), part="a.parquet")
    write(tmp_dir, "2022-12", ["8"], pa.string(), part="b.parquet")
    with open(month_file(tmp_dir, SPEC.prefix, "2023-01"), "wb") as f:
        f.write(b"PAR1 no footer PAR1")
    return tmp_dir


def test_footer_rows(spark, mixed):
    files = list_landing(spark, mixed, SPEC.prefix)
    rows = {r.path.split("/")[-1] if "a.parquet" not in r.path and "b.parquet" not in r.path else "/".join(r.path.split("/")[-2:]): r
            for r in read_footers(spark, [f.path for f in files]).collect()}
    assert len(rows) == 8 + 4 + 1 + 2 + 1
    five = rows[f"{SPEC.prefix}_2022-05.parquet"]
    assert (five.linhas, five.grupos, five.erro) == (5, 3, None)
    assert five.bytes == os.path.getsize(month_file(mixed, SPEC.prefix, "2022-05"))
    assert five.esquema == rows[f"{SPEC.prefix}_2022-09.parquet/a.parquet"].esquema != rows[f"{SPEC.prefix}_2022-11.parquet"].esquema
    broken = rows[f"{SPEC.prefix}_2023-01.parquet"]
    assert broken.erro and broken.linhas is None and broken.esquema is None
    assert read_footers(spark, []).collect() == []


def test_entries(spark, mixed):
    files = {f.month: f.path for f in list_landing(spark, mixed, SPEC.prefix)}
    found = entry_footers(spark, list(files.values()))
    assert (found[files["2022-09"]].rows, found[files["2022-09"]].files) == (10, 2)
    assert found[files["2022-12"]].key is None and found[files["2023-01"]].key is None
    assert len({found[files[f"2022-{m:02d}"]].key for m in range(1, 11)}) == 1


def test_the_months_read_as_one_by_one(spark, mixed, monkeypatch):
    def seen():
        status = {r.mes: (r.status, r.linhas, r.erro) for r in month_status(spark, SPEC, mixed).collect()}
        good = [f for f in list_landing(spark, mixed, SPEC.prefix) if f.month != "2023-01"]
        rows = sorted((r.partition_year, r.partition_month, r.vendorid, r.total_amount) for r in scan_landing(spark, SPEC, mixed, files=good).collect())
        schemas = {m: r.schema for m, r in read_months(spark, good).items()}
        return status, rows, schemas

    together = seen()
    monkeypatch.setattr(landing, "_months_alike", lambda *_: {})
    assert together == seen()
    assert together[0]["2022-12"][:2] == ("ok", 2) and together[0]["2023-01"][0] == "error" and "footer" in together[0]["2023-01"][2] and together[0]["2022-10"] == ("ok", 11, None)
    assert len(together[1]) == sum(range(1, 9)) + 10 + 11 + 2 + 2


def test_a_deeper_folder_is_left_to_spark(spark, tmp_dir):
    for m in (1, 2):
        write(tmp_dir, f"2022-{m:02d}", [1, 2])
    folder = month_file(tmp_dir, SPEC.prefix, "2022-03") + "/zone=4"
    os.makedirs(folder)
    pq.write_table(pa.table({"VendorID": pa.array([3], pa.int64())}), f"{folder}/a.parquet")
    files = list_landing(spark, tmp_dir, SPEC.prefix)
    assert entry_footers(spark, [f.path for f in files])[files[2].path].key is None
    reads = read_months(spark, files)
    assert reads["2022-03"].schema.names == ["VendorID", "zone"] and [reads[f"2022-{m:02d}"].rows for m in (1, 2, 3)] == [2, 2, None]
    assert {r.mes: r.linhas for r in month_status(spark, SPEC, tmp_dir).collect() if r.status == "ok"} == {"2022-01": 2, "2022-02": 2, "2022-03": 1}


def test_a_store_closed_to_python_is_read_by_spark(spark, tmp_dir):
    """``viewfs`` links the folder, and only Spark can open it."""
    for m in (1, 2):
        write(tmp_dir, f"2022-{m:02d}", [1, 2])
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.landed.link./in", f"file://{tmp_dir}")
    files = list_landing(spark, "viewfs://landed/in", SPEC.prefix)
    assert [f.month for f in files] == ["2022-01", "2022-02"]
    assert all(r.erro for r in read_footers(spark, [f.path for f in files]).collect())
    assert {r.mes: r.linhas for r in month_status(spark, SPEC, "viewfs://landed/in", months=("2022-01", "2022-02")).collect()} == {"2022-01": 2, "2022-02": 2}


def test_jobs_do_not_grow_with_the_months(spark, tmp_dir):
    raw = spark.range(240).selectExpr("id AS VendorID", "double(id) AS total_amount", "int(2020 + id % 24 div 12) AS partition_year", "int(id % 12 + 1) AS partition_month")
    few = land_feed(raw.where("partition_year = 2020 AND partition_month <= 3"), SPEC, f"{tmp_dir}/few")
    many = land_feed(raw, SPEC, f"{tmp_dir}/many")
    counts = []
    for path, months in ((few, 3), (many, 24)):
        files = list_landing(spark, path, SPEC.prefix)
        reads, n = jobs(spark, lambda: read_months(spark, files))
        assert len(reads) == months and all(r.rows == 10 for r in reads.values())
        counts.append(n)
    assert counts[0] == counts[1]


def test_columns_of_all_months(spark, mixed):
    got = {(r.mes, r.coluna): (r.tipo, r.linhas) for r in landed_columns(spark, SPEC, mixed).collect()}
    assert got["2022-01", "VendorID"] == ("bigint", 1) and got["2022-11", "VendorID"] == ("int", 2)
    assert got["2022-10", "total_amount"] == ("double", 11) and not any(m == "2023-01" for m, _ in got)
    assert landed_columns(spark, SPEC, mixed, files=[]).count() == 0
