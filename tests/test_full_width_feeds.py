"""Bronze on full-width raw files (every column of each feed, source spelling),
as the raw monthly files arrive: lower-case names, spec types, rows kept,
feed-exclusive columns present."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripflow.operators.standardize import to_silver
from tripflow.sources.landing import month_file, scan_landing
from tripflow.specs import GREEN, YELLOW

TS = pa.array([1672560000000000, 1672563600000000], pa.timestamp("us"))
DOUBLES = pa.array([1.0, 2.5])


def _raw(spec_types, renames, overrides):
    cols = {}
    for name, kind in spec_types:
        source = renames.get(name, name)
        if name in overrides:
            cols[source] = overrides[name]
        elif kind == "bigint":
            cols[source] = pa.array([1, 2], pa.int64())
        elif kind == "timestamp_ntz":
            cols[source] = TS
        elif kind == "string":
            cols[source] = pa.array(["N", "Y"])
        else:
            cols[source] = DOUBLES
    return pa.table(cols)


SOURCE_NAMES = {"vendorid": "VendorID", "ratecodeid": "RatecodeID", "pulocationid": "PULocationID",
                "dolocationid": "DOLocationID", "airport_fee": "Airport_fee"}


@pytest.fixture
def full_landing(tmp_dir):
    yellow = _raw(YELLOW.bronze_types, SOURCE_NAMES, {"passenger_count": pa.array([1.0, None])})
    green = _raw(GREEN.bronze_types, SOURCE_NAMES, {"ehail_fee": pa.array([None, None], pa.null())})
    pq.write_table(yellow, month_file(tmp_dir, YELLOW.prefix, "2023-01"))
    pq.write_table(green, month_file(tmp_dir, GREEN.prefix, "2023-01"))
    return tmp_dir


@pytest.mark.parametrize("spec", [YELLOW, GREEN], ids=["yellow", "green"])
def test_every_spec_column_lower_case_and_typed(spark, full_landing, spec):
    bronze = scan_landing(spark, spec, full_landing)
    kinds = dict(bronze.dtypes)
    for name, kind in spec.bronze_types:
        assert kinds[name] == kind, name
    assert all(c == c.lower() for c in bronze.columns)
    assert bronze.count() == 2


def test_feed_exclusive_columns(spark, full_landing):
    yellow = scan_landing(spark, YELLOW, full_landing).columns
    green = scan_landing(spark, GREEN, full_landing).columns
    assert "airport_fee" in yellow and "airport_fee" not in green
    assert {"ehail_fee", "trip_type"} <= set(green) and "ehail_fee" not in yellow
    assert len(set(yellow) & set(green)) == 16 + 2  # 16 shared source columns + the two month columns


def test_full_width_to_silver(spark, full_landing):
    silver = to_silver(scan_landing(spark, YELLOW, full_landing), YELLOW)
    assert silver.count() == 1  # the row without passengers is dropped
    assert to_silver(scan_landing(spark, GREEN, full_landing), GREEN).count() == 2
