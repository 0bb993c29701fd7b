"""Schema comparison (C2-C4) and expected months."""

from tripflow.operators.schema_audit import column_comparison, lowercase_check, missing_months, required_columns
from tripflow.specs import YELLOW, month_range


def test_column_comparison(spark):
    out = {r.coluna: (r.yellow, r.green) for r in
           column_comparison(spark, {"yellow": ["a", "b", "airport_fee"], "green": ["a", "b", "ehail_fee"]}).collect()}
    assert out == {"a": (True, True), "b": (True, True), "airport_fee": (True, False), "ehail_fee": (False, True)}


def test_required_columns(spark):
    df = spark.createDataFrame([(1, None, 3.0)], "VendorID long, passenger_count double, total_amount double")
    rows = {r.coluna: (r.presente, r.tipo, r.nao_nulos) for r in required_columns(df, YELLOW).collect()}
    assert rows["VendorID"] == (True, "bigint", 1)
    assert rows["passenger_count"] == (True, "double", 0)
    assert rows["tpep_pickup_datetime"] == (False, "N/A", 0)


def test_lowercase_check(spark, df_gold_monthly):
    rows = {r.coluna: r.minusculo for r in lowercase_check(spark, df_gold_monthly.schema, "gold").collect()}
    assert rows["VendorID"] is False and rows["taxi_type"] is True


def test_missing_months(df_boundary_silver):
    spec = YELLOW.with_months("2022-11", "2023-06")
    got = sorted(r.mes for r in missing_months(df_boundary_silver, spec).collect())
    assert got == ["2022-11", "2023-02", "2023-04"]
    assert spec.months == month_range("2022-11", "2023-06")


def test_required_columns_all_absent_on_empty_input(spark):
    df = spark.createDataFrame([], "x long")
    rows = required_columns(df, YELLOW).collect()
    assert len(rows) == 5 and all(r.presente is False and r.nao_nulos == 0 for r in rows)
