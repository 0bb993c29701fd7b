"""Gold result tables."""

from tripflow.operators.aggregates import avg_amount_by_month, avg_passengers_by_hour
from tripflow.plans.sql_forms import q1, q2
from tripflow.specs import REFERENCE_QUALITY as Q


def test_monthly_columns(df_gold_monthly):
    assert avg_amount_by_month(df_gold_monthly).columns == ["mes", "avg_total_amount"]


def test_monthly_only_yellow(df_gold_monthly):
    rows = {r.mes: r.avg_total_amount for r in avg_amount_by_month(df_gold_monthly).collect()}
    assert rows[1] == 10.5 and rows[5] == 50.5


def test_monthly_five_months_in_order(df_gold_monthly):
    assert [r.mes for r in avg_amount_by_month(df_gold_monthly).collect()] == [1, 2, 3, 4, 5]


def test_monthly_rounding(spark):
    # 0.125 is exact in binary: HALF_UP gives 0.13 (half-even would give 0.12).
    data = [(1, 1, 0.125, "2023-01-01 08:00:00", "2023-01-01 08:30:00", "yellow", 2023, 1),
            (1, 1, 0.125, "2023-01-02 08:00:00", "2023-01-02 08:30:00", "yellow", 2023, 1)]
    cols = ["VendorID", "passenger_count", "total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime",
            "taxi_type", "partition_year", "partition_month"]
    assert avg_amount_by_month(spark.createDataFrame(data, cols)).collect()[0].avg_total_amount == 0.13


def test_hourly_hours(df_gold_hourly):
    assert [r.hora for r in avg_passengers_by_hour(df_gold_hourly, Q).collect()] == [6, 16, 21]


def test_hourly_mean(df_gold_hourly):
    rows = {r.hora: r.avg_passenger_count for r in avg_passengers_by_hour(df_gold_hourly, Q).collect()}
    assert rows[16] == 2.5 and rows[6] == 3.0


def test_hourly_range_and_columns(df_gold_hourly):
    out = avg_passengers_by_hour(df_gold_hourly, Q)
    assert out.columns == ["hora", "avg_passenger_count"]
    assert all(0 <= r.hora <= 23 for r in out.collect())


def test_sql_forms_match_dataframe_forms(spark, df_gold_monthly, df_gold_hourly):
    assert q1(spark, df_gold_monthly, Q).collect() == avg_amount_by_month(df_gold_monthly).collect()
    assert q2(spark, df_gold_hourly, Q).collect() == avg_passengers_by_hour(df_gold_hourly, Q).collect()


def test_hourly_uses_only_the_hourly_month(df_gold_hourly):
    # the February trip at 21:10 (6 passengers) must not move hour 21 (May: 2 passengers)
    rows = {r.hora: r.avg_passenger_count for r in avg_passengers_by_hour(df_gold_hourly, Q).collect()}
    assert rows[21] == 2.0
