"""The two business questions as Spark SQL.

DataFrames are bound as named relations (``{gold}``) and values as named
parameters, so the text never needs string-built literals and Catalyst plans it
exactly like the DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.specs import AVG_PASSENGER_COUNT, AVG_TOTAL_AMOUNT, HORA, MES, QualitySpec

Q1_SQL = f"""
SELECT month(tpep_pickup_datetime) AS {MES},
       round(avg(total_amount), 2) AS {AVG_TOTAL_AMOUNT}
FROM {{gold}}
WHERE taxi_type = :tag
GROUP BY month(tpep_pickup_datetime)
ORDER BY {MES}
"""

Q2_SQL = f"""
SELECT hour(tpep_pickup_datetime) AS {HORA},
       round(avg(passenger_count), 2) AS {AVG_PASSENGER_COUNT}
FROM {{gold}}
WHERE tpep_pickup_datetime >= CAST(:start AS TIMESTAMP_NTZ)
  AND tpep_pickup_datetime < CAST(:end AS TIMESTAMP_NTZ)
GROUP BY hour(tpep_pickup_datetime)
ORDER BY {HORA}
"""

READ_BACK_MONTHLY = f"SELECT {MES}, {AVG_TOTAL_AMOUNT} FROM {{table}} ORDER BY {MES}"
READ_BACK_HOURLY = f"SELECT {HORA}, {AVG_PASSENGER_COUNT} FROM {{table}} ORDER BY {HORA}"


def q1(spark: SparkSession, gold: DataFrame, q: QualitySpec) -> DataFrame:
    """Mean amount per pickup month of the monthly tag, in SQL."""
    return spark.sql(Q1_SQL, args={"tag": q.monthly_tag}, gold=gold)


def q2(spark: SparkSession, gold: DataFrame, q: QualitySpec) -> DataFrame:
    """Mean passengers per pickup hour in the hourly month, in SQL."""
    start, end = q.month_window(q.hourly_month)
    return spark.sql(Q2_SQL, args={"start": f"{start} 00:00:00", "end": f"{end} 00:00:00"}, gold=gold)


def read_back(spark: SparkSession, table: str, hourly: bool = False) -> DataFrame:
    """Q1/Q2 as the reference runs them: read the stored result table, ordered."""
    sql = READ_BACK_HOURLY if hourly else READ_BACK_MONTHLY
    return spark.sql(sql.format(table=table))
