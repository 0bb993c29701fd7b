"""Gold result tables: monthly mean amount (A1) and hourly mean passengers (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.columns import in_range, round2
from tripflow.specs import AVG_PASSENGER_COUNT, AVG_TOTAL_AMOUNT, HORA, MES, QualitySpec


def avg_amount_by_month(gold: DataFrame, tag: str = "yellow") -> DataFrame:
    """(mes, avg_total_amount): mean amount per pickup month of one feed.

    Grouping is by the pickup month, not the file month (they can differ at
    month ends). Partial aggregation runs before the shuffle, so only one row
    per month and task crosses the network.
    """
    return (
        gold.filter(F.col("taxi_type") == F.lit(tag))
        .groupBy(F.month("tpep_pickup_datetime").alias(MES))
        .agg(round2(F.avg("total_amount")).alias(AVG_TOTAL_AMOUNT))
        .orderBy(MES)
    )


def avg_passengers_by_hour(gold: DataFrame, q: QualitySpec) -> DataFrame:
    """(hora, avg_passenger_count) over all feeds for pickups in ``q.hourly_month``.

    Gold holds only the quality year, so MONTH(pickup) = m is the pushable
    range [y-m-01, next month) of that year.
    """
    start, end = q.month_window(q.hourly_month)
    return (
        gold.filter(in_range("tpep_pickup_datetime", start, end))
        .withColumn(HORA, F.hour("tpep_pickup_datetime"))
        .groupBy(HORA)
        .agg(round2(F.avg("passenger_count")).alias(AVG_PASSENGER_COUNT))
        .orderBy(HORA)
    )
