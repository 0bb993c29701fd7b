"""Data-quality profiles.

Each profile is one scan with many aggregates (the reference runs one query per
column or per month). Results are tiny; group keys are bounded by months,
columns or distinct passenger counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.columns import month_label, pct_half_up, round2
from tripflow.specs import (
    ANO_INVALIDO, AVG_PASSENGER_COUNT, AVG_TOTAL_AMOUNT, COLUNA, DESVIO_PADRAO, LINHAS, MAXIMO,
    MAX_PASSENGER, MAX_TOTAL_AMOUNT, MEDIA, MES, MES_INVALIDO, MINIMO, MIN_PASSENGER, MIN_TOTAL_AMOUNT,
    NAO_NULOS, NEGATIVOS_OU_ZERO, NULOS, PASSENGER_COUNT_ACIMA_6, PASSENGER_COUNT_ZERO, PCT, PCT_NULOS,
    TIPO, TOTAL, TOTAL_AMOUNT_INVALIDO, TOTAL_CORRIDAS, TOTAL_LINHAS, QualitySpec
)


def _tag(df: DataFrame, **labels: str) -> DataFrame:
    """Prepend constant label columns (layer, feed, stage, ...)."""
    return df.select(*[F.lit(v).alias(k) for k, v in labels.items()], *df.columns)


def row_count(df: DataFrame, **labels: str) -> DataFrame:
    """A3: one row with the row count, as ``linhas``."""
    return _tag(df.agg(F.count(F.lit(1)).alias(LINHAS)), **labels)


def rows_per_month(df: DataFrame, year: int | None = None, first_month: int = 1, last_month: int = 12,
                   **labels: str) -> DataFrame:
    """A4 with F8: rows per partition month, restricted by a partition predicate
    (pruned at the scan of a partitioned table). Columns: labels, mes, linhas."""
    if year is not None:
        df = df.filter((F.col("partition_year") == year)
                       & F.col("partition_month").between(first_month, last_month))
    out = (df.groupBy("partition_year", "partition_month").agg(F.count(F.lit(1)).alias(LINHAS))
           .select(month_label("partition_year", "partition_month").alias(MES), LINHAS))
    return _tag(out, **labels)


def partition_counts(df: DataFrame, **labels: str) -> DataFrame:
    """A5: rows per (partition_year, partition_month), ordered."""
    out = (df.groupBy("partition_year", "partition_month")
           .agg(F.count(F.lit(1)).alias(TOTAL_LINHAS)))
    return _tag(out, **labels).orderBy("partition_year", "partition_month")


def null_profile(df: DataFrame, columns: list[str] | tuple[str, ...], **labels: str) -> DataFrame:
    """(coluna, total, nulos, pct_nulos) for the given columns in one pass."""
    counts = [F.count(F.col(c)).alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias(TOTAL), *counts)
    long = wide.unpivot(TOTAL, list(columns), COLUNA, NAO_NULOS)
    out = long.select(
        COLUNA,
        F.col(TOTAL).cast("long").alias(TOTAL),
        (F.col(TOTAL) - F.col(NAO_NULOS)).cast("long").alias(NULOS),
    ).withColumn(PCT_NULOS, pct_half_up(NULOS, TOTAL))
    return _tag(out, **labels)


def schema_profile(df: DataFrame, **labels: str) -> DataFrame:
    """(coluna, tipo, nulos, pct_nulos) for every column. NaN counts as null here."""
    prof = null_profile(df.select([F.nanvl(c, F.lit(None)).alias(c) if t in ("float", "double") else F.col(c) for c, t in df.dtypes]), df.columns)
    # The type of each column is schema metadata: a literal map lookup, no join.
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    out = prof.select(COLUNA, F.element_at(kinds, F.col(COLUNA)).alias(TIPO), NULOS, PCT_NULOS)
    return _tag(out, **labels)


def value_distribution(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """A9 + W1: (by?, value, total, pct) with pct = share of the total in percent.

    The window runs over the aggregated result (one row per distinct value),
    never over raw rows; without ``by`` the total is a scalar subquery, no window.
    """
    keys = [by, column] if by else [column]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(TOTAL))
    whole = F.sum(TOTAL).over(Window.partitionBy(by)) if by else df.agg(F.count(F.lit(1))).scalar()
    return counted.withColumn(PCT, pct_half_up(F.col(TOTAL), whole)).orderBy(*keys)


def amount_stats_by_month(df: DataFrame, amount: str = "total_amount") -> DataFrame:
    """A10: per file month (year, month) count, mean, min, max, stddev and the
    number of non-positive amounts."""
    return (
        df.groupBy(F.col("partition_year").alias("ano"), F.col("partition_month").alias(MES))
        .agg(
            F.count(F.lit(1)).alias(TOTAL_CORRIDAS),
            round2(F.avg(amount)).alias(MEDIA),
            round2(F.min(amount)).alias(MINIMO),
            round2(F.max(amount)).alias(MAXIMO),
            round2(F.stddev_samp(amount)).alias(DESVIO_PADRAO),
            F.count_if(F.col(amount) <= 0).alias(NEGATIVOS_OU_ZERO),
        )
        .orderBy("ano", MES)
    )


def gold_summary(gold: DataFrame) -> DataFrame:
    """Per (taxi_type, file year, file month) count, rounded means, min/max."""
    return (
        gold.groupBy("taxi_type", F.col("partition_year").alias("ano"), F.col("partition_month").alias(MES))
        .agg(
            F.count(F.lit(1)).alias(TOTAL_CORRIDAS),
            round2(F.avg("total_amount")).alias(AVG_TOTAL_AMOUNT),
            round2(F.avg("passenger_count")).alias(AVG_PASSENGER_COUNT),
            F.min("passenger_count").alias(MIN_PASSENGER),
            F.max("passenger_count").alias(MAX_PASSENGER),
            F.min("total_amount").alias(MIN_TOTAL_AMOUNT),
            F.max("total_amount").alias(MAX_TOTAL_AMOUNT),
        )
        .orderBy("taxi_type", "ano", MES)
    )


def audit_rules(q: QualitySpec, pickup: str = "tpep_pickup_datetime") -> dict[str, Column]:
    """A12 rules: the condition under which each Gold rule rejects a row."""
    p = F.col(pickup)
    return {
        TOTAL_AMOUNT_INVALIDO: F.col("total_amount") <= q.min_amount,
        PASSENGER_COUNT_ZERO: F.col("passenger_count") <= q.min_passengers,
        PASSENGER_COUNT_ACIMA_6: F.col("passenger_count") > q.max_passengers,
        ANO_INVALIDO: F.year(p) != q.year,
        MES_INVALIDO: ~F.month(p).between(q.first_month, q.last_month),
    }


def audit_counters(q: QualitySpec, pickup: str = "tpep_pickup_datetime", where: Column | None = None) -> list[Column]:
    """A12 counters: how many rows (optionally among ``where``) each rule rejects, plus the total."""
    scope = where if where is not None else F.lit(True)
    return [F.count_if(scope & cond).alias(name) for name, cond in audit_rules(q, pickup).items()] + [
        F.count_if(scope).alias(TOTAL)
    ]


def filter_audit(df: DataFrame, q: QualitySpec, **labels: str) -> DataFrame:
    """One row of rule-violation counts. On Silver it shows what Gold will
    drop; on Gold every counter but ``total`` must be 0."""
    return _tag(df.agg(*audit_counters(q)), **labels)


def filter_audit_stages(df: DataFrame, q: QualitySpec, kept: Column,
                        stages: tuple[str, str] = ("silver", "gold")) -> DataFrame:
    """A12 for a table and its filtered subset (rows where ``kept``) in ONE scan:
    two rows (stage, counters...). Used when the Gold rows are Silver rows that
    pass the quality predicate, so Gold need not be read separately."""
    names = list(audit_rules(q)) + [TOTAL]
    whole = audit_counters(q)
    subset = [c.alias(f"_k_{n}") for c, n in zip(audit_counters(q, where=kept), names)]
    wide = df.agg(*whole, *subset)
    rows = F.array(
        F.struct(F.lit(stages[0]).alias("stage"), *[F.col(n).alias(n) for n in names]),
        F.struct(F.lit(stages[1]).alias("stage"), *[F.col(f"_k_{n}").alias(n) for n in names]),
    )
    return wide.select(F.inline(rows))


def sample_partition(df: DataFrame, year: int, month: int, n: int = 5) -> DataFrame:
    """O3: ``n`` rows of one partition. The partition predicate prunes the scan;
    the order by every column makes the sample repeatable (top-k per task, then
    one small merge)."""
    part = df.filter((F.col("partition_year") == year) & (F.col("partition_month") == month))
    return part.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)
