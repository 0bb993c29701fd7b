"""Schema comparison (C1-C4) and expected-month checks.

Schemas are metadata: the frames built here have one row per column or month,
never per data row. Where a check also needs the data (non-null counts,
observed months) it is one aggregate scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.columns import month_label
from tripflow.specs import AUSENTE, COLUNA, MES, NAO_NULOS, PRESENTE, TIPO, FeedSpec

ABSENT = AUSENTE


def schema_frame(spark: SparkSession, schema: T.StructType, **labels: str) -> DataFrame:
    """(labels..., coluna, tipo) for a schema."""
    names = list(labels)
    rows = [tuple(labels.values()) + (f.name, f.dataType.simpleString()) for f in schema.fields]
    ddl = ", ".join([f"{n} string" for n in names] + [f"{COLUNA} string", f"{TIPO} string"])
    return spark.createDataFrame(rows, ddl)


def schema_drift(spark: SparkSession, month_schemas: dict[str, T.StructType], feed: str) -> DataFrame:
    """Columns whose type differs between months (``AUSENTE`` = absent).

    Long (feed, coluna, mes, tipo) -> pivot on the known months -> keep columns
    with more than one distinct value. Column names are compared as given (a
    case change is a different column, as in the source files).
    """
    months = sorted(month_schemas)
    parts = [schema_frame(spark, s, feed=feed, mes=m) for m, s in month_schemas.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    wide = long.groupBy("feed", COLUNA).pivot(MES, months).agg(F.first(TIPO))
    wide = wide.fillna(ABSENT, subset=months)
    n_distinct = F.size(F.array_distinct(F.array(*[F.col(f"`{m}`") for m in months])))
    return wide.filter(n_distinct > 1).orderBy("feed", COLUNA)


def column_comparison(spark: SparkSession, columns: dict[str, list[str]]) -> DataFrame:
    """Presence matrix of column names across feeds (union of all names,
    one boolean column per feed); names only in one feed show the difference,
    names true everywhere the intersection."""
    feeds = list(columns)
    allnames = sorted(set().union(*[set(c) for c in columns.values()]))
    rows = [(n, *[n in set(columns[f]) for f in feeds]) for n in allnames]
    ddl = f"{COLUNA} string, " + ", ".join(f"`{f}` boolean" for f in feeds)
    return spark.createDataFrame(rows, ddl)


def required_columns(raw: DataFrame, spec: FeedSpec, feed: str | None = None) -> DataFrame:
    """Is every required source column present, with which type, and how
    many non-null values does it hold? One aggregate scan of the feed; the
    metadata columns are literals, so no join is needed."""
    kinds = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    present = [c for c in spec.raw_required if c in kinds]
    # A global aggregate always yields exactly one row, even on an empty input.
    wide = raw.agg(*[F.count(F.col(c)).alias(c) for c in present] or [F.count(F.lit(1)).alias("_rows")])
    rows = F.array(*[
        F.struct(
            F.lit(feed or spec.tag).alias("feed"),
            F.lit(c).alias(COLUNA),
            F.lit(c in kinds).alias(PRESENTE),
            F.lit(kinds.get(c, "N/A")).alias(TIPO),
            (F.col(c) if c in kinds else F.lit(0)).cast("long").alias(NAO_NULOS),
        )
        for c in spec.raw_required
    ])
    return wide.select(F.inline(rows))


def lowercase_check(spark: SparkSession, schema: T.StructType, table: str) -> DataFrame:
    """C4: (tabela, coluna, tipo, minusculo) for every column of a table."""
    return schema_frame(spark, schema, tabela=table).withColumn(
        "minusculo", F.col(COLUNA) == F.lower(F.col(COLUNA))
    )


def missing_months(df: DataFrame, spec: FeedSpec, feed: str | None = None) -> DataFrame:
    """Expected months of the spec with no row in ``df`` -> (feed, mes).

    Observed months are reduced to distinct labels inside the expected range
    first (partial aggregation per task), so the right side is bounded by the
    number of expected months; AQE broadcasts it once its measured size is
    under the broadcast threshold and keeps a sort-merge join otherwise.
    """
    spark = df.sparkSession
    (fy, fm), (ly, lm) = (tuple(int(p) for p in spec.months[i].split("-")) for i in (0, -1))
    expected = spark.createDataFrame([(m,) for m in spec.months], f"{MES} string")
    ym = F.col("partition_year") * 100 + F.col("partition_month")
    observed = (
        df.select("partition_year", "partition_month")
        .filter(ym.between(fy * 100 + fm, ly * 100 + lm))
        .distinct()  # integers first: the label is built once per month, not per row
        .select(month_label("partition_year", "partition_month").alias(MES))
    )
    return expected.join(observed, MES, "left_anti").select(
        F.lit(feed or spec.tag).alias("feed"), MES
    )
