"""Bronze: lower-case names (P1), schema-driven soft cast (P2), partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.specs import COLUNA, FALHAS, PARTITION_COLUMNS, TIPO, FeedSpec


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower case; two names that collide are an error
    (Spark would otherwise treat them as one ambiguous column)."""
    lowered = [c.lower() for c in df.columns]
    seen: dict[str, str] = {}
    for original, low in zip(df.columns, lowered):
        if low in seen:
            raise ValueError(f"columns {seen[low]!r} and {original!r} collide after lower-casing")
        seen[low] = original
    return df.toDF(*lowered)


def rename_report(spark: SparkSession, df: DataFrame, feed: str) -> DataFrame:
    """(feed, original, renamed) for every column that lower-casing changes.

    Built from the schema alone (a handful of rows), never from the data."""
    rows = [(feed, c, c.lower()) for c in df.columns if c != c.lower()]
    schema = "feed string, original string, renamed string"
    return spark.createDataFrame(rows, schema)


def _present(df: DataFrame, spec: FeedSpec) -> list[tuple[str, str]]:
    cols = set(df.columns)
    return [(name, kind) for name, kind in spec.bronze_types if name in cols]


def soft_cast(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Cast the spec's columns that exist; unknown columns pass through.

    ``try_cast`` turns an unreadable value into null instead of failing the job
    (bad rows then fall to the Silver null filter); the failures are counted by
    :func:`cast_failures` in the same kind of single pass.
    """
    kinds = dict(_present(df, spec))
    return df.select(
        [F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns]
    )


def cast_failures(df: DataFrame, spec: FeedSpec, feed: str | None = None) -> DataFrame:
    """(feed, coluna, falhas): values present in the input that the cast cannot read.

    One scan, one global aggregate of N counters, then an unpivot of one row.
    Expects lower-cased input.
    """
    present = _present(df, spec)
    if not present:
        return df.sparkSession.createDataFrame([], f"feed string, {COLUNA} string, {FALHAS} long")
    counters = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c) for c, kind in present
    ]
    wide = df.agg(*counters).withColumn("feed", F.lit(feed or spec.tag))
    return wide.unpivot("feed", [c for c, _ in present], COLUNA, FALHAS).select(
        "feed", COLUNA, F.col(FALHAS).cast("long").alias(FALHAS)
    )


def _checkable(df: DataFrame, spec: FeedSpec) -> list[tuple[str, str]]:
    """Columns of the spec that are not delivered in its type; the cast of any other cannot fail."""
    held = dict(df.dtypes)
    return [(c, kind) for c, kind in _present(df, spec) if held[c] != kind]


def _fails(column: str, kind: str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()


def uncastable_columns(df: DataFrame, spec: FeedSpec) -> list[str]:
    """Columns of which at least one value cannot be read in the spec's type (one scan, one row)."""
    check = _checkable(df, spec)
    if not check:
        return []
    found = df.agg(*[F.coalesce(F.bool_or(_fails(c, kind)), F.lit(False)).alias(c) for c, kind in check]).first()
    return [c for c, _ in check if found[c]]


def column_cast(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """P2 by column: a column is cast if every value of it can be, else it stays as delivered.

    Two phases: the failures of all columns decide its plan, then the rows are cast. ``df`` is
    what one decision covers: a month, to decide by month. Expects lower-cased input."""
    kept = set(uncastable_columns(df, spec))
    kinds = {c: kind for c, kind in _present(df, spec) if c not in kept}
    return df.select([F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


QUARANTINE_SCHEMA = f"feed string, {COLUNA} string, {TIPO} string, valor string, linha string, partition_year int, partition_month int"


def quarantine(df: DataFrame, spec: FeedSpec, feed: str | None = None) -> DataFrame:
    """One row per value that the soft cast cannot read: the column, the type asked for, the value as text, the whole
    row as delivered (JSON) and its file month (null if ``df`` has none). Expects lower-cased input.

    Rows without failures are filtered out before anything is made of them; no shuffle."""
    check = _checkable(df, spec)
    if not check:
        return df.sparkSession.createDataFrame([], QUARANTINE_SCHEMA)
    some = F.lit(False)
    for c, kind in check:
        some = some | _fails(c, kind)
    failed = F.array(*[F.when(_fails(c, kind), F.struct(F.lit(c).alias(COLUNA), F.lit(kind).alias(TIPO), F.col(c).cast("string").alias("valor")))
                       for c, kind in check])
    month = [(F.col(c) if c in df.columns else F.lit(None)).cast("int").alias(c) for c in PARTITION_COLUMNS]
    whole = F.to_json(F.struct(*df.columns))
    return (df.where(some).select(F.explode(F.array_compact(failed)).alias("f"), whole.alias("linha"), *month)
            .select(F.lit(feed or spec.tag).alias("feed"), "f.*", "linha", *PARTITION_COLUMNS))


def with_partition_columns(df: DataFrame) -> DataFrame:
    """Partition values as int (they come from the file month, not the pickup)."""
    return df.select(
        [F.col(c).cast("int").alias(c) if c in PARTITION_COLUMNS else F.col(c) for c in df.columns]
    )


def to_bronze(raw: DataFrame, spec: FeedSpec, cast: str = "value") -> DataFrame:
    """Raw feed -> Bronze: lower-case, soft cast, int partition columns.

    ``cast``: "value" makes an unreadable value null, "column" leaves a column that holds one as delivered."""
    if cast not in ("value", "column"):
        raise ValueError(f"cast must be value or column, not {cast!r}")
    by = soft_cast if cast == "value" else column_cast
    return with_partition_columns(by(lowercase_columns(raw), spec))

