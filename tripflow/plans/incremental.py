"""Replaced months carried through the layers, and result tables kept as mergeable states.

A stored layer's states (:mod:`tripflow.operators.partials`) lie in a table beside it, partitioned like the layer. Each state
row names the state of the partition it was made from: files, bytes and a hash of (path, bytes, time). :func:`refresh`
recomputes the partitions that have another state now; :func:`current_states` reads only rows whose partition is still
as they name it, so states of replaced or removed partitions never count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators import partials
from tripflow.operators.consolidate import consolidate
from tripflow.operators.standardize import to_silver
from tripflow.plans.medallion import GOLD_TABLE, HOURLY_TABLE, MONTHLY_TABLE, Lake, _feed_table, read_layer
from tripflow.session import filesystem
from tripflow.sources import catalog
from tripflow.sources.landing import month_parts
from tripflow.sources.sinks import publish_result, replace_months
from tripflow.specs import PARTITION_COLUMNS, FeedSpec, QualitySpec

MADE_FROM = "made_from"


def partition_states(spark: SparkSession, path: str) -> DataFrame:
    """(partition columns, folder, made_from) of every partition with files, from a listing; no content is read."""
    files = spark.read.format("binaryFile").load(path).select(*PARTITION_COLUMNS, "path", "length", "modificationTime")
    token = F.concat_ws("/", F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime"))))
    return files.groupBy(*PARTITION_COLUMNS).agg(F.min(F.regexp_replace("path", "/[^/]*$", "")).alias("folder"), token.alias(MADE_FROM))


def _same(a: DataFrame, b: DataFrame, columns: tuple[str, ...]):
    cond = F.lit(True)
    for c in columns:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def refresh(spark: SparkSession, path: str, states_path: str, pickup: str) -> int:
    """Bring the states at ``states_path`` up to the layer at ``path``; returns how many partitions were read."""
    now = partition_states(spark, path)
    fs, committed = filesystem(spark, f"{states_path}/{PARTITION_COLUMNS[0]}=*")  # a dynamic overwrite leaves no _SUCCESS
    if fs.globStatus(committed):
        held = spark.read.parquet(states_path).select(*PARTITION_COLUMNS, MADE_FROM).distinct()
        now = now.join(held, _same(now, held, (*PARTITION_COLUMNS, MADE_FROM)), "left_anti")
    changed = now.collect()  # one row a partition
    if not changed:
        return 0
    rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*[r.folder for r in changed])
    made = partials.states(partials.trip_groups(rows, pickup), [*PARTITION_COLUMNS, *partials.TRIP_GROUPS])
    named = spark.createDataFrame([(r[0], r[1], r[MADE_FROM]) for r in changed], f"_y int, _m int, {MADE_FROM} string")
    made = made.join(named, F.col("partition_year").eqNullSafe(F.col("_y")) & F.col("partition_month").eqNullSafe(F.col("_m"))).drop("_y", "_m")
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS).parquet(states_path)
    return len(changed)


def current_states(spark: SparkSession, path: str, states_path: str) -> DataFrame:
    """The states whose partition of ``path`` is what they were made from."""
    held, now = spark.read.parquet(states_path), partition_states(spark, path)
    return held.join(now, _same(held, now, (*PARTITION_COLUMNS, MADE_FROM)), "left_semi").drop(MADE_FROM)


def states_path(lake: Lake, layer: str, name: str) -> str:
    return f"{lake.root.rstrip('/')}/_states/{layer}/{name}"


def silver_states(spark: SparkSession, lake: Lake, spec: FeedSpec) -> DataFrame:
    """States of one feed's stored Silver, brought up to date."""
    path, at = lake.path("silver", _feed_table(spec)), states_path(lake, "silver", _feed_table(spec))
    refresh(spark, path, at, "pickup_datetime")
    return current_states(spark, path, at)


def gold_states(spark: SparkSession, lake: Lake) -> DataFrame:
    """States of the stored Gold, brought up to date."""
    path, at = lake.path("gold", GOLD_TABLE), states_path(lake, "gold", GOLD_TABLE)
    refresh(spark, path, at, "tpep_pickup_datetime")
    return current_states(spark, path, at)


def _of_months(df: DataFrame, months: list[str]) -> DataFrame:
    """Rows of the file months, by a predicate that prunes partitions."""
    wanted = F.lit(False)
    for year, month in map(month_parts, months):
        wanted = wanted | ((F.col("partition_year") == year) & (F.col("partition_month") == month))
    return df.where(wanted)


def carry_months(spark: SparkSession, specs: list[FeedSpec], lake: Lake, q: QualitySpec, months: list[str]) -> dict[str, int]:
    """Silver, Gold and the results after ``months`` ('YYYY-MM', file months) were replaced in Bronze.

    Only these partitions of Bronze and Silver are read and only they are replaced in Silver and Gold; a month that
    is left without rows loses its partition. The results come from the states. Returns rows per layer written."""
    lake.create_databases(spark)
    if not months:
        return {"silver": 0, "gold": 0}

    def registered(layer: str, name: str, ddl: str) -> None:
        table = lake.table(layer, name)
        catalog.create_table(spark, table, ddl, lake.path(layer, name), catalog.PARTITION_DDL)
        catalog.recover_partitions(spark, table)
        spark.catalog.refreshTable(table)

    out = {"silver": 0}
    for spec in specs:
        name = _feed_table(spec)
        if spark.catalog.tableExists(lake.table("bronze", name)):
            spark.catalog.refreshTable(lake.table("bronze", name))
        bronze = _of_months(read_layer(spark, lake, "bronze", name), months)
        rows = replace_months(to_silver(bronze, spec), lake.path("silver", name), months, sort_within=("pickup_datetime",))
        out["silver"] += sum(rows.values())
        registered("silver", name, catalog.SILVER_DDL)
    silvers = [_of_months(read_layer(spark, lake, "silver", _feed_table(s)), months) for s in specs]
    gold = replace_months(consolidate(silvers, q), lake.path("gold", GOLD_TABLE), months, sort_within=("tpep_pickup_datetime",))
    registered("gold", GOLD_TABLE, catalog.GOLD_DDL)
    publish_from_states(spark, lake, q)
    return {**out, "gold": sum(gold.values())}


def publish_from_states(spark: SparkSession, lake: Lake, q: QualitySpec) -> None:
    """Both result tables from the states of Gold."""
    parts = gold_states(spark, lake)
    for name, ddl, result in ((MONTHLY_TABLE, catalog.MONTHLY_DDL, partials.avg_amount_by_month(parts, q.monthly_tag)),
                              (HOURLY_TABLE, catalog.HOURLY_DDL, partials.avg_passengers_by_hour(parts, q))):
        _, at = publish_result(result, lake.path("gold", name))
        catalog.publish(spark, lake.table("gold", name), ddl, at)
