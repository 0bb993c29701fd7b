"""The on-disk medallion run (J1-J6): Bronze -> register -> Silver -> Gold -> results.

Each stage reads the previous stage's table, writes its own and registers it in
the catalog; written tables cut the lineage between stages, so a lost executor
only recomputes from the last written table. Stages are plain functions; the
order in :func:`run_all` is the only orchestration.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.aggregates import avg_amount_by_month, avg_passengers_by_hour
from tripflow.operators.consolidate import consolidate
from tripflow.operators.ingest import quarantine, to_bronze
from tripflow.operators.standardize import to_silver
from tripflow.plans.manifest import Manifest, fingerprint, frame_fingerprint
from tripflow.sources import catalog
from tripflow.sources.landing import (
    READ_ERRORS, STATUS_SCHEMA, LandedFile, delivered, expected_months, list_landing, month_groups, month_parts, read_months, unified_types, united, unusable_months,
)
from tripflow.sources.sinks import current_version, publish_result, replace_months, write_months, write_part, write_partitioned
from tripflow.specs import PARTITION_COLUMNS, FeedSpec, QualitySpec


@dataclass(frozen=True)
class Lake:
    """Where the layers live: ``{root}/{layer}/{table}`` plus one database per layer."""

    root: str
    bronze_db: str = "trip_bronze"
    silver_db: str = "trip_silver"
    gold_db: str = "trip_gold"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer + '_db')}.{name}"

    def create_databases(self, spark: SparkSession) -> None:
        """The databases, located below the lake's root and not in a local warehouse folder."""
        catalog.create_databases(spark, (self.bronze_db, self.silver_db, self.gold_db), self.root)


# Tables of the Gold layer.
GOLD_TABLE, MONTHLY_TABLE, HOURLY_TABLE = "all_trips", "avg_total_amount", "avg_passengers"


def _feed_table(spec: FeedSpec) -> str:
    return f"{spec.tag}_trips"


def read_layer(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame:
    """S6 with a path fallback: the catalog table when this session's catalog
    knows it (same job, or a persistent metastore), else the layer's folder (a
    separate job launched without a shared catalog)."""
    table = lake.table(layer, name)
    if spark.catalog.databaseExists(table.split(".")[0]) and spark.catalog.tableExists(table):
        return catalog.read_table(spark, table)
    # Months may differ in columns the spec does not know: merge the footers.
    return spark.read.option("mergeSchema", "true").parquet(current_version(spark, lake.path(layer, name)))


# --- J1: Bronze ---------------------------------------------------------------
def ingest_bronze(spark: SparkSession, raw: DataFrame, spec: FeedSpec, lake: Lake, cast: str = "value") -> int:
    """Raw feed -> Bronze table. Only the months present in ``raw`` are replaced
    (dynamic overwrite), so re-running one month is idempotent. The input is not
    clustered by month, so the write rebalances by partition (hot months split).
    With ``cast="column"`` a Bronze table that holds such a column in another type raises
    before anything is written, as one Parquet table cannot hold both."""
    lake.create_databases(spark)
    path = lake.path("bronze", _feed_table(spec))
    bronze = to_bronze(raw, spec, cast)
    table = lake.table("bronze", _feed_table(spec))
    if cast == "column" and spark.catalog.tableExists(table):
        held = dict(spark.table(table).dtypes)
        other = sorted(c for c, t in bronze.dtypes if held.get(c, t) != t)
        if other:
            raise ValueError(f"{table} holds {other} in other types")
    rows = write_partitioned(bronze, path, overwrite="dynamic", layout="rebalance", name=f"bronze_{spec.tag}")
    catalog.register_discovered(spark, table, path, schema=bronze.schema)
    return rows


def quarantine_path(lake: Lake, spec: FeedSpec) -> str:
    return lake.path("bronze", f"{spec.tag}_quarantine")


def quarantine_months(spark: SparkSession, spec: FeedSpec, files: list[LandedFile], lake: Lake, months: list[str]) -> int:
    """Values that the soft cast of these landed months cannot read, as partitions of the feed's quarantine folder;
    each month's are replaced as a whole, also by none. Months in the spec's own types are not read. Returns the values."""
    reads = read_months(spark, [f for f in files if f.month in months], {})
    total = 0
    for alike, df in month_groups(spark, spec, reads, delivered):
        total += sum(replace_months(quarantine(df, spec), quarantine_path(lake, spec), alike).values())
    return total


def ingest_bronze_from_landing(spark: SparkSession, spec: FeedSpec, landing_root: str, lake: Lake,
                               months: tuple[str, ...] | None = None, strict: bool = False, keep_failed: bool = False) -> DataFrame:
    """Landing files -> Bronze table; returns the per-month status frame (A13) as it was written.

    ``months`` names the months to load, and no others are touched; None means every month of the
    spec and every month that landed. Months of one schema are written by one job; if that fails, each of them by a job of
    its own. So a month that is missing, empty, unreadable or fails while it is read does not stop
    the others (``strict=True`` raises before anything is written if one cannot be read). Rows are
    counted as they are written. Columns unknown to the spec go to Bronze with the type
    they already have there. ``keep_failed`` also writes the values that the soft cast made null
    (:func:`quarantine_months`) of the months that loaded."""
    lake.create_databases(spark)
    files = list_landing(spark, landing_root, spec.prefix)
    table, path = lake.table("bronze", _feed_table(spec)), lake.path("bronze", _feed_table(spec))
    held = dict(spark.table(table).dtypes) if spark.catalog.tableExists(table) else {}
    rows, schema = load_months(spark, spec, files, path, held, months, strict)
    if schema is not None:
        done = [dict(zip(PARTITION_COLUMNS, month_parts(m))) for _, m, status, _, _ in rows if status == "ok"]
        catalog.register_discovered(spark, table, path, schema=schema, written=done)
    if keep_failed:
        quarantine_months(spark, spec, files, lake, [m for _, m, status, _, _ in rows if status == "ok"])
    return spark.createDataFrame(rows, STATUS_SCHEMA).orderBy("mes")


def load_months(spark: SparkSession, spec: FeedSpec, files: list[LandedFile], path: str, held: dict[str, str],
                months: tuple[str, ...] | None = None, strict: bool = False) -> tuple[list[tuple], T.StructType | None]:
    """Landed months -> partitions of the Bronze folder ``path``, each replaced as a whole: what batch and stream share.

    ``held`` are the column types that Bronze has. Returns the status rows and, if a month was written, Bronze's schema."""
    wanted = expected_months(spec, files, months)
    errors: dict[str, str] = {}
    reads = read_months(spark, [f for f in files if f.month in wanted], errors)
    groups = month_groups(spark, spec, reads)
    bad = unusable_months(spec, files, wanted, errors, spec.tag)
    if strict and bad:
        raise ValueError("incomplete landing: " + ", ".join(f"{spec.tag}/{m}:{status}" for m, (status, _) in sorted(bad.items())))
    kinds = unified_types([df.drop(*PARTITION_COLUMNS).schema for _, df in groups], {**held, **dict(spec.bronze_types)})
    written: list[tuple[str, str, int, str | None]] = []
    for months_alike, df in groups:
        df = df.select([F.col(c).try_cast(kinds[c]).alias(c) if kinds.get(c, t) != t else F.col(c) for c, t in df.dtypes])
        try:
            rows_of = write_months(df, path, months_alike)
        except READ_ERRORS:  # one of these months: write each by itself
            rows_of = {}
        for month in months_alike:
            year, mon = month_parts(month)
            try:
                if month not in rows_of:  # not written yet: replaced only on commit, so a failure keeps its old rows
                    own = df if len(months_alike) == 1 else united([month_groups(spark, spec, {month: reads[month]})[0][1]], kinds)
                    rows_of.update(write_months(own, path, [month]))
                if not rows_of[month]:  # read well and without rows: its old rows must go
                    write_part(df.drop(*PARTITION_COLUMNS).limit(0), f"{path}/partition_year={year}/partition_month={mon}")
                written.append((month, "ok", rows_of[month], None))
            except READ_ERRORS as exc:
                written.append((month, "error", 0, f"unreadable: {str(exc).strip().splitlines()[0][:300]}"))
    rows = [(spec.tag, m, status, 0, reason) for m, (status, reason) in bad.items()]
    rows += [(spec.tag, m, status, n, reason) for m, status, n, reason in written]
    if not any(status == "ok" for _, status, _, _ in written):
        return rows, None
    return rows, T.StructType([T.StructField(c, T._parse_datatype_string(k)) for c, k in {**kinds, **dict.fromkeys(PARTITION_COLUMNS, "int")}.items()])


# --- J2: Silver ---------------------------------------------------------------
def standardize_silver(spark: SparkSession, spec: FeedSpec, lake: Lake) -> int:
    """Bronze table -> Silver table (static overwrite). Map-only: every scan task
    reads one Bronze partition and writes that partition's file, sorted by pickup
    time so range filters downstream skip row groups."""
    lake.create_databases(spark)
    bronze = read_layer(spark, lake, "bronze", _feed_table(spec))
    path = lake.path("silver", _feed_table(spec))
    rows = write_partitioned(to_silver(bronze, spec), path, overwrite="static", layout="preserve",
                             sort_within=("pickup_datetime",), name=f"silver_{spec.tag}")
    table = lake.table("silver", _feed_table(spec))
    catalog.create_table(spark, table, catalog.SILVER_DDL, path, catalog.PARTITION_DDL)
    catalog.recover_partitions(spark, table)
    return rows


# --- J3: Gold -------------------------------------------------------------------
def consolidate_gold(spark: SparkSession, specs: list[FeedSpec], lake: Lake, q: QualitySpec) -> int:
    """Silver tables -> Gold table. The pickup window reaches both Silver scans as
    a pushed range filter (row groups outside it are skipped)."""
    lake.create_databases(spark)
    silvers = [read_layer(spark, lake, "silver", _feed_table(s)) for s in specs]
    path = lake.path("gold", GOLD_TABLE)
    rows = write_partitioned(consolidate(silvers, q), path, overwrite="static", layout="preserve",
                             sort_within=("tpep_pickup_datetime",), name="gold_all")
    table = lake.table("gold", GOLD_TABLE)
    catalog.create_table(spark, table, catalog.GOLD_DDL, path, catalog.PARTITION_DDL)
    catalog.recover_partitions(spark, table)
    return rows


# --- J4, J5: results ------------------------------------------------------------
def monthly_result(spark: SparkSession, lake: Lake, q: QualitySpec) -> int:
    lake.create_databases(spark)
    gold = read_layer(spark, lake, "gold", GOLD_TABLE)
    rows, at = publish_result(avg_amount_by_month(gold, q.monthly_tag), lake.path("gold", MONTHLY_TABLE))
    catalog.publish(spark, lake.table("gold", MONTHLY_TABLE), catalog.MONTHLY_DDL, at)
    return rows


def hourly_result(spark: SparkSession, lake: Lake, q: QualitySpec, must_hold: bool = False) -> int:
    """``must_hold``: a stored Gold without rows in the month raises, and the result stays as it is."""
    lake.create_databases(spark)
    gold = read_layer(spark, lake, "gold", GOLD_TABLE)
    hours = avg_passengers_by_hour(gold, q)
    if must_hold and hours.isEmpty():
        raise ValueError(f"the stored Gold holds no trips of {q.year}-{q.hourly_month:02d}")
    rows, at = publish_result(hours, lake.path("gold", HOURLY_TABLE))
    catalog.publish(spark, lake.table("gold", HOURLY_TABLE), catalog.HOURLY_DDL, at)
    return rows


def register_stored(spark: SparkSession, lake: Lake, stage: str, name: str, location: str) -> None:
    """Make the table of a finished stage known to this catalog, if it is not."""
    layer = stage if stage in ("bronze", "silver") else "gold"
    table = lake.table(layer, name)
    if spark.catalog.tableExists(table):
        return
    if stage == "bronze":
        catalog.register_discovered(spark, table, location)
    elif stage in ("silver", "gold"):
        catalog.create_table(spark, table, catalog.SILVER_DDL if stage == "silver" else catalog.GOLD_DDL, location, catalog.PARTITION_DDL)
        catalog.recover_partitions(spark, table)
    else:
        catalog.publish(spark, table, catalog.MONTHLY_DDL if name == MONTHLY_TABLE else catalog.HOURLY_DDL, location)


# --- J6: everything in order --------------------------------------------------
def run_all(spark: SparkSession, raws: dict[str, DataFrame | str], specs: dict[str, FeedSpec], lake: Lake,
            q: QualitySpec, parallel: bool = True, on_status=None,
            strict: bool = False, resume: bool = False) -> DataFrame:
    """Bronze (per feed) -> Silver (per feed) -> Gold -> monthly and hourly results.

    Within a layer the feeds are independent, so with ``parallel`` their jobs are
    submitted together from driver threads and share the executors (the layers
    themselves run in order). A feed is a frame, or the folder in which its months land.
    Returns (stage, feed, rows, seconds) per stage.

    With ``resume`` a stage that the manifest has as finished from the same input and parameters, and whose output
    is untouched, is skipped (its rows are the manifest's, its seconds 0); its table is registered if this catalog
    does not know it. A run that died after Silver so starts at Gold. Every run writes the manifest.
    """
    lake.create_databases(spark)
    manifest = Manifest(spark, lake.root)
    log: list[tuple[str, str, int, float]] = []

    def timed(stage: str, feed: str, fn, table: str, inputs, location) -> tuple[str, str, int, float]:
        """Run ``fn`` unless it is done. ``inputs()`` is the fingerprint of what it reads, ``location()`` the folder it leaves."""
        t0 = time.perf_counter()
        made_from = inputs()
        held = manifest.done(stage, feed, made_from) if resume else None
        if held is not None and held.location == location():
            register_stored(spark, lake, stage, table, held.location)
            return stage, feed, held.rows, 0.0
        rows = fn()
        manifest.finish(stage, feed, made_from, location(), int(rows))
        return stage, feed, int(rows), round(time.perf_counter() - t0, 3)

    def layer(steps: list[tuple[str, str, object]]) -> None:
        if parallel and len(steps) > 1:
            with ThreadPoolExecutor(max_workers=len(steps)) as pool:
                log.extend(pool.map(lambda s: timed(*s), steps))
        else:
            log.extend(timed(*s) for s in steps)

    def bronze(tag: str) -> int:
        if not isinstance(raws[tag], str):
            return ingest_bronze(spark, raws[tag], specs[tag], lake)
        status = ingest_bronze_from_landing(spark, specs[tag], raws[tag], lake, strict=strict)
        if on_status is not None:
            on_status(status)
        return status.agg(F.coalesce(F.sum("linhas"), F.lit(0))).first()[0]

    def raw_state(tag: str) -> str:
        if not isinstance(raws[tag], str):
            return frame_fingerprint(spark, raws[tag], specs[tag])
        files = list_landing(spark, raws[tag], specs[tag].prefix)
        return fingerprint(spark, [f.path for f in files], specs[tag], sorted(f.path for f in files), strict)

    def folder(layer_name: str, name: str):
        return lambda: lake.path(layer_name, name)

    feeds = [(tag, _feed_table(specs[tag])) for tag in raws]
    layer([("bronze", tag, lambda tag=tag: bronze(tag), name, lambda tag=tag: raw_state(tag), folder("bronze", name)) for tag, name in feeds])
    layer([("silver", tag, lambda tag=tag: standardize_silver(spark, specs[tag], lake), name,
            lambda tag=tag, name=name: fingerprint(spark, [lake.path("bronze", name)], specs[tag]), folder("silver", name)) for tag, name in feeds])
    layer([("gold", "all", lambda: consolidate_gold(spark, [specs[t] for t in raws], lake, q), GOLD_TABLE,
            lambda: fingerprint(spark, [lake.path("silver", name) for _, name in feeds], q), folder("gold", GOLD_TABLE))])

    def result(stage: str, feed: str, fn, name: str):
        return (stage, feed, lambda: fn(spark, lake, q), name, lambda: fingerprint(spark, [lake.path("gold", GOLD_TABLE)], q, stage),
                lambda: current_version(spark, lake.path("gold", name)))

    layer([result("avg_total_amount", q.monthly_tag, monthly_result, MONTHLY_TABLE), result("avg_passengers", "all", hourly_result, HOURLY_TABLE)])
    return spark.createDataFrame(log, "stage string, feed string, rows long, seconds double").select(
        "stage", "feed", "rows", F.col("seconds")
    )
