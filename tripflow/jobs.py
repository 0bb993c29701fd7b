"""Command-line entry points: one job per medallion stage, as a scheduler runs them.

    spark-submit tripflow/jobs.py bronze --feed yellow --landing <dir> --lake <dir>
    spark-submit tripflow/jobs.py silver --feed yellow --lake <dir>
    spark-submit tripflow/jobs.py gold --lake <dir>
    spark-submit tripflow/jobs.py monthly --lake <dir>
    spark-submit tripflow/jobs.py hourly --lake <dir>
    spark-submit tripflow/jobs.py all --landing <dir> --lake <dir>
    spark-submit tripflow/jobs.py audit --layer {source,bronze,silver,gold} [--landing <dir>] --lake <dir>

``audit`` runs the exploratory checks of one layer (availability, volumes,
drift, nulls, distributions, statistics, filter audit, samples) and prints
their small result tables.

Quality window and months come from flags (defaults: the reference's 2023,
months 1-5). Every job prints one status line per stage and exits non-zero on
failure; ``--strict`` also fails the Bronze job when a month is missing or empty.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripflow.operators import profile, schema_audit  # noqa: E402
from tripflow.plans import medallion  # noqa: E402
from tripflow.session import build_session, cluster_conf  # noqa: E402
from tripflow.sources import landing  # noqa: E402
from tripflow.sources.landing import ingest_tally  # noqa: E402
from tripflow.specs import GREEN, SILVER_REQUIRED, YELLOW, QualitySpec, month_range  # noqa: E402

FEEDS = {"yellow": YELLOW, "green": GREEN}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tripflow.jobs")
    p.add_argument("stage", choices=["bronze", "silver", "gold", "monthly", "hourly", "all", "audit"])
    p.add_argument("--layer", choices=["source", "bronze", "silver", "gold"], default="gold")
    p.add_argument("--feed", choices=sorted(FEEDS), action="append")
    p.add_argument("--landing", help="landing root; feed files under <landing>/<prefix>_YYYY-MM.parquet")
    p.add_argument("--lake", required=True)
    p.add_argument("--first-month", default="2023-01")
    p.add_argument("--last-month", default="2023-05")
    p.add_argument("--year", type=int, default=2023)
    p.add_argument("--window-first", type=int, default=1)
    p.add_argument("--window-last", type=int, default=5)
    p.add_argument("--hourly-month", type=int, default=5)
    p.add_argument("--strict", action="store_true")
    p.add_argument("--resume", action="store_true", help="all: skip stages that the run manifest has as finished from the same input")
    p.add_argument("--cores", type=int, help="total executor cores (sizes shuffle partitions)")
    p.add_argument("--master", help="e.g. local[8]; omit under spark-submit")
    return p


def _show(title: str, df) -> None:
    """Print a whole audit table, a partition at a time."""
    print(f"== {title}")
    print(" | ".join(df.columns))
    for row in df.toLocalIterator():
        print(" | ".join("" if v is None else str(v) for v in row))


def audit(spark, layer: str, specs, lake: medallion.Lake, q: QualitySpec, landing_root: str | None) -> None:
    """The exploratory checks of one layer, as small printed tables."""
    if layer == "source":
        if not landing_root:
            raise SystemExit("--landing is required for the source audit")
        columns = {}
        for spec in specs:
            files = landing.list_landing(spark, landing_root, spec.prefix)
            _show(f"{spec.tag}: month status", landing.month_status(spark, spec, landing_root, files=files))
            _show(f"{spec.tag}: volume", landing.file_volume(spark, spec, landing_root, files=files))
            scans = landing.month_scans(spark, files, {})
            if scans:
                _show(f"{spec.tag}: schema drift", schema_audit.schema_drift(spark, {m: df.schema for m, df in scans.items()}, spec.tag))
                # All months, as they were delivered: a column counts if any month has it.
                columns[spec.tag] = sorted({f.name for df in scans.values() for f in df.schema.fields})
                for month, raw in sorted(scans.items()):
                    _show(f"{spec.tag}: schema profile {month}", profile.schema_profile(raw))
                    _show(f"{spec.tag}: required columns {month}", schema_audit.required_columns(raw, spec))
        if len(columns) > 1:
            _show("column comparison", schema_audit.column_comparison(spark, columns))
        return
    for spec in specs if layer in ("bronze", "silver") else []:
        df = medallion.read_layer(spark, lake, layer, f"{spec.tag}_trips")
        _show(f"{layer} {spec.tag}: rows per month in the window",
              profile.rows_per_month(df, q.year, q.first_month, q.last_month))
        _show(f"{layer} {spec.tag}: partitions", profile.partition_counts(df))
        required = spec.bronze_required if layer == "bronze" else SILVER_REQUIRED
        _show(f"{layer} {spec.tag}: nulls", profile.null_profile(df, required))
        _show(f"{layer} {spec.tag}: lower-case names", schema_audit.lowercase_check(spark, df.schema, spec.tag))
        if layer == "silver":
            _show(f"silver {spec.tag}: passengers", profile.value_distribution(df, "passenger_count"))
            _show(f"silver {spec.tag}: amount by month", profile.amount_stats_by_month(df))
        _show(f"{layer} {spec.tag}: sample", profile.sample_partition(df, q.year, q.first_month))
    if layer == "gold":
        gold = medallion.read_layer(spark, lake, "gold", "all_trips")
        _show("gold: summary", profile.gold_summary(gold))
        _show("gold: filter audit", profile.filter_audit(gold, q))
        _show("gold: sample", profile.sample_partition(gold, q.year, q.first_month))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    extra = cluster_conf(args.cores) if args.cores else {}
    spark = build_session(args.master, app_name=f"tripflow-{args.stage}", extra_conf=extra)
    lake = medallion.Lake(args.lake)
    q = QualitySpec(year=args.year, first_month=args.window_first, last_month=args.window_last,
                    hourly_month=args.hourly_month)
    months = month_range(args.first_month, args.last_month)
    tags = args.feed or sorted(FEEDS)
    specs = [FEEDS[t].with_months(months[0], months[-1]) for t in tags]
    if args.stage == "audit":
        audit(spark, args.layer, specs, lake, q, args.landing)
        spark.stop()
        return 0
    if args.stage in ("hourly", "all") and not q.first_month <= q.hourly_month <= q.last_month:
        raise SystemExit(f"--hourly-month {q.hourly_month} lies outside the window {q.first_month} to {q.last_month}")
    if args.stage in ("bronze", "all") and not args.landing:
        raise SystemExit(f"--landing is required for the {args.stage} stage")

    def report(status) -> None:
        for r in status.collect():  # a local frame with one row per month
            print(f"bronze {r.feed} {r.mes} {r.status} rows={r.linhas}" + (f" {r.erro}" if r.erro else ""))
        for r in ingest_tally(status).collect():
            print(f"bronze {r.feed} sucessos={r.sucessos} falhas={r.falhas}")

    if args.stage == "all":  # the feeds of a layer in parallel
        log = medallion.run_all(spark, {s.tag: args.landing for s in specs}, {s.tag: s for s in specs}, lake, q, on_status=report, strict=args.strict, resume=args.resume)
        for r in log.collect():
            print(f"{r.stage} {r.feed} rows={r.rows} seconds={r.seconds}")
        spark.stop()
        return 0
    for stage in [args.stage]:
        if stage == "bronze":
            for spec in specs:
                report(medallion.ingest_bronze_from_landing(spark, spec, args.landing, lake, strict=args.strict))
        elif stage == "silver":
            for spec in specs:
                print(f"silver {spec.tag} rows={medallion.standardize_silver(spark, spec, lake)}")
        elif stage == "gold":
            print(f"gold all rows={medallion.consolidate_gold(spark, specs, lake, q)}")
        elif stage == "monthly":
            print(f"monthly rows={medallion.monthly_result(spark, lake, q)}")
        elif stage == "hourly":
            try:
                print(f"hourly rows={medallion.hourly_result(spark, lake, q, must_hold=True)}")
            except ValueError as exc:
                raise SystemExit(str(exc)) from None
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
