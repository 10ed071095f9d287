"""Jobs for spark-submit: ``python -m starfold <job> --root <folder> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from starfold.paths import ALL_DATES, LakePaths
from starfold.operators.drift import landed_variants, schema_drift
from starfold.plans import ledger, pipeline, refresh, serving, silver
from starfold.schema import DIMENSIONS
from starfold.session import build_session
from starfold.sources.pages import landed_pages, page_gaps
from starfold.sources.sinks import jdbc_options, warehouse_options
from starfold.sources.tables import LOAD_DATE


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starfold", description="Loads of the vaccination star schema")
    top.add_argument("--root", required=True, help="folder of the lake")
    top.add_argument("--master", help="Spark master; spark-submit sets it otherwise")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, help_text: str, day: str | None = None) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help_text)
        if day is not None:
            sub.add_argument("--date", default=day, help="run date yyyy-mm-dd, * for all where allowed")
        return sub

    top.add_argument("--gold-form", choices=["snapshots", "delta"], default="snapshots", help="form of the gold tables")
    today = str(date.today())
    csv = job("silver-csv", "landed delimited files to silver", today)
    csv.add_argument("--infer", action="store_true", help="infer column types, into the untyped folder")
    job("silver-csv-by-dose-date", "landed delimited files to silver laid out by dose date")
    hits = job("silver-json", "landed search hits to silver; * for all landed days", today)
    hits.add_argument("--untyped", action="store_true", help="neither cast columns nor read dates, into the untyped folder")
    hits.add_argument("--append", action="store_true")

    dimension = job("dimension", "silver to one dimension, or to all", ALL_DATES)
    dimension.add_argument("name", choices=[*DIMENSIONS, "all"])
    dimension.add_argument("--rebuild", action="store_true", help="replace instead of merge")
    fact = job("fact", "silver and dimensions to the fact", ALL_DATES)
    fact.add_argument("--mode", choices=["new_only", "add_new", "batch", "append", "reload"], default="new_only")

    fact.add_argument("--run-date", help="load date to store under; the date by default")

    bulk = job("bulk", "first load from delimited files", today)
    bulk.add_argument("--by-dose-date", action="store_true", help="through silver laid out by dose date")
    bulk.add_argument("--dose-from", help="first dose date, with --by-dose-date")
    bulk.add_argument("--dose-until", help="first dose date not loaded, with --by-dose-date")
    bulk.add_argument("--infer", action="store_true", help="through the untyped folder, in the types found in the files")
    daily = job("day", "daily load from search hits", today)
    loads = [dimension, fact, bulk, daily]
    days = job("backfill", "daily loads of a range")
    days.add_argument("--start", required=True)
    days.add_argument("--end", default=today, help="first day not loaded")
    missed = job("catch-up", "loads of all landed days not loaded from the files they have now")
    missed.add_argument("--until", help="first day left alone")
    missed.add_argument("--most-days", type=int, help="at most so many days in this run")
    loads += [days, missed, job("refresh-keys", "missing keys of stored doses looked up again")]
    pages = job("check-pages", "whether landed pages are all there, once, in order", ALL_DATES)
    pages.add_argument("--page-size", type=int, default=10_000, help="hits of a full page")
    fields = job("check-fields", "unknown, missing and retyped fields of landed hits", ALL_DATES)
    for sub in (hits, daily, days, missed, pages, fields):
        sub.add_argument("--line-mode", action="store_true", help="every landed line is one object or array of hits")
    for sub in loads:
        sub.add_argument("--patient-rows", choices=[pipeline.LATEST, pipeline.BY_RACE], default=pipeline.LATEST)
        sub.add_argument("--null-safe-keys", action="store_true")

    publish = job("publish", "gold to a serving store")
    for sub in (publish, job("reconcile", "whether a serving store holds the rows of gold")):
        sub.add_argument("--format", default="jdbc", help="jdbc, bigquery or any other Spark connector")
        sub.add_argument("--url")
        sub.add_argument("--driver", default="org.postgresql.Driver")
        sub.add_argument("--user")
        sub.add_argument("--password")
        sub.add_argument("--dataset", help="prefix of the table names")
        sub.add_argument("--staging-bucket")
    publish.add_argument("--first", action="store_true", help="the store has no fact yet: do not look for it")
    publish.add_argument("--fact-date", help="send only this load date of the fact")
    publish.add_argument("--fact-mode", choices=["append", "overwrite"], help="append goes with --fact-date")
    return top


def table_options(args: argparse.Namespace, table: str) -> dict[str, str]:
    name = f"{args.dataset}.{table}" if args.dataset else table
    if args.format == "jdbc":
        return jdbc_options(args.url, name, args.driver, args.user, args.password)
    return warehouse_options(name, args.staging_bucket)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark, paths = build_session(f"starfold-{args.job}", args.master), LakePaths(args.root, gold_form=args.gold_form)
    load = {}
    if hasattr(args, "patient_rows"):
        load = {"patient_rows": args.patient_rows, "null_safe": args.null_safe_keys}

    if args.job == "silver-csv":
        silver.load_csv(spark, paths, args.date, args.infer)
    elif args.job == "silver-csv-by-dose-date":
        silver.load_csv_by_dose_date(spark, paths)
    elif args.job == "silver-json":
        mode = "append" if args.append else "overwrite"
        silver.load_hits(spark, paths, args.date, not args.line_mode, not args.untyped, mode)
    elif args.job == "dimension" and args.name == "all":
        pipeline.load_dimensions(spark, paths, day=args.date, rebuild=args.rebuild, **load)
    elif args.job == "dimension":
        pipeline.load_dimension(spark, paths, args.name, args.date, rebuild=args.rebuild, **load)
    elif args.job == "fact":
        pipeline.load_fact(spark, paths, args.date, args.run_date, args.mode, **load)
    elif args.job == "bulk" and args.by_dose_date:
        pipeline.run_bulk_trusted(spark, paths, args.date, args.dose_from, args.dose_until, **load)
    elif args.job == "bulk":
        pipeline.run_bulk(spark, paths, args.date, args.infer, **load)
    elif args.job == "day":
        pipeline.run_day(spark, paths, args.date, not args.line_mode, **load)
    elif args.job == "backfill":
        pipeline.backfill(spark, paths, args.start, args.end, not args.line_mode, **load)
    elif args.job == "catch-up":
        print(*ledger.catch_up(spark, paths, args.until, not args.line_mode, args.most_days, **load))
    elif args.job == "refresh-keys":
        print(*refresh.refresh_fact_keys(spark, paths, **load))
    elif args.job == "check-pages":
        found = landed_pages(spark, paths.landing_json, args.date, not args.line_mode)
        page_gaps(found, args.page_size).orderBy("day", "page", "problem").show(1000, False)
    elif args.job == "check-fields":
        found = landed_variants(spark, paths.landing_json, args.date, not args.line_mode)
        schema_drift(found).orderBy("day", "drift", "field").show(1000, False)
    elif args.job == "reconcile":
        report = serving.reconcile(spark, paths, args.format, lambda table: table_options(args, table))
        report.orderBy("table_name", LOAD_DATE).show(1000, False)
    elif args.job == "publish":
        found = serving.publish_gold(
            spark, paths, args.format, lambda table: table_options(args, table), args.fact_date, args.fact_mode, args.first
        )
        print(found or "")


if __name__ == "__main__":
    main()
