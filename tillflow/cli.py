"""Command line of the jobs, for spark-submit: see `--help`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tillflow.lake import Lake, previous_day
from tillflow.operators.calendar import END, START
from tillflow.plans.backfill import backfill, backfill_versions
from tillflow.plans.catalog import register_gold
from tillflow.plans.daily import PRODUCT, SALES, STORE, load_dates, load_day, run_daily
from tillflow.session import spark_session
from tillflow.plans.health import log_health
from tillflow.schemas import TOTAL_GRAINS
from tillflow.sinks.logs import append_log, compact_batch_log, read_batch_log
from tillflow.sources.messages import kafka_messages
from tillflow.streaming.compaction import TARGET_BYTES, compact_landing, drop_compacted
from tillflow.streaming.current import drop_folded, fold, publish_view
from tillflow.streaming.landing import TABLE as LANDED
from tillflow.streaming.landing import start_landing
from tillflow.streaming.levels import drop_levelled, fold_days
from tillflow.streaming.totals import ROCKSDB, TotalsStore, run_until_stopped, start_totals

TABLES = {"product": PRODUCT, "store": STORE, "sales": SALES}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillflow")
    top.add_argument("--lake", required=True, help="root folder of the lake, e.g. hdfs://…")
    top.add_argument("--layout", default="scan", help="scan, rebalance, or a number of files")
    top.add_argument("--lenient-dates", action="store_true", help="take the dates the old parser took")
    top.add_argument("--time-zone", default="UTC", help="zone that decides what yesterday is")
    top.add_argument("--versioned", action="store_true", help="days behind a manifest: readers never see half of a load")
    jobs = top.add_subparsers(dest="job", required=True)

    for name in TABLES:
        day = jobs.add_parser(name, help=f"load one day of {name}")
        day.add_argument("--date", help="yyyyMMdd; default: yesterday")
    daily = jobs.add_parser("daily", help="load product, store and sales of one day, in order")
    daily.add_argument("--date", help="yyyyMMdd; default: yesterday")
    daily.add_argument("--retries", type=int, default=1)
    daily.add_argument("--retry-wait", type=float, default=300, help="seconds")
    daily.add_argument("--time-limit", type=float, default=600, help="seconds per try; 0: none")
    past = jobs.add_parser("backfill", help="load a range of days as one job")
    past.add_argument("table", choices=TABLES)
    past.add_argument("start", help="yyyyMMdd")
    past.add_argument("end", help="yyyyMMdd, included")
    past.add_argument("--changed", action="store_true", help="only days whose raw files changed; means --versioned")
    dates = jobs.add_parser("dates", help="write the date table")
    dates.add_argument("--start", default=START)
    dates.add_argument("--end", default=END)
    dates.add_argument("--holidays", choices=["calendar", "iso_week"], default="calendar")
    for name, text in (("landing", "land messages in the raw zone"), ("totals", "running totals")):
        stream = jobs.add_parser(name, help=text)
        stream.add_argument("--servers", required=True, help="Kafka bootstrap servers")
        stream.add_argument("--topic", default="liquor_sales")
        stream.add_argument("--max-offsets", type=int, default=100, help="per trigger; 0: no limit")
        stream.add_argument("--every", default="1 minute")
        stream.add_argument("--drain", action="store_true", help="take what is there and stop")
        if name == "totals":
            stream.add_argument("--late-after", help="interval: older totals are kept aside, or forgotten by the state")
            stream.add_argument("--mode", choices=["delta", "state"], default="delta")
            stream.add_argument("--output", choices=["update", "complete"], default="update")
            stream.add_argument("--state-partitions", type=int)
            stream.add_argument("--state-provider", default=ROCKSDB, help="class of the state store")
            stream.add_argument(
                "--new-checkpoint",
                choices=["refuse", "continue", "replace"],
                default="refuse",
                help="what a checkpoint without history does to a store that holds batches",
            )
    folds = jobs.add_parser("fold", help="merge old batches of the running totals")
    folds.add_argument("--by-day", action="store_true", help="rewrite the days that new batches touch, and no others")
    folds.add_argument("--drop", action="store_true", help="then delete the merged batches")
    publish = jobs.add_parser("publish", help="write current totals and point SQL views at them")
    for job in (folds, publish):
        job.add_argument("--mode", choices=["delta", "state"], default="delta")
    publish.add_argument("--output", choices=["update", "complete"], default="update")
    landed = jobs.add_parser("compact-landing", help="pack the files of landed days")
    landed.add_argument("before", help="yyyyMMdd: days before this one")
    landed.add_argument("--target-bytes", type=int, default=TARGET_BYTES)
    landed.add_argument("--drop", action="store_true", help="then delete batches that were packed a day ago or earlier")
    compact = jobs.add_parser("compact-log", help="move old batch log entries to a file per day")
    compact.add_argument("before", help="yyyy-MM-dd: batches that began before this day")
    health = jobs.add_parser("health", help="totals of the batch log, with alerts")
    health.add_argument("--max-mean-seconds", type=float, default=60.0)
    health.add_argument("--max-seconds", type=float, default=600.0)
    health.add_argument("--max-errors", type=int, default=0)
    jobs.add_parser("register", help="register the gold tables in the catalog")
    return top


def totals_store(lake: Lake) -> TotalsStore:
    return TotalsStore(lake.streaming("running_totals"))


def _start_stream(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    messages = kafka_messages(
        spark, args.servers, args.topic, max_offsets_per_trigger=args.max_offsets or None
    )
    every, checkpoint = None if args.drain else args.every, lake.checkpoint(args.job)
    if args.job == "landing":
        run_until_stopped(start_landing(messages, lake, checkpoint, every, args.lenient_dates))
        return
    query = start_totals(
        messages,
        totals_store(lake),
        checkpoint,
        args.mode,
        args.output,
        every,
        lenient_dates=args.lenient_dates,
        state_partitions=args.state_partitions,
        state_provider=args.state_provider,
        new_checkpoint=args.new_checkpoint,
        late_after=args.late_after,
    )
    run_until_stopped(query)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Run one job; 1 where a day or a step failed."""
    lake = Lake(args.lake)
    layout = int(args.layout) if args.layout.isdigit() else args.layout
    tables = {name: job.lenient() if args.lenient_dates else job for name, job in TABLES.items()}
    if args.job in TABLES:
        day = args.date or previous_day(tz=args.time_zone)
        print(load_day(spark, lake, tables[args.job], day, layout=layout, versioned=args.versioned).text())
    elif args.job == "daily":
        day = args.date or previous_day(tz=args.time_zone)
        log = run_daily(
            spark, lake, day, tuple(tables.values()), args.retries, args.retry_wait, args.time_limit, layout, args.versioned
        )
        append_log(log.coalesce(1), lake.gold("run_logs"))
        log.show(truncate=False)
        return int(log.orderBy("start_time").tail(1)[0]["status"] != "succeed")
    elif args.job == "backfill":
        job = tables[args.table]
        if args.versioned or args.changed:
            report = backfill_versions(spark, lake, job, args.start, args.end, layout=layout, changed_only=args.changed)
        else:
            report = backfill(spark, lake, job, args.start, args.end, layout=layout)
        days = report.orderBy("partition").collect()
        for day in days:
            print(day["partition"], day["status"], day["rows"], day["error"] or "")
        return int(any(day["status"] == "failed" for day in days))
    elif args.job == "dates":
        print(load_dates(spark, lake, args.start, args.end, args.holidays).text())
    elif args.job in ("landing", "totals"):
        _start_stream(spark, lake, args)
    elif args.job == "fold" and args.by_day:
        print("days rewritten:", len(fold_days(spark, totals_store(lake), mode=args.mode)))
        if args.drop:
            print("batches deleted:", drop_levelled(spark, totals_store(lake), args.mode))
    elif args.job == "fold":
        print("merged up to batch", fold(spark, totals_store(lake), mode=args.mode))
        if args.drop:
            print("batches deleted:", drop_folded(spark, totals_store(lake), args.mode))
    elif args.job == "publish":
        for table in TOTAL_GRAINS:
            print(table, "at", publish_view(spark, totals_store(lake), table, None, args.mode, args.output))
    elif args.job == "compact-landing":
        print("days packed:", len(compact_landing(spark, lake, LANDED, args.before, target_bytes=args.target_bytes)))
        if args.drop:
            print("batches deleted:", drop_compacted(spark, lake, LANDED))
    elif args.job == "compact-log":
        print("batches moved:", compact_batch_log(spark, totals_store(lake).log, args.before))
    elif args.job == "health":
        log = read_batch_log(spark, totals_store(lake).log)
        log_health(log, args.max_mean_seconds, args.max_seconds, args.max_errors).show(truncate=False)
    elif args.job == "register":
        for table, name in register_gold(spark, lake).items():
            print(table, "as", name)
    return 0


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    return run(spark_session(f"TILLFLOW_{args.job.upper()}"), args)


if __name__ == "__main__":
    sys.exit(main())
