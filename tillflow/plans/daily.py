"""Daily loads: one raw day to one gold day, and the run of all three in order."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import partial
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.lake import Lake, previous_day
from tillflow.operators.calendar import END, START, build_dim_date
from tillflow.operators.dimensions import build_dim_product, build_dim_store
from tillflow.operators.facts import build_fact_sales
from tillflow.schemas import RUN_LOG
from tillflow.sinks.gold import WriteReport, replace_days, write_day, write_table
from tillflow.sources.raw import read_raw_day
from tillflow.versions import is_versioned


@dataclass(frozen=True)
class TableJob:
    """How one gold table comes from one raw table.

    on_empty says what a day without rows does: "raise", "skip", or "write" an empty day.
    """

    step: str
    raw: str
    gold: str
    build: Callable[[DataFrame], DataFrame]
    on_empty: str
    on_empty_backfill: str

    def lenient(self) -> TableJob:
        """The same job with the old rule for dates; stores have no date to parse."""
        if "lenient_dates" not in signature(self.build).parameters:
            return self
        return replace(self, build=partial(self.build, lenient_dates=True))


# update_date follows the row's own day, so one builder serves a single day and a range.
PRODUCT = TableJob(
    "product_daily", "rd_liquor_product", "dim_liquor_product", build_dim_product, "write", "write"
)
STORE = TableJob(
    "store_daily", "rd_liquor_store", "dim_liquor_store", build_dim_store, "write", "write"
)
SALES = TableJob(
    "sales_daily", "rd_liquor_sales", "fact_liquor_sales", build_fact_sales, "raise", "skip"
)
DAILY_ORDER = (PRODUCT, STORE, SALES)


class EmptyInput(ValueError):
    """A day that must hold rows holds none."""


def load_day(
    spark: SparkSession,
    lake: Lake,
    job: TableJob,
    run_date: str | None = None,
    on_empty: str | None = None,
    layout: str | int = "scan",
    versioned: bool = False,
) -> WriteReport:
    """Replace one gold day. A missing raw day fails before anything is written. A versioned table
    changes over by a manifest; it stays versioned, whatever the caller says."""
    day, on_empty = run_date or previous_day(), on_empty or job.on_empty
    raw = read_raw_day(spark, lake, job.raw, day)
    root = lake.gold(job.gold)
    if on_empty != "write" and raw.isEmpty():
        if on_empty == "raise":
            raise EmptyInput(f"no rows in {job.raw} for {day}")
        return WriteReport(f"{root}/partition={day}", 0.0, 0)
    if versioned or is_versioned(spark, root):
        return replace_days(job.build(raw).withColumn("partition", F.lit(day)), root, layout, asked=[day])
    return write_day(job.build(raw), root, day, layout)


def load_dates(
    spark: SparkSession, lake: Lake, start: str = START, end: str = END, rule: str = "calendar"
) -> WriteReport:
    return write_table(build_dim_date(spark, start, end, rule), lake.gold("dim_iowa_date"))


@contextmanager
def _time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Cancel the Spark jobs of this block once it runs too long, and those it starts after that."""
    if not seconds:
        yield
        return
    context, tag, done = spark.sparkContext, f"limit-{uuid.uuid4().hex}", threading.Event()

    def watch() -> None:
        if not done.wait(seconds):
            context.cancelJobsWithTag(tag)
            while not done.wait(1):
                context.cancelJobsWithTag(tag)

    context.addJobTag(tag)
    threading.Thread(target=watch, daemon=True).start()
    try:
        yield
    finally:
        done.set()
        context.removeJobTag(tag)


def run_daily(
    spark: SparkSession,
    lake: Lake,
    run_date: str | None = None,
    jobs: tuple[TableJob, ...] = DAILY_ORDER,
    retries: int = 1,
    retry_wait: float = 300,
    time_limit: float | None = 600,
    layout: str | int = "scan",
    versioned: bool = False,
) -> DataFrame:
    """Run the jobs in order and stop at the first that fails for good.

    Returns the run log, one row per try: a handful of rows, whatever the data size.
    """
    day, log = run_date or previous_day(), []
    for job in jobs:
        for attempt in range(1, retries + 2):
            if attempt > 1:
                time.sleep(retry_wait)
            started, path, rows, error = datetime.now(timezone.utc), None, None, None
            try:
                with _time_limit(spark, time_limit):
                    report = load_day(spark, lake, job, day, layout=layout, versioned=versioned)
                path, rows = report.path, report.rows
            except Exception as failure:  # every failure is a log row
                error = f"{type(failure).__name__}: {failure}"
            status, ended = "failed" if error else "succeed", datetime.now(timezone.utc)
            log.append((day, job.step, attempt, status, started, ended, rows, path, error))
            if not error:
                break
        if error:
            break
    return spark.createDataFrame(log, RUN_LOG)
