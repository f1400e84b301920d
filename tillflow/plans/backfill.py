"""Backfill of a date range: one read, one write, and a status row per day.

The range is one Spark job instead of one per day, so the work spreads over all executors however
uneven the days are. If that job fails, the range is halved until the failing days stand alone;
all others are loaded. Where both halves fail with one and the same error, it is not the days: all
are reported with it at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.files import day_folders
from tillflow.lake import Lake, days_between
from tillflow.plans.daily import EmptyInput, TableJob
from tillflow.sinks.gold import replace_days, write_day, write_days
from tillflow.sources.gold import rows_per_day
from tillflow.sources.raw import day_sources, holds_file, read_raw_day, read_raw_days, read_raw_list
from tillflow.versions import is_versioned, read_manifest


def _tried(load: Callable[[list[str]], list[str]], days: list[str]) -> tuple[set[str], str | None]:
    """Days written, or the error of the one job for all of them."""
    try:
        return set(load(days)), None
    except Exception as error:  # whatever failed is reported by day
        return set(), f"{type(error).__name__}: {error}"


def _loaded(load: Callable[[list[str]], list[str]], days: list[str]) -> tuple[set[str], dict[str, str]]:
    """Days written, and the error of each day that failed."""
    written, error = _tried(load, days)
    failed, open_ranges = {}, [(days, error)] if error else []
    while open_ranges:
        days, error = open_ranges.pop()
        middle = len(days) // 2
        halves = [half for half in (days[:middle], days[middle:]) if half and half != days]
        tries = [(half, *_tried(load, half)) for half in halves]
        errors = [error for _, _, error in tries]
        if not halves or (None not in errors and len(set(errors)) == 1):
            failed |= dict.fromkeys(days, error)
            continue
        for half, done, error in tries:
            written |= done
            if error:
                open_ranges.append((half, error))
    return written, failed


def backfill(
    spark: SparkSession,
    lake: Lake,
    job: TableJob,
    start: str,
    end: str,
    on_empty: str | None = None,
    layout: str | int = "scan",
) -> DataFrame:
    """Load every raw day from start to end and return one status row per day.

    ok: rows written; no_data: nothing to read, gold day left alone; emptied: files without a row,
    gold day replaced by an empty one (on_empty="write"); failed: see `error`.
    """
    on_empty, days = on_empty or job.on_empty_backfill, days_between(start, end)
    if not days:
        raise ValueError(f"no day between {start} and {end}")
    root = lake.gold(job.gold)
    if is_versioned(spark, root):
        return backfill_versions(spark, lake, job, start, end, on_empty, layout)

    def load(some: list[str]) -> list[str]:
        raw = read_raw_days(spark, lake, job.raw, some[0], some[-1])
        return write_days(job.build(raw), root, layout).days

    written, failed = _loaded(load, days)
    emptied = []
    if on_empty != "skip":
        folders = day_folders(spark, lake.raw(job.raw), start, end)
        quiet = [day for day in sorted(folders) if day not in written and day not in failed]
        emptied = [day for day in quiet if holds_file(spark, lake, job.raw, day)]
    if emptied and on_empty == "raise":
        raise EmptyInput(f"no rows in {job.raw} for {', '.join(emptied)}")
    for day in emptied:
        # A dynamic overwrite cannot empty a day; the few such days are written one by one.
        write_day(job.build(read_raw_day(spark, lake, job.raw, day)), root, day)
    status = dict.fromkeys(emptied, "emptied") | dict.fromkeys(written, "ok") | dict.fromkeys(failed, "failed")
    return _report(spark, lake, job, days, status, failed)


def _report(
    spark: SparkSession, lake: Lake, job: TableJob, days: list[str], status: dict[str, str], failed: dict[str, str]
) -> DataFrame:
    report = spark.createDataFrame(
        [(day, status.get(day, "no_data"), failed.get(day)) for day in days],
        "partition STRING, status STRING, error STRING",
    )
    counts = rows_per_day(spark, lake, job.gold, days[0], days[-1])
    rows = F.when(F.col("status") == "ok", F.col("count")).otherwise(0).alias("rows")
    return report.join(counts, "partition", "left").select("partition", "status", rows, "error")


def backfill_versions(
    spark: SparkSession,
    lake: Lake,
    job: TableJob,
    start: str,
    end: str,
    on_empty: str | None = None,
    layout: str | int = "scan",
    changed_only: bool = False,
) -> DataFrame:
    """Load the days from start to end into a versioned table, all of them in one manifest, and return
    one status row per day as `backfill` does.

    Every day keeps a hash of the raw files it came from. With `changed_only` a day whose files still
    have that hash is not read again, and its status is "unchanged"; a range without a change runs no
    job and leaves the manifest as it is. Hashes are taken before the files are read, so a file that
    comes meanwhile is a change for the next run.
    """
    on_empty, days, root = on_empty or job.on_empty_backfill, days_between(start, end), lake.gold(job.gold)
    if not days:
        raise ValueError(f"no day between {start} and {end}")
    sources = day_sources(spark, lake, job.raw, start, end)
    held = read_manifest(spark, root).days
    same = {day for day in sources if changed_only and day in held and held[day].source == sources[day]}
    todo = sorted(set(sources) - same)

    def load(some: list[str]) -> list[str]:
        raw = read_raw_list(spark, lake, job.raw, some)
        asked = some if on_empty == "write" else ()
        return replace_days(job.build(raw), root, layout, asked, sources).days

    written, failed = _loaded(load, todo) if todo else (set(), {})
    quiet = [day for day in todo if day not in written and day not in failed]
    if quiet and on_empty == "raise":
        raise EmptyInput(f"no rows in {job.raw} for {', '.join(quiet)}")
    status = dict.fromkeys(same, "unchanged") | dict.fromkeys(written, "ok") | dict.fromkeys(failed, "failed")
    if on_empty == "write":
        status = dict.fromkeys(quiet, "emptied") | status
    return _report(spark, lake, job, days, status, failed)
