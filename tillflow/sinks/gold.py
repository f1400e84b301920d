"""Parquet writers. Each is one Spark job; the report comes out of the write, not a second scan.

Layout of the files:
  "scan"       as the scan split them: no shuffle, and never more files than input splits
  "rebalance"  one shuffle; AQE joins small pieces and splits large ones, also within one hot day
  a number     that many files per write, for small tables only
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillflow.versions import commit, new_load, replaced


@dataclass(frozen=True)
class WriteReport:
    path: str
    seconds: float
    rows: int
    days: list[str] = field(default_factory=list)

    def text(self) -> str:
        return f"{self.rows} rows written to {self.path} in {self.seconds:.2f} s"


def _arrange(df: DataFrame, layout: str | int, *columns: str) -> DataFrame:
    if layout == "scan":
        return df
    if layout == "rebalance":
        return df.hint("rebalance", *columns)
    return df.repartition(int(layout))


def _write(df: DataFrame, path: str, metrics: dict, save) -> WriteReport:
    """Metrics sit right above the write: in its result stage a task counts once, even if re-run."""
    seen, started = Observation(), time.monotonic()
    columns = [metric.alias(name) for name, metric in metrics.items()]
    save(df.observe(seen, F.count(F.lit(1)).alias("rows"), *columns))
    found = seen.get
    return WriteReport(
        path, time.monotonic() - started, found.get("rows", 0), sorted(found.get("days") or [])
    )


def write_table(df: DataFrame, path: str, layout: str | int = "scan") -> WriteReport:
    """Replace a whole unpartitioned table."""
    return _write(
        _arrange(df, layout), path, {}, lambda out: out.write.mode("overwrite").parquet(path)
    )


def write_day(df: DataFrame, root: str, day: str, layout: str | int = "scan") -> WriteReport:
    """Replace one day, also by nothing; other days are not touched.

    A dynamic overwrite swaps the folder when the write is committed, so a write that fails leaves
    the old day as it was. It cannot write an empty day: that is replaced by itself.
    """
    path = f"{root}/partition={day}"
    report = write_days(df.withColumn("partition", F.lit(day)), root, layout)
    if not report.rows:
        return write_table(df.drop("partition").limit(0), path)
    return replace(report, path=path)


def write_days(df: DataFrame, root: str, layout: str | int = "scan") -> WriteReport:
    """Replace every day that has a row in df and leave all other days alone."""

    def save(out: DataFrame) -> None:
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("partition").parquet(root)

    arranged = _arrange(df, layout, "partition")
    return _write(arranged, root, {"days": F.collect_set("partition")}, save)


def replace_days(
    df: DataFrame, root: str, layout: str | int = "scan", asked: Iterable[str] = (), sources: dict[str, str] | None = None
) -> WriteReport:
    """Replace the days of a versioned table that have a row in df, and by nothing those `asked` for
    that have none, all at once: readers see every one of them as before, or every one as after."""
    spark, load = df.sparkSession, new_load()

    def save(out: DataFrame) -> None:
        out.write.partitionBy("partition").parquet(f"{root}/{load}")

    report = _write(_arrange(df, layout, "partition"), root, {"days": F.collect_set("partition")}, save)
    entries = replaced(report.days, load, asked, sources)
    commit(spark, root, lambda now: replace(now, days=now.days | entries))
    return report
