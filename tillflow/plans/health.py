"""Health of the streaming jobs, from the batch log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.schemas import DAY_SKETCHES
from tillflow.sinks.gold import replace_days
from tillflow.versions import read_manifest, read_versioned


def log_health(
    log: DataFrame,
    max_mean_seconds: float = 60.0,
    max_seconds: float = 600.0,
    max_errors: int = 0,
) -> DataFrame:
    """Per app and table: records, batch times, errors, and whether a threshold is passed."""
    seconds = F.col("processing_time_seconds")
    health = log.groupBy("app_name", "table_name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("record_count").alias("records"),
        F.avg(seconds).alias("mean_seconds"),
        F.max(seconds).alias("max_seconds"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
    alert = (
        (F.col("mean_seconds") > max_mean_seconds)
        | (F.col("max_seconds") > max_seconds)
        | (F.col("errors") > max_errors)
    )
    return health.withColumn("alert", alert)


def unhealthy(log: DataFrame, **thresholds) -> DataFrame:
    return log_health(log, **thresholds).where("alert")


#: Larger sketches are more exact: with 1,000 a rank is off by half a percent at most, with 99 % confidence.
SKETCH_SIZE = 1000


def day_sketches(log: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per app, table and day of the batch's begin: batches, and a mergeable sketch of their times. Batches
    without a time are left out; a day's sketch is a few kilobytes however many batches it has."""
    timed = log.where("processing_time_seconds IS NOT NULL")
    seconds = F.col("processing_time_seconds").cast("double")
    keys = ["app_name", "table_name", F.to_date("batch_start_time").alias("day")]
    return timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("batches"), F.kll_sketch_agg_double(seconds, size).alias("sketch"))


def store_day_sketches(log: DataFrame, root: str, before: str) -> list[str]:
    """Sketch the days before a day (yyyy-MM-dd) into a versioned table, each day once, and give the days
    written. The log of a sketched day may go: quantiles over any range of days need its sketch only."""
    spark = log.sparkSession
    held = list(read_manifest(spark, root).days)
    rows = day_sketches(log.where(F.to_date("batch_start_time") < F.lit(before).cast("date")))
    rows = rows.withColumn("partition", F.date_format("day", "yyyyMMdd")).where(~F.col("partition").isin(held) if held else F.lit(True))
    return replace_days(rows.drop("day"), root, "rebalance").days


def read_day_sketches(spark: SparkSession, root: str, start: str = "", end: str = "~") -> DataFrame:
    return read_versioned(spark, root, DAY_SKETCHES, start, end)


def time_quantiles(sketches: DataFrame, ranks: list[float], by: list[str] | None = None) -> DataFrame:
    """Batch times at each rank (0 to 1) per app and table, or per `by`, over all days given, out of merged
    sketches."""
    by = by or ["app_name", "table_name"]
    merged = sketches.groupBy(*by).agg(F.sum("batches").alias("batches"), F.kll_merge_agg_double("sketch").alias("sketch"))
    at = lambda rank: F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank))).alias("seconds")
    each = F.array(*[F.struct(F.lit(float(rank)).alias("rank"), at(rank)) for rank in ranks])
    return merged.select(*by, "batches", F.inline(each))
