"""Gold zone: Parquet, one folder per day for facts and dimensions.

A table that has manifests is read by them, any other by its day folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillflow.files import day_folders
from tillflow.lake import GOLD_TABLES, Lake
from tillflow.versions import is_versioned, read_versioned


def read_gold(spark: SparkSession, lake: Lake, table: str) -> DataFrame:
    """The whole table; filters on `partition` prune folders, column choice prunes the scan."""
    schema = GOLD_TABLES[table]
    if is_versioned(spark, lake.gold(table)):
        return read_versioned(spark, lake.gold(table), schema)
    return spark.read.schema(schema).parquet(lake.gold(table)).select(schema.names)


def read_gold_days(
    spark: SparkSession, lake: Lake, table: str, start: str, end: str
) -> DataFrame:
    """The days from start to end, and only their folders listed."""
    root, schema = lake.gold(table), GOLD_TABLES[table]
    if is_versioned(spark, root):
        return read_versioned(spark, root, schema, start, end)
    folders = day_folders(spark, root, start, end)
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*folders.values()).select(schema.names)


def rows_per_day(
    spark: SparkSession, lake: Lake, table: str, start: str, end: str
) -> DataFrame:
    """Row counts of written days. No column is read: Parquet footers hold the counts."""
    return read_gold_days(spark, lake, table, start, end).groupBy("partition").count()
