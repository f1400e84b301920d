"""Gold folders as external tables, for SQL users."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tillflow.files import matching
from tillflow.lake import GOLD_TABLES, Lake
from tillflow.schemas import ddl


def register_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    path: str,
    partitioned_by: str | None = "partition",
) -> None:
    """Create the table if it is new, then follow its day folders: new ones appear, gone ones go.

    A table may be registered before its first load; it is empty until then. A table of that name
    with another schema or place is registered anew; its files are not touched.
    """
    if spark.catalog.tableExists(name) and not _same(spark, name, schema, path):
        spark.sql(f"DROP TABLE {name}")
    partitioning = f"PARTITIONED BY (`{partitioned_by}`)" if partitioned_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING PARQUET {partitioning} "
        f"LOCATION '{path}'"
    )
    if partitioned_by and matching(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def _same(spark: SparkSession, name: str, schema: StructType, path: str) -> bool:
    """Whether a table has these columns, in any order, and lies there."""
    columns = {(field.name, field.dataType) for field in spark.table(name).schema.fields}
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
    same_place = place is not None and place["data_type"].rpartition(":")[2].rstrip("/") == path.rpartition(":")[2].rstrip("/")
    return columns == {(field.name, field.dataType) for field in schema.fields} and same_place


def register_gold(spark: SparkSession, lake: Lake, prefix: str = "") -> dict[str, str]:
    """Register all four gold tables; gives their names in the catalog."""
    names = {table: f"{prefix}{table}" for table in GOLD_TABLES}
    for table, schema in GOLD_TABLES.items():
        day = "partition" if "partition" in schema.names else None
        register_table(spark, names[table], schema, lake.gold(table), day)
    return names
