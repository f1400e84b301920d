"""Code tables: names of codes out of a table instead of a fixed map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A code table is broadcast up to this size; a larger one meets the rows in a shuffle.
BROADCAST_BYTES = 16 << 20


def repeated_codes(codes: DataFrame) -> DataFrame:
    """Codes that stand in more than one row, with their number of names; `decoded` takes the least."""
    rows = codes.where("code IS NOT NULL").groupBy("code")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("name").alias("names")).where("rows > 1")


def decoded(rows: DataFrame, column: str, codes: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows with each code of a column replaced by its name in `codes` (code, name). A code that has no
    name, and NULL, stays as it is; a code with several names gets the least."""
    one = codes.where("code IS NOT NULL").groupBy("code").agg(F.min("name").alias("name"))
    one = one.select(F.col("code").alias("__code"), F.col("name").alias("__name"))
    size = one.agg(F.sum(F.length("__code") + F.coalesce(F.length("__name"), F.lit(0)) + 32)).first()[0] or 0
    one = F.broadcast(one) if size <= broadcast_bytes else one
    joined = rows.join(one, F.col(column) == F.col("__code"), "left")
    return joined.withColumn(column, F.coalesce("__name", column)).select(rows.columns)
