from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import text_to_date


def build_fact_sales(raw: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """Raw sales lines to the sales fact, one row per line, no de-duplication.

    A narrow projection: no shuffle, and only the ten source columns reach the scan.
    """
    cost = F.col("state_bottle_cost") * F.col("sale_bottles")
    return raw.select(
        "invoice_line_no",
        text_to_date("process_date", lenient_dates).alias("date_key"),
        F.col("store").alias("store_id"),
        F.col("itemno").alias("product_id"),
        "sale_bottles",
        "sale_dollars",
        cost.alias("cost_dollars"),
        (F.col("sale_dollars") - cost).alias("gross_profit"),
        "sale_liters",
        "sale_gallons",
        "partition",
    )
