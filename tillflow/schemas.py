"""One definition per raw and gold table."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
DATE, TIMESTAMP = DateType(), TimestampType()


def _fields(kind: DataType, names: str) -> list[StructField]:
    return [StructField(name, kind) for name in names.split()]


def ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


PARTITION = _fields(STRING, "partition")

# Field names, order and types of the three raw feeds. A stream line has the same
# fields as a raw sales line, without the day.
SALES_LINE = StructType(
    _fields(STRING, "kafka_topic process_date hour_id invoice_line_no date")
    + _fields(STRING, "store name address city zipcode store_location county_number county")
    + _fields(STRING, "category category_name vendor_no vendor_name itemno im_desc")
    + _fields(INT, "pack")
    + _fields(DOUBLE, "bottle_volume_ml state_bottle_cost state_bottle_retail")
    + _fields(INT, "sale_bottles")
    + _fields(DOUBLE, "sale_dollars sale_liters sale_gallons")
)
RAW_SALES = StructType(SALES_LINE.fields + PARTITION)
RAW_PRODUCT = StructType(
    _fields(STRING, "itemno category_name im_desc vendor_no vendor_name")
    + _fields(DOUBLE, "bottle_volume_ml pack innerpack age proof")
    + _fields(STRING, "listdate upc scc")
    + _fields(DOUBLE, "state_bottle_cost state_case_cost state_bottle_retail")
    + _fields(STRING, "date")
    + PARTITION
)
RAW_STORE = StructType(
    _fields(STRING, "store name store_status address city state zipcode store_address date")
    + PARTITION
)

# Columns of the star schema.
FACT_SALES = StructType(
    _fields(STRING, "invoice_line_no")
    + _fields(DATE, "date_key")
    + _fields(STRING, "store_id product_id")
    + _fields(INT, "sale_bottles")
    + _fields(DOUBLE, "sale_dollars cost_dollars gross_profit sale_liters sale_gallons")
    + PARTITION
)
DIM_PRODUCT = StructType(
    _fields(STRING, "id category product_desc vendor_id vendor_name")
    + _fields(DOUBLE, "bottle_volume_ml pack innerpack age proof ABV")
    + _fields(DATE, "listdate")
    + _fields(STRING, "upc scc")
    + _fields(DOUBLE, "state_bottle_cost state_case_cost state_bottle_retail")
    + _fields(DATE, "update_date")
    + PARTITION
)
DIM_STORE = StructType(
    _fields(STRING, "id name status address city state zipcode")
    + _fields(DATE, "update_date")
    + PARTITION
    + _fields(DOUBLE, "latitude longitude")
)
DIM_DATE = StructType(
    _fields(DATE, "full_date")
    + _fields(STRING, "date_key day_of_week day_of_month month month_name")
    + _fields(INT, "quarter")
    + _fields(STRING, "year year_month is_weekend is_holiday")
    + _fields(INT, "week_of_year")
)

# Running totals: the keys all three grains share, and the additive measures.
TOTAL_KEYS = _fields(STRING, "kafka_topic") + _fields(DATE, "prd_id") + _fields(STRING, "hour_id")
TOTAL_MEASURES = (
    _fields(LONG, "sale_bottles")
    + _fields(DOUBLE, "tot_cost_dollars tot_sale_dollars tot_profit_dollars")
    + _fields(DOUBLE, "sale_liters sale_gallons")
)
TOTAL_GRAINS = {
    "f001_store_tot_sales": _fields(STRING, "store_name store_city"),
    "f002_vendor_tot_sales": _fields(STRING, "vendor_name"),
    "f003_product_tot_sales": _fields(STRING, "category_name im_desc"),
}

STREAM_LOG = StructType(
    _fields(STRING, "app_name table_name")
    + _fields(TIMESTAMP, "batch_start_time batch_end_time")
    + _fields(DOUBLE, "processing_time_seconds")
    + _fields(LONG, "record_count")
    + _fields(STRING, "status error_details")
    + _fields(LONG, "batch_id")
)
DAY_SKETCHES = StructType(
    _fields(STRING, "app_name table_name") + _fields(LONG, "batches") + _fields(BinaryType(), "sketch") + _fields(STRING, "partition")
)
RUN_LOG = StructType(
    _fields(STRING, "run_date step")
    + _fields(INT, "try_number")
    + _fields(STRING, "status")
    + _fields(TIMESTAMP, "start_time end_time")
    + _fields(LONG, "rows")
    + _fields(STRING, "output_path error")
)


def totals_schema(table: str) -> StructType:
    return StructType(TOTAL_KEYS + TOTAL_GRAINS[table] + TOTAL_MEASURES)


def all_totals_schema() -> StructType:
    """All grains in one table; the key columns of the other grains are NULL."""
    attributes = [field for grain in TOTAL_GRAINS.values() for field in grain]
    return StructType(TOTAL_KEYS + attributes + TOTAL_MEASURES)
