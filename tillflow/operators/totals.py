"""Running totals by store, vendor and product: per hour sums that can be merged later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.dates import text_to_date
from tillflow.schemas import TOTAL_GRAINS, TOTAL_KEYS, TOTAL_MEASURES, all_totals_schema

COMMON_KEYS = [field.name for field in TOTAL_KEYS]
GRAIN_KEYS = {table: [f.name for f in fields] for table, fields in TOTAL_GRAINS.items()}
MEASURES = [field.name for field in TOTAL_MEASURES]


#: Column of the event time, where totals carry it.
EVENT = "event_time"


def event_time(prd_id: Column, hour_id: Column) -> Column:
    """When the hour of a total began; NULL without a day. What is no hour of a day counts as the first."""
    hour = hour_id.try_cast("int")
    known = F.when(hour.between(0, 23), hour).otherwise(0)
    return F.timestamp_add("HOUR", known, prd_id.cast("timestamp"))


def with_event_time(sales: DataFrame, late_after: str, lenient_dates: bool = False) -> DataFrame:
    """Sales lines with their event time, and a watermark that follows its maximum at that distance."""
    day = text_to_date("process_date", lenient_dates)
    return sales.withColumn(EVENT, event_time(day, F.col("hour_id"))).withWatermark(EVENT, late_after)


def _keyed(sales: DataFrame, lenient_dates: bool) -> DataFrame:
    more = [EVENT] if EVENT in sales.columns else []
    return sales.select(
        *more,
        "kafka_topic",
        text_to_date("process_date", lenient_dates).alias("prd_id"),
        "hour_id",
        F.col("name").alias("store_name"),
        F.col("city").alias("store_city"),
        "vendor_name",
        "category_name",
        "im_desc",
        "sale_bottles",
        "state_bottle_cost",
        "sale_dollars",
        "sale_liters",
        "sale_gallons",
    )


def _sums() -> list[Column]:
    """Profit is total sales less total cost, so a line without a cost still counts its sales."""
    cost = F.sum(F.col("state_bottle_cost") * F.col("sale_bottles"))
    sales = F.sum("sale_dollars")
    return [
        F.sum("sale_bottles").alias("sale_bottles"),
        cost.alias("tot_cost_dollars"),
        sales.alias("tot_sale_dollars"),
        (sales - cost).alias("tot_profit_dollars"),
        F.sum("sale_liters").alias("sale_liters"),
        F.sum("sale_gallons").alias("sale_gallons"),
    ]


def totals(sales: DataFrame, table: str, lenient_dates: bool = False) -> DataFrame:
    """One grain. Partial sums run before the shuffle, so a hot key costs one row per task."""
    keys = COMMON_KEYS + GRAIN_KEYS[table]
    return _keyed(sales, lenient_dates).groupBy(*keys).agg(*_sums())


def all_totals(sales: DataFrame, lenient_dates: bool = False) -> DataFrame:
    """All three grains from one pass over the lines, told apart by `table_name`.

    The name comes from grouping(), not from NULL keys: a key may be NULL itself.
    """
    rows = _keyed(sales, lenient_dates)
    # With an event time among the keys a stream can forget totals that are past its watermark.
    common = [name for name in (EVENT,) if name in rows.columns] + COMMON_KEYS
    grains = [common + keys for keys in GRAIN_KEYS.values()]
    every_key = common + [key for keys in GRAIN_KEYS.values() for key in keys]
    table_name = F.coalesce(
        *[F.when(F.grouping(keys[0]) == 0, table) for table, keys in GRAIN_KEYS.items()]
    )
    grouped = rows.groupingSets(grains, *every_key)
    return grouped.agg(table_name.alias("table_name"), *_sums()).select(
        "table_name", *all_totals_schema().names
    )


def pick_totals(everything: DataFrame, table: str) -> DataFrame:
    """The rows and columns of one grain out of all_totals."""
    columns = COMMON_KEYS + GRAIN_KEYS[table] + MEASURES
    return everything.where(F.col("table_name") == table).select(*columns)


def merge_deltas(deltas: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of per-batch sums. Profit is worked out again, since a NULL cost is not a zero cost."""
    cost, sales = F.sum("tot_cost_dollars"), F.sum("tot_sale_dollars")
    derived = {
        "tot_cost_dollars": cost,
        "tot_sale_dollars": sales,
        "tot_profit_dollars": sales - cost,
    }
    sums = [derived.get(name, F.sum(name)).alias(name) for name in MEASURES]
    return deltas.groupBy(*keys).agg(*sums)


def latest_snapshot(snapshots: DataFrame, keys: list[str]) -> DataFrame:
    """Newest published value of each key. NULL keys group together like any other key."""
    newest = F.max_by(F.struct(*MEASURES), F.col("batch_id")).alias("newest")
    return snapshots.groupBy(*keys).agg(newest).select(*keys, "newest.*")
