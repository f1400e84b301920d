from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.codes import state_name, store_status
from tillflow.functions.dates import day_key_to_date, text_to_date
from tillflow.functions.geo import latitude, longitude
from tillflow.operators.lookup import decoded
from tillflow.schemas import DIM_PRODUCT, DIM_STORE


def _update_date(run_date: str | None) -> Column:
    """The run's day; without one, the day each row landed on. The source date is not kept."""
    return day_key_to_date(F.lit(run_date) if run_date else F.col("partition"))


def build_dim_product(
    raw: DataFrame, run_date: str | None = None, lenient_dates: bool = False
) -> DataFrame:
    return (
        raw.withColumnsRenamed(
            {
                "itemno": "id",
                "category_name": "category",
                "im_desc": "product_desc",
                "vendor_no": "vendor_id",
            }
        )
        .withColumns(
            {
                "ABV": F.col("proof") / 200,
                "listdate": text_to_date("listdate", lenient_dates),
                "update_date": _update_date(run_date),
            }
        )
        .select(DIM_PRODUCT.names)
    )


def build_dim_store(raw: DataFrame, run_date: str | None = None, states: DataFrame | None = None) -> DataFrame:
    """`states` (code, name) replaces the fixed names of states."""
    point, state = F.col("store_address"), state_name(F.col("state"))
    if states is not None:
        raw, state = decoded(raw, "state", states), F.col("state")
    return (
        raw.withColumnsRenamed({"store": "id", "store_status": "status"})
        .withColumns(
            {
                "status": store_status(F.col("status")),
                "state": state,
                "update_date": _update_date(run_date),
                "latitude": latitude(point),
                "longitude": longitude(point),
            }
        )
        .drop("store_address")
        .select(DIM_STORE.names)
    )
